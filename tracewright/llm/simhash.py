"""SimHash near-duplicates found through a Gray-order hierarchical index.

Fingerprints link when they differ in at most ``radius`` bits.  Two such
fingerprints agree on one of ``radius + 1`` slices of the 64 bits, so each
distinct fingerprint goes to one bucket per slice and no link is lost.  Inside a
bucket the fingerprints are sorted by Gray rank, which makes codes with the same
leading bits neighbours; runs that share a masked pattern become nodes, one level
for each group of bits.  A pair of nodes adds the differences of the newly read
bits to what its parents had, and the whole pair of groups is dropped as soon as
the sum exceeds the radius.  Only a spanning forest of the links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize, text_buffer
from .components import connected_components, spanning

#: Bits read per level of the index, rows indexed together, node pairs expanded together.
LEVEL_BITS, CHUNK_ROWS, FRONTIER = 11, 150_000, 500_000

_HASH = xxhash.xxh64_intdigest
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased text, repeats included."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    if len(w) <= words:
        return np.array([_HASH(joined, seed)], np.uint64)
    lens = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(lens + 1) - 1
    first, last = (ends - lens)[: len(w) - words + 1].tolist(), ends[words - 1 :].tolist()
    return np.array([_HASH(joined[a:b], seed) for a, b in zip(first, last)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 without hashes."""
    if not len(hashes):
        return 0
    by = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        ones = np.unpackbits(by, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(by[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits((ones * 2 > len(hashes)).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            data = raw.tobytes()
            fps = [majority(shingle_hashes(data[s:e], words)) for s, e in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in Gray order."""
    r = code.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def slices(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of the slices of which two linked codes share one."""
    cut = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cut[:-1], cut[1:], strict=True)]


class GrayIndex:
    """Hierarchical index over the codes of many buckets at once.

    ``bucket`` are dense bucket numbers in ascending order.  ``child[k]`` holds,
    per node of level k, where its children begin at level k + 1.
    """

    def __init__(self, bucket: np.ndarray, code: np.ndarray):
        order = np.lexsort((gray_rank(code), bucket))
        self.order, bucket, code = order, bucket[order], code[order]
        n = len(code)
        opens = [np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))]
        self.masks, self.patterns = [], []
        top = 64
        new = np.zeros(n, bool)
        new[opens[0]] = True
        while top > 0:
            width = min(LEVEL_BITS, top)
            mask = np.uint64(((1 << width) - 1) << (top - width))
            top -= width
            new = new | np.concatenate(([True], (code[1:] ^ code[:-1]) & mask != 0))
            at = np.flatnonzero(new)
            self.masks.append(mask)
            self.patterns.append(code[at] & mask)
            opens.append(at)
        self.leaves = opens[-1]
        self.child = [np.append(np.searchsorted(b, a), len(b)) for a, b in zip(opens[:-1], opens[1:], strict=True)]

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs (into the arrays given) of different codes within ``radius``."""
        roots = np.arange(len(self.child[0]) - 1)
        stack = [(0, roots, roots, np.zeros(len(roots), np.uint8))]
        while stack:
            level, a, b, diff = stack.pop()
            if level == len(self.masks):
                far = a != b
                yield self.order[self.leaves[a[far]]], self.order[self.leaves[b[far]]]
                continue
            starts = self.child[level]
            na, nb = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
            made = na * nb
            total = np.cumsum(made)
            if total[-1] > FRONTIER and len(a) > 1:
                k = max(1, min(len(a) - 1, int(np.searchsorted(total, total[-1] // 2))))
                stack += [(level, a[:k], b[:k], diff[:k]), (level, a[k:], b[k:], diff[k:])]
                continue
            for lo in range(0, int(total[-1]), FRONTIER):  # one pair of huge nodes comes in pieces
                at = np.arange(lo, min(int(total[-1]), lo + FRONTIER))
                k = np.searchsorted(total, at, side="right") if len(a) > 1 else np.zeros(len(at), np.int64)
                within = at - (total[k] - made[k])
                x, y = starts[a[k]] + within // nb[k], starts[b[k]] + within % nb[k]
                d = diff[k] + np.bitwise_count(self.patterns[level][x] ^ self.patterns[level][y])
                keep = (d <= radius) & (x <= y)
                if keep.any():
                    stack.append((level + 1, x[keep], y[keep], d[keep]))


def bucket_links(bucket: np.ndarray, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (vertex, root) of the links inside the buckets; vertices are signed codes."""
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = 0
    signed = code.view(np.int64)
    for i, j in GrayIndex(bucket, code).pairs(radius):
        u.append(signed[i])
        v.append(signed[j])
        size += len(i)
        if size > FRONTIER:
            a, b = spanning(np.concatenate(u), np.concatenate(v))
            u, v, size = [a], [b], 0
    u, v = np.concatenate(u), np.concatenate(v)
    if not len(u):
        return u, v
    a, b = spanning(u, v)
    return a[a != b], b[a != b]


def hamming_links(codes: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) edges whose components are those of all links among the distinct ``fp`` of ``codes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(parts):
            t, k, c = (np.concatenate(x) for x in zip(*parts, strict=True))
            new = np.concatenate(([True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])))
            g = np.cumsum(new) - 1
            many = np.bincount(g)[g] > 1
            u, v = bucket_links(g[many], c[many].view(np.uint64), radius) if many.any() else (c[:0], c[:0])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        rows = 0
        for b in batches:
            if not len(b):
                continue
            t, k, c = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if rows >= CHUNK_ROWS:  # the held rows end where a bucket ends
                inside = (t != held[-1][0][-1]) | (k != held[-1][1][-1])
                cut = int(np.argmax(inside)) if inside.any() else len(t)
                held.append((t[:cut], k[:cut], c[:cut]))
                rows += cut
                t, k, c = t[cut:], k[cut:], c[cut:]
                if len(t):
                    yield links(held)
                    held, rows = [], 0
            if len(t):
                held.append((t, k, c))
                rows += len(t)
        if held:
            yield links(held)

    parts = slices(radius)
    keyed = codes.select("fp").distinct().select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.shiftrightunsigned("fp", a).bitwiseAND((1 << w) - 1).alias("k")) for i, (a, w) in enumerate(parts)])).alias("s"), "fp"
    )
    placed = keyed.select("s.t", "s.k", "fp").repartition("t", "k").sortWithinPartitions("t", "k")
    return placed.mapInArrow(run, "u long, v long")


def hex_fp(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own
    included.  Null and empty texts have fingerprint 0 and link like any other;
    copies share a fingerprint and so a component; rows with a null id get the
    component of their fingerprint but never name it.  Other columns are not
    read; an empty table gives no row.
    """
    fps = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    roots = connected_components(hamming_links(fps, radius)).withColumnRenamed("u", "fp")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    named = least.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least", "n")
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return join_hot(fps, materialize(named.join(first, "root").select("fp", "component_id", "n"), "groups"), "fp")
