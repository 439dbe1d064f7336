"""Near-duplicate texts: every pair of similar shingle sets is found, exact sets decide.

SimHash joins most groups cheaply first.  Each distinct text gets a SimHash over its set of distinct words, which moves
little under edits that change many shingles.  Pairs within ``radius`` bits are
candidates: with m slices of the 64 bits, two such codes agree on m - radius of
them, so codes meet in one bucket per choice of slices, and each bucket is
searched by the Gray-order index of the SimHash operator.  The number of slices
follows the number of codes, which keeps buckets small; what is found does not
depend on it.  A bucket hands on a minimum spanning forest of its candidate pairs,
nearest pairs first, instead of all pairs of a group; each pair of the forest is
then decided by the Jaccard similarity of its sets of word shingles.

What that misses, an exact join finds.  Two sets of the wanted similarity share one
of the first shingles of each in any common order (the prefix filter); rare shingles
come first, by counts of hashed buckets.  Rows of first shingles are shuffled once, and
the buckets of several texts are written; all that follows reads these.  At first each
text of a bucket meets the bucket's first text and the one before it in size, which
joins most groups.  Then texts of one group are not compared again; sizes, places in
the order and parity bitmaps rule out most other pairs, none of them similar.  A
bucket with very many pairs first compares one text per group with its neighbours in
size, and goes on after groups have joined, until no pair of two groups is left
undecided; only such buckets are read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release
from .components import connected_components
from .shingling import codes_of, digests_of, distinct, offsets, shingle_sets, slices_of, words_of
from .simhash import CHUNK_ROWS, GrayIndex

WORDS, SIMILARITY, RADIUS = 5, 0.8, 6
#: Bits of a bucket of the shingle counts and of a shard of them, bits of a text's bitmap.
COUNT_BITS, SHARD_BITS, MAP_BITS, FOLD_BITS = 23, 16, 2048, 512
#: Rows of a shingle that meet at once; pairs a row beyond which a shingle is taken in rounds; neighbours compared then.
HOT_ROWS, OPEN_PAIRS, NEIGHBOURS = 4_000, 64, 4


def forest(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Positions of the edges of a minimum spanning forest (Boruvka's rounds; ties by position)."""
    if not len(u):
        return np.zeros(0, np.int64)
    ids, inv = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inv[: len(u)], inv[len(u) :]
    order = np.argsort(d, kind="stable")
    rank = np.empty(len(d), np.int64)
    rank[order] = np.arange(len(d))
    root, live, kept = np.arange(len(ids)), np.arange(len(u)), []
    while True:
        ra, rb = root[a[live]], root[b[live]]
        live = live[ra != rb]
        if not len(live):
            return np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
        ra, rb = root[a[live]], root[b[live]]
        best = np.full(len(ids), len(d))
        np.minimum.at(best, ra, rank[live])
        np.minimum.at(best, rb, rank[live])
        pick = np.unique(order[best[best < len(d)]])
        kept.append(pick)
        while True:  # join the ends of what was picked
            x, y = root[a[pick]], root[b[pick]]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            if (lo == hi).all():
                break
            np.minimum.at(root, hi, lo)
            while (root != root[root]).any():
                root = root[root]


def _alone(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(text, np.uint8), np.array([0, len(text)])


def word_code(text: bytes) -> int:
    """SimHash over the set of distinct lower-cased words."""
    return int(codes_of(*distinct(*words_of(*_alone(text))))[0])


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted names of the distinct shingles."""
    return shingle_sets(*_alone(text), words)[0]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def choices(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """The sets of (shift, width) slices whose bits form a bucket's key, for about ``n`` codes."""
    need = max(1.0, log2(max(2, n)) - 3)
    agree = 1
    while agree < 4 and 64 * agree / (radius + agree) < need:
        agree += 1
    m = radius + agree
    cut = [round(i * 64 / m) for i in range(m + 1)]
    return [[(cut[i], cut[i + 1] - cut[i]) for i in c] for c in combinations(range(m), agree)]


def _candidates(codes: DataFrame, radius: int, tables: list[list[tuple[int, int]]]) -> DataFrame:
    """(u, v): pairs of ids of one row of ``codes`` (id, code) each, a spanning forest per bucket."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, code = b.column(0), b.column(1).to_numpy().view(np.uint64)
            for t, parts in enumerate(tables):
                key = np.zeros(len(code), np.uint64)
                for shift, width in parts:
                    key = key << np.uint64(width) | code >> np.uint64(shift) & np.uint64((1 << width) - 1)
                # The table number takes the top bits, so one column tells buckets apart.
                key |= np.uint64(t) << np.uint64(52)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column(1), ids], ["k", "code", "id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def links(parts):
            k, code, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
            g = np.cumsum(np.concatenate(([True], k[1:] != k[:-1]))) - 1
            many = np.bincount(g)[g] > 1
            code, ids, g = code[many].view(np.uint64), ids[many], g[many]
            us, vs, ds, size = [ids[:0]], [ids[:0]], [np.zeros(0, np.int64)], 0
            if len(g):
                for i, j in GrayIndex(g, code).pairs(radius):
                    us.append(ids[i])
                    vs.append(ids[j])
                    ds.append(np.bitwise_count(code[i] ^ code[j]).astype(np.int64))
                    size += len(i)
                    if size > 500_000:  # a forest of the forests so far keeps memory bounded
                        u, v, d = np.concatenate(us), np.concatenate(vs), np.concatenate(ds)
                        f = forest(u, v, d)
                        us, vs, ds, size = [u[f]], [v[f]], [d[f]], len(f)
            u, v, d = np.concatenate(us), np.concatenate(vs), np.concatenate(ds)
            f = forest(u, v, d)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u[f], v[f])), pa.array(np.maximum(u[f], v[f]))], ["u", "v"])

        for b in batches:
            if not len(b):
                continue
            cols = tuple(b.column(i).to_numpy() for i in range(3))
            if rows >= CHUNK_ROWS:
                inside = cols[0] != held[-1][0][-1]
                cut = int(np.argmax(inside)) if inside.any() else len(inside)
                held.append(tuple(c[:cut] for c in cols))
                cols = tuple(c[cut:] for c in cols)
                rows += cut
                if len(cols[0]):
                    yield links(held)
                    held, rows = [], 0
            if len(cols[0]):
                held.append(cols)
                rows += len(cols[0])
        if held:
            yield links(held)

    spreaded = codes.select("id", "code").mapInArrow(spread, "k long, code long, id long")
    return spreaded.repartition("k").sortWithinPartitions("k").mapInArrow(search, "u long, v long").distinct()


def _decide(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            read = lambda c: [np.frombuffer(x, np.uint64) for x in b.column(c).to_pylist()]
            good = [jaccard(x, y) >= similarity for x, y in zip(read(2), read(3), strict=True)]
            yield b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sets.select(F.col("id").alias("u"), F.col("set").alias("a")), "u").join(sets.select(F.col("id").alias("v"), F.col("set").alias("b")), "v")
    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _bucket(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _counts(rows: DataFrame, words: int) -> np.ndarray:
    """About how many shingles of all texts fall into each bucket; a task counts up to 255.

    Any common order of shingles will do; a good one has the rare ones first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.uint32)
        for b in batches:
            for _, _, raw, offs in slices_of(b.column(1)):
                np.add.at(total, _bucket(shingle_sets(raw, offs, words)[0]), np.uint32(1))
        for i, part in enumerate(np.minimum(total, 255).astype(np.uint8).reshape(-1, 1 << SHARD_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["shard", "n"])
        release()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, np.uint32(0)) + np.frombuffer(x, np.uint8)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(x, 65_535).astype(np.uint16).tobytes() for x in sums.values()], pa.binary())], ["shard", "n"])

    out = np.zeros((1 << (COUNT_BITS - SHARD_BITS), 1 << SHARD_BITS), np.uint16)
    kind = "shard int, n binary"
    for r in rows.mapInArrow(count, kind).repartition("shard").mapInArrow(add, kind).toLocalIterator():  # a fixed size
        out[r["shard"]] = np.frombuffer(r["n"], np.uint16)
    return out.ravel()


def prefix(names: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in the common order (count, name), of which similar sets share one."""
    order = np.lexsort((names, counts[_bucket(names)]))
    return names[order[: len(names) - int(np.ceil(similarity * len(names) - 1e-9)) + 1]]


def bitmap(names: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per bit; bitmaps differ in no more bits than sets in shingles."""
    return np.packbits((np.bincount((names & np.uint64(MAP_BITS - 1)).astype(np.int64), minlength=MAP_BITS) & 1).astype(np.uint8))


def fold(names: np.ndarray) -> bytes:
    """The bitmap in fewer bits: parities of parities, so the bound on differing bits stays."""
    return np.bitwise_xor.reduce(bitmap(names).reshape(-1, FOLD_BITS // 8), axis=0).tobytes()


def bucket_pairs(
    k: np.ndarray, comp: np.ndarray, ids: np.ndarray, size: np.ndarray, pos: np.ndarray, similarity: float, limit: float, maps: np.ndarray | None = None, prev: np.ndarray | None = None, left: list | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(u, v, whole): pairs of rows with equal k and different comp that may be similar; not whole if some were put off.

    ``maps`` are folded bitmaps, a row of words each.  ``prev`` names the shingle before
    each row's in the common order: a pair that shares this as well meets there, earlier.
    The k of which pairs were put off go to ``left``.
    """
    order = np.lexsort((ids, size, comp, k))
    k, comp, ids, size, pos = (x[order] for x in (k, comp, ids, size, pos))
    maps, prev = (x[order] if x is not None else None for x in (maps, prev))
    new = np.concatenate(([True], k[1:] != k[:-1]))
    g = np.cumsum(new) - 1
    first = new | np.concatenate(([True], comp[1:] != comp[:-1]))  # of its group in the bucket
    run = np.diff(np.append(np.flatnonzero(first), len(k))).astype(np.float64)
    n = np.bincount(g).astype(np.float64)
    cross = (n * n - np.bincount(g[first], weights=run * run)) / 2
    wide = (cross > limit * n)[g]
    for rows, steps in ((np.flatnonzero((cross > 0)[g] & ~wide), None), (np.flatnonzero(wide & first), NEIGHBOURS)):
        if not len(rows):
            continue
        rows = rows[np.lexsort((ids[rows], size[rows], g[rows]))]
        live, d = np.arange(len(rows) - 1), 1
        while len(live) and (steps is None or d <= steps):
            live = live[live + d < len(rows)]
            a, b = rows[live], rows[live + d]
            # Sizes ascend in a bucket, so a row whose partner is too large has no later one.
            on = (g[a] == g[b]) & (size[a] >= similarity * size[b] - 1e-9)
            live, a, b = live[on], a[on], b[on]
            need = similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9
            ok = (comp[a] != comp[b]) & (1 + np.minimum(size[a] - pos[a] - 1, size[b] - pos[b] - 1) >= need)
            if prev is not None:
                ok &= (prev[a] != prev[b]) | (pos[a] == 0) | (pos[b] == 0)
            a, b = a[ok], b[ok]
            if maps is not None and len(a):
                far = np.bitwise_count(maps[a] ^ maps[b]).sum(1, dtype=np.int64)
                near = far <= (1 - similarity) / (1 + similarity) * (size[a] + size[b]) + 1e-9
                a, b = a[near], b[near]
            yield np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), True
            d += 1
    if wide.any():
        if left is not None:
            left.append(np.unique(k[wide]))
        yield ids[:0], ids[:0], False


def _buckets(packed: DataFrame) -> DataFrame:
    """(k, id, at, prev, first, before, turn): the rows of first shingles that several texts have.

    ``at`` is the size of the text's set, then the shingle's place in it, ``prev`` the shingle
    before it (0 for none); ``first``
    and ``before`` are the bucket's first text and the one before this in size, and
    ``turn`` is the row's number in the bucket, from 0.  Rows come sorted, so a bucket
    of any size passes through in batches.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 1000):
                part = b.slice(lo, 1000)
                names = [np.frombuffer(x, np.uint64) for x in part.column(2).to_pylist()]
                n = np.array([len(x) for x in names], np.int64)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(part.column(1).to_numpy().astype(np.int64) << 32, n) | place
                k = np.concatenate(names).view(np.int64)
                prev = np.where(place > 0, np.concatenate((k[:1], k[:-1])), 0)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.repeat(part.column(0).to_numpy(), n)), pa.array(at), pa.array(prev)], ["k", "id", "at", "prev"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far, of which it is not known yet whether another of its bucket follows

        def marked(k, i, at, prev):
            """First text of each row's bucket, the text before the row, the row's number, whether there is one before, whether the bucket has several."""
            same = k[1:] == k[:-1]
            later = np.concatenate(([False], same))
            head = np.maximum.accumulate(np.where(later, 0, np.arange(len(k))))
            first, before, turn = i[head], np.concatenate((i[:1], i[:-1])), np.arange(len(k)) - head
            if held is not None:  # row 0 is the one that was held back
                turn[head == 0] += held[6]
                first[head == 0], before[0], later[0] = held[4], held[5], held[7]
            return first, before, turn, later, later | np.concatenate((same, [False]))

        def batch(k, i, at, prev, first, before, turn, later, several):
            made = [pa.array(x[several]) for x in (k, i, at, prev, first)] + [pa.array(before[several], mask=~later[several]), pa.array(turn[several])]
            return pa.RecordBatch.from_arrays(made, ["k", "id", "at", "prev", "first", "before", "turn"])

        for b in batches:
            if not len(b):
                continue
            cols = tuple(b.column(c).to_numpy() for c in range(4))
            if held is not None:
                cols = tuple(np.concatenate(([x], y)) for x, y in zip(held[:4], cols, strict=True))
            cols = (*cols, *marked(*cols))
            yield batch(*(x[:-1] for x in cols))
            held = tuple(x[-1] for x in cols[:8])
        if held is not None and held[7]:
            yield batch(*(np.array([x]) for x in (*held, True)))

    rows = packed.select("id", "size", "names").mapInArrow(spread, "k long, id long, at long, prev long")
    return rows.repartition("k").sortWithinPartitions("k", "at", "id").mapInArrow(search, "k long, id long, at long, prev long, first long, before long, turn long")


def _meet(buckets: DataFrame, hot: DataFrame, comps: DataFrame, packed: DataFrame, similarity: float, limit: float) -> DataFrame:
    """(u, v) of ``bucket_pairs`` over the buckets of several groups; (null, k) for each bucket of which pairs were put off."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(held):
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            us, vs, at, left = [], [], 0, []
            for u, v, _ in bucket_pairs(*cols[:3], cols[3] >> 32, cols[3] & 0xFFFFFFFF, similarity, limit, cols[6], cols[4], left):
                us.append(u)
                vs.append(v)
                at += len(u)
                if at > 500_000:
                    yield unique(us, vs)
                    us, vs, at = [], [], 0
            if at:
                yield unique(us, vs)
            if left:
                open_ = np.unique(cols[5][np.isin(cols[0], np.concatenate(left))])
                yield pa.RecordBatch.from_arrays([pa.nulls(len(open_), pa.int64()), pa.array(open_)], ["u", "v"])

        def unique(us, vs):
            both = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["u", "v"])

        held, rows = [], 0
        for b in batches:
            if not len(b):
                continue
            cols = (*(b.column(i).to_numpy() for i in range(6)), np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint64).reshape(len(b), -1))
            if rows >= CHUNK_ROWS:  # the held rows end where a bucket ends
                inside = cols[0] != held[-1][0][-1]
                cut = int(np.argmax(inside)) if inside.any() else len(inside)
                held.append(tuple(c[:cut] for c in cols))
                cols = tuple(c[cut:] for c in cols)
                rows += cut
                if len(cols[0]):
                    yield from run(held)
                    held, rows = [], 0
            if len(cols[0]):
                held.append(cols)
                rows += len(cols[0])
        if held:
            yield from run(held)

    rows = buckets.select("k", "id", "at", "prev").join(comps, "id").select("k", "comp", "id", "at", "prev")
    several = rows.groupBy("k").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("k")
    rows = materialize(rows.join(several, "k", "left_semi"), "open").join(packed.select("id", "fold"), "id").select("k", "comp", "id", "at", "prev", F.col("k").alias("own"), "fold")
    # Each two blocks of a bucket of very many rows meet in a bucket of their own.
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda c: F.xxhash64("k", F.least(mine, c), F.greatest(mine, c)))
    split = rows.join(hot, "k").withColumn("k", F.explode(pair)).select("k", "comp", "id", "at", "prev", "own", "fold")
    rows = rows.join(hot, "k", "left_anti").union(split)
    return rows.repartition("k").sortWithinPartitions("k").mapInArrow(search, "u long, v long").distinct()


def _possible(pairs: DataFrame, packed: DataFrame, similarity: float) -> DataFrame:
    """The pairs that bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(len(b), -1) for c in (2, 3))
            far = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            most = (1 - similarity) / (1 + similarity) * (b.column(4).to_numpy() + b.column(5).to_numpy()) + 1e-9
            yield b.select([0, 1]).filter(pa.array(far <= most))

    side = lambda c, m, n: packed.select(F.col("id").alias(c), F.col("map").alias(m), F.col("size").alias(n))
    both = pairs.join(side("u", "a", "na"), "u").join(side("v", "b", "nb"), "v")
    return both.select("u", "v", "a", "b", "na", "nb").mapInArrow(run, "u long, v long")


def exact_links(rows: DataFrame, owners: DataFrame, links: DataFrame, words: int, similarity: float) -> DataFrame:
    """``links`` (u, v) and more: components are those of all pairs of ``similarity`` among the texts of ``owners`` (id)."""
    counts = _counts(rows, words)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, offs in slices_of(b.column(1)):
                flat, n = shingle_sets(raw, offs, words)
                ends = offsets(n)
                sets = [flat[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                names, maps, folds = [prefix(x, counts, similarity).tobytes() for x in sets], [bitmap(x).tobytes() for x in sets], [fold(x) for x in sets]
                made = [pa.array(n.astype(np.int32)), *(pa.array(x, pa.binary()) for x in (names, maps, folds))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *made], ["id", "size", "names", "map", "fold"])
        release()

    packed = rows.mapInArrow(pack, "id long, size int, names binary, map binary, fold binary").filter("size > 0")
    packed = materialize(packed.join(owners.select("id"), "id", "left_semi").dropDuplicates(["id"]), "prefixes")
    buckets = materialize(_buckets(packed), "buckets")
    # In a bucket of three all pairs meet at first; larger ones are met again.
    large = materialize(buckets.join(buckets.filter("turn = 3").select("k"), "k", "left_semi").select("k", "id", "at", "prev"), "large")
    hot = large.groupBy("k").count().filter(F.col("count") > HOT_ROWS)
    hot = materialize(hot.select("k", F.ceil(F.col("count") / HOT_ROWS).cast("long").alias("blocks")), "hot")
    tried, limit, whole = None, OPEN_PAIRS, False
    while True:
        roots = connected_components(links).withColumnRenamed("u", "id")
        comps = materialize(owners.select("id").distinct().join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("comp")), "comps")
        if tried is None:
            edge = lambda c: buckets.select(F.least("id", c).alias("u"), F.greatest("id", c).alias("v")).filter(f"{c} is not null and id <> {c}")
            near = edge("first").union(edge("before")).distinct()
            met = near.join(comps.withColumnsRenamed({"id": "u", "comp": "cu"}), "u").join(comps.withColumnsRenamed({"id": "v", "comp": "cv"}), "v").filter("cu <> cv").select("u", "v")
            met = materialize(met, "met")
        else:
            met = materialize(_meet(large, hot, comps, packed, similarity, limit).join(tried, ["u", "v"], "left_anti"), "met")
            put_off = met.filter("u is null").select(F.col("v").alias("k")).distinct()
            whole = put_off.isEmpty()
            if not whole:  # of every other bucket all pairs have met
                large = materialize(large.join(put_off, "k", "left_semi"), "left")
        asked = met.filter("u is not null")
        pairs = materialize(_possible(asked, packed, similarity), "pairs")
        more = materialize(_decide(pairs, _sets(rows, pairs, words), similarity), "links")
        links = links.union(more)
        if whole:
            return links
        if tried is not None:  # where little joins any more, decide all
            limit = float("inf") if more.isEmpty() else 16 * limit
        tried = asked if tried is None else tried.union(asked)


def _sets(rows: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(id, set) of the texts that ``pairs`` name."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, offs in slices_of(b.column(1)):
                flat, n = shingle_sets(raw, offs, words)
                ends = offsets(n)
                out = [flat[s:e].tobytes() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(out, pa.binary())], ["id", "set"])

    asked = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    return materialize(rows.join(asked, "id").mapInArrow(sets, "id long, set binary").dropDuplicates(["id"]), "sets")


def duplicate_ids(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id): the ids that are not the smallest of their group of near duplicates.

    Groups are components of pairs with Jaccard similarity of at least
    ``similarity`` between their sets of ``words``-word shingles (a shorter text is
    one shingle); equal word sequences always group.  Texts without words group
    with nothing.  Rows with a null id are never named.  Of different texts under
    one id the least counts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).filter("id is not null")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, offs in slices_of(b.column(1)):
                names, n = words_of(raw, offs)
                high, low = digests_of(names, n)
                code = codes_of(*distinct(names, n))
                arrays = [pa.array(x.view(np.int64)) for x in (code, high, low)]
                arrays[1] = pa.array(high.view(np.int64), mask=n == 0)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *arrays], ["id", "code", "high", "low"])
        release()

    def sketched(rows: DataFrame) -> DataFrame:
        return materialize(rows.mapInArrow(sketch, "id long, code long, high long, low long").filter("high is not null"), "sketches")

    sketches = sketched(rows)
    odd = sketches.groupBy("id").agg(F.min("high").alias("a"), F.max("high").alias("z")).filter("a < z").select("id")
    if not odd.isEmpty():
        odd = materialize(odd, "odd")
        rows = materialize(rows.join(odd, "id", "left_anti").unionByName(rows.join(odd, "id").groupBy("id").agg(F.min("text").alias("text"))), "rows")
        sketches = sketched(rows)
    # Equal word sequences first: only the smallest id of each goes on.
    owners = sketches.groupBy("high", "low").agg(F.min("id").alias("id"), F.first("code").alias("code"))
    owners = materialize(owners, "owners")
    copies = sketches.join(owners.select("high", "low", F.col("id").alias("own")), ["high", "low"]).filter("id <> own").select("id")
    # Texts with one code meet at the smallest id; distinct codes meet in the index.
    least = owners.groupBy("code").agg(F.min("id").alias("id"))
    same = owners.join(least.withColumnRenamed("id", "own"), "code").filter("id <> own").select(F.col("own").alias("u"), F.col("id").alias("v"))
    least = materialize(least, "codes")
    pairs = materialize(same.union(_candidates(least, radius, choices(least.count(), radius))).distinct(), "pairs")
    links = materialize(_decide(pairs, _sets(rows, pairs, words), similarity), "links")
    links = exact_links(rows, owners, links, words, similarity)
    roots = connected_components(links)
    return copies.union(roots.filter("u <> root").select("u")).distinct().select(F.col("id").alias(id_col))


def keep_one(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near duplicates, one document per group, with all their columns."""
    gone = duplicate_ids(docs, words, similarity, radius).withColumnRenamed("doc_id", "gone_id")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
