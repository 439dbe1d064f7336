"""Exact removal of passages that already stand in an earlier document.

A byte goes if a string of ``span`` bytes over it also starts in a document with
a smaller id.  Shuffling every suffix would take many times the input, so
suffixes are blocked first: each window of ``span`` bytes is named by the least
hash among its k-grams, windows in a row with one name form a segment, and equal
windows have equal names wherever they stand.  The steps:

1. names of segments meet by hash; only names in two or more documents go on;
2. those segments, as bytes, meet in blocks; segments, then the windows of the
   segments that stay apart, go through the hash-compared suffix sort (those whose
   hash over the full length nobody shares are left out, they equal nothing), and
   equal neighbours give the smallest id of their class;
3. covered spans return to their documents.

All exchanges carry packed blobs per bucket; the number of buckets follows the
bytes of the input, so a task holds about ``BUCKET_BYTES`` of text.  Names and
segments that repeat inside one task are settled there before anything moves, and
equal texts move once per batch with their ids, so a passage or a text that very
many documents share arrives once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, text_buffer
from .suffix_sort import Suffixes, least_by

#: Bytes of a k-gram: shorter ones repeat by chance the more the larger the input, longer ones make more segments.
SPAN, GRAM, BUCKET_BYTES, BLOCK_BYTES, STRETCH = 50, 24, 8 << 20, 2 << 20, 128 << 10
#: Names, and bytes of segments, that a task gathers before it deals them out, so that the rows it sends follow the buckets and not the blocks.
HELD_NAMES, HELD_BYTES = 1 << 20, 2 * BUCKET_BYTES
_BASE, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_NAME = np.uint64((1 << 48) - 1)  #: names travel as six bytes; what shares one by chance is told apart by the sort
_LAST = np.iinfo(np.int64).max
_SCHEMA = "bucket long, kind int, blob binary"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def pack(*columns: np.ndarray) -> bytes:
    """Arrays of any types as one compressed blob."""
    head = np.array([len(columns), *[x for c in columns for x in (ord(c.dtype.char), len(c))]], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *[np.ascontiguousarray(c).tobytes() for c in columns]]))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 2 * n, 8)
    out, at = [], 8 + 16 * n
    for kind, size in zip(head[::2].tolist(), head[1::2].tolist(), strict=True):
        t = np.dtype(chr(kind))
        out.append(np.frombuffer(raw, t, size, at))
        at += size * t.itemsize
    return out


def joined(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True)]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of stretches one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def segments(raw: np.ndarray, offs: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, name) of the segments of texts that stand one after another in ``raw``."""
    n = len(raw)
    if n < span:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    part = raw.astype(np.uint64) + np.uint64(1)
    size, power, h, have = 1, int(_BASE), None, 0
    while True:  # hashes of 1, 2, 4, ... bytes; those that make up a gram are put together
        if gram & size:
            h = part if h is None else h[: len(h) - size] * np.uint64(power) + part[have:]
            have += size
        if have == gram:
            break
        part = part[:-size] * np.uint64(power) + part[size:]
        power = power * power % (1 << 64)
        size *= 2
    least = _mix(h)
    wide, have = span - gram + 1, 1
    while have * 2 <= wide:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < wide:
        least = np.minimum(least[: have - wide], least[wide - have :])
    inside = np.ones(n - span + 1, bool)  # windows that end in the text they start in
    cuts = offs[1:-1]
    for back in range(1, span):
        at = cuts - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    change = least[1:] != least[:-1]
    opens = inside.copy()
    opens[1:] &= change | ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= change | ~inside[1:]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return start, end - start + 1, least[start] & _NAME


class Text:
    """Rows of a task: ids, tags that tell rows of one id apart, and the bytes."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, sizes: np.ndarray, raw: np.ndarray):
        self.ids, self.tags, self.raw = ids, tags, raw
        self.offs = np.concatenate(([0], np.cumsum(sizes)))

    def blocks(self, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, start in the row, number in the row, windows, name) of all segments, some texts at a time.

        """
        n, at = len(self.ids), 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(self.offs, self.offs[at] + limit, side="right")) - 1)
            a, b = self.offs[at], self.offs[end]
            got = []
            for x, y in self._stretches(at, end):
                lo, hi = np.searchsorted(self.offs, [x + 1, y])
                cuts = self.offs[lo:hi]
                s, w, k = segments(self.raw[x:y], np.array([x, *cuts, y]) - x)
                got.append((s + x - a, w, k))
            start, win, name = (np.concatenate(c) for c in zip(*got, strict=True))
            row = np.searchsorted(self.offs[at : end + 1] - a, start, side="right") - 1
            first = np.searchsorted(row, np.arange(end - at))
            yield row + at, start - (self.offs[at : end + 1] - a)[row], np.arange(len(row)) - first[row], win, name
            at = end


    def _stretches(self, at: int, end: int) -> Iterator[tuple[int, int]]:
        """Byte ranges that stay in a processor's cache: whole texts, or parts of a long one that overlap by a window."""
        while at < end:
            to = min(end, max(at + 1, int(np.searchsorted(self.offs, self.offs[at] + STRETCH, side="right")) - 1))
            a, b = int(self.offs[at]), int(self.offs[to])
            if b - a <= STRETCH:
                yield a, b
            else:
                for x in range(a, b, STRETCH):
                    yield x, min(b, x + STRETCH + SPAN - 1)
            at = to


def spread(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One packed row per bucket."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    cols, b = [c[order] for c in columns], bucket[order]
    at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
    return [(int(b[i]), kind, pack(*[c[i:j] for c in cols])) for i, j in zip(at, np.append(at[1:], len(b)), strict=True)]


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    b, k, x = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(b, pa.int64()), pa.array(k, pa.int32()), pa.array(x, pa.binary())], ["bucket", "kind", "blob"])


def _home(tags: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a text; equal texts share it, and each task sends them once."""
    return (_mix(tags.view(np.uint64) + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def _tags(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    import xxhash

    data = raw.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64).view(np.int64)


def _text_of(b: pa.RecordBatch) -> Text:
    raw, offs = text_buffer(b.column(1))
    ids = b.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    return Text(ids, _tags(raw, offs), np.diff(offs), raw)


def _settle(group: np.ndarray, order_key: np.ndarray) -> np.ndarray:
    """For rows in any order: whether their group holds more than one key."""
    if not len(group):
        return np.zeros(0, bool)
    o = np.lexsort((order_key, group))
    g, k = group[o], order_key[o]
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    many = np.minimum.reduceat(k, first) != np.maximum.reduceat(k, first)
    out = np.empty(len(group), bool)
    out[o] = np.repeat(many, np.diff(np.append(first, len(g))))
    return out


def _six(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (name & np.uint64(0xFFFFFFFF)).astype(np.uint32), (name >> np.uint64(32)).astype(np.uint16)


def _name(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def _short(tags: np.ndarray) -> np.ndarray:
    """Half a tag asks for segments of a text in its bucket; one too many does no harm."""
    return tags.view(np.uint64).astype(np.uint32)


def _spans(home: np.ndarray, ids: np.ndarray, tags: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Covered spans to the buckets of their texts, overlapping ones as one.

    Sixteen bits of the tag tell texts of one id apart.
    """
    if not len(ids):
        return []
    tag = tags.astype(np.uint16)
    o = np.lexsort((start, tag, ids, home))
    home, ids, tag, start, end = home[o], ids[o], tag[o], start[o].astype(np.int64), (start + size)[o].astype(np.int64)
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (tag[1:] != tag[:-1]) | (home[1:] != home[:-1])))
    step = np.int64(end.max() + 1)
    base = (np.cumsum(new) - 1) * step
    reach = np.maximum.accumulate(base + end)
    opens = np.concatenate(([True], (base + start)[1:] > reach[:-1])) | new
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(ids)) - 1
    stop = reach[last] - base[last]
    return spread(home[at].astype(np.int64), 3, ids[at], tag[at], start[at].astype(np.int32), (stop - start[at]).astype(np.int32))


def _names(buckets: int):
    """Step 1, map side: names to their buckets; what already repeats here is settled here."""

    def deal(held: list[tuple]) -> list[pa.RecordBatch]:
        if not held:
            return []
        known, own = ([np.concatenate(c) for c in zip(*x, strict=True)] for x in zip(*held, strict=True))
        return batch_of(spread(known[0], 1, *known[1:]) + spread(own[0], 0, *own[1:])).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            t = _text_of(b)
            held, waiting = [], 0
            for row, _, number, _, name in t.blocks():
                if not len(row):
                    continue
                ids, tag, number = t.ids[row], _short(t.tags)[row], number.astype(np.int32)
                home = _home(t.tags, buckets)[row]
                known = _settle(name, ids)
                order = np.lexsort((number, ids, name))
                lead = np.concatenate(([True], name[order][1:] != name[order][:-1]))
                send = np.sort(order[lead | ~known[order]])  # of a settled name one row tells the others
                to = (_mix(name[send]) >> np.uint64(7)) % np.uint64(buckets)
                own = (to.astype(np.int32), *_six(name[send]), ids[send], home[send].astype(np.uint32), tag[send], number[send], known[send].view(np.uint8))
                held.append(((home[known].astype(np.int32), tag[known], number[known]), own))
                waiting += len(send) + int(known.sum())
                if waiting >= HELD_NAMES:
                    yield from deal(held)
                    held, waiting = [], 0
            yield from deal(held)

    return run


def _repeated(buckets: int):
    """Step 1, reduce side: segments whose name stands in two or more documents, to the documents."""

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        rows = [(int(b), 1, x) for b, k, x in zip(table.column("bucket").to_pylist(), kinds, blobs, strict=True) if k == 1]
        own = [x for k, x in zip(kinds, blobs, strict=True) if k == 0]
        if own:
            low, high, ids, home, tag, number, known = joined(own)
            keep = _settle(_name(low, high), ids) & (known == 0)
            rows += spread(home[keep].astype(np.int64), 1, tag[keep], number[keep])
        return batch_of(rows)

    return run


def _copies(t: Text) -> np.ndarray:
    """For each row the first row with the same bytes."""
    first: dict[tuple[int, int], int] = {}
    out = np.arange(len(t.ids))
    sizes = np.diff(t.offs)
    for i, k in enumerate(zip(t.tags.tolist(), sizes.tolist(), strict=True)):
        j = first.setdefault(k, i)
        if j != i and np.array_equal(t.raw[t.offs[i] : t.offs[i + 1]], t.raw[t.offs[j] : t.offs[j + 1]]):
            out[i] = j
    return out


def _stream(table: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_batch(table)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())


def _texts(buckets: int):
    """Texts to their buckets, equal ones once per batch with all their ids; columns after the second travel along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            t = _text_of(b)
            null = b.column(0).is_null().to_numpy(zero_copy_only=False).view(np.uint8)
            first, home, sizes = _copies(t), _home(t.tags, buckets), np.diff(t.offs)
            lead = np.flatnonzero(first == np.arange(len(first)))
            lead = lead[np.argsort(home[lead], kind="stable")]
            members = np.argsort(first, kind="stable")
            lo, hi = np.searchsorted(first[members], lead, side="left"), np.searchsorted(first[members], lead, side="right")
            at, total = 0, np.cumsum(sizes[lead])
            while at < len(lead):  # blobs of limited size, so that no row outgrows Arrow or the JVM
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BUCKET_BYTES, side="right")))
                rows = []
                for k in np.unique(home[lead[at:end]]):
                    sel = at + np.flatnonzero(home[lead[at:end]] == k)
                    u, n = lead[sel], (hi - lo)[sel]
                    own = members[ragged(lo[sel], n)]
                    more = _stream(b.select(range(2, b.num_columns)).take(pa.array(own))) if b.num_columns > 2 else b""
                    rows.append((int(k), pack(t.tags[u], sizes[u], n, t.raw[ragged(t.offs[u], sizes[u])], t.ids[own], null[own]), more))
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.binary())], ["bucket", "blob", "more"])
                at = end

    return run


def _covered(suffixes: Suffixes, group: np.ndarray, x: np.ndarray, cap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Suffixes that equal one of the same group with a smaller id."""
    out = np.zeros(len(ids), bool)
    some = suffixes.shared(group, x, cap)
    if len(some):
        some = some[_settle(group[some], ids[some])]
        order, cls = suffixes.sort(group[some], x[some], cap[some])
        order = some[order]
        out[order] = least_by(cls, ids[order]) < ids[order]
    return out


def _dealt(here: int, held: list[tuple]) -> list[tuple[int, int, bytes]]:
    """One row per bucket of names with all segments that go there."""
    if not held:
        return []
    to, low, high, ids, tags, start, size, raw = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.argsort(to, kind="stable")
    x = (np.cumsum(size, dtype=np.int64) - size)[order]
    to, low, high, ids, tags, start, size = (c[order] for c in (to, low, high, ids, tags, start, size))
    at = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else []
    rows = []
    for i, j in zip(at, np.append(at[1:], len(to)), strict=True):
        own = (low[i:j], high[i:j], np.full(j - i, here, np.int32), ids[i:j], tags[i:j], start[i:j], size[i:j])
        rows.append((int(to[i]), 4, pack(*own, raw[ragged(x[i:j], size[i:j])])))
    return rows


def _fetch(buckets: int):
    """Step 2, map side: the bytes of repeated segments; those equal to one of a smaller id here are settled."""

    def run(texts: pa.Table, asked: pa.Table) -> pa.Table:
        blobs = texts.column("blob").to_pylist()
        want = asked.column("blob").to_pylist()
        here = texts.column("bucket")[0].as_py() if len(texts) else 0
        if not blobs:
            return batch_of([])
        tags, sizes, n, raw, all_ids, _ = joined(blobs)
        t = Text(np.minimum.reduceat(all_ids, np.cumsum(n) - n), tags, sizes, raw)
        first = _copies(t)
        # Of equal texts the one with the smallest id stands for all; larger ids lose every byte.
        least = t.ids.copy()
        np.minimum.at(least, first, t.ids)
        owner = np.repeat(first, n)
        lost = (all_ids > least[owner]) & (sizes[owner] >= SPAN)
        rows = _spans(np.full(int(lost.sum()), here), all_ids[lost], tags[owner[lost]], np.zeros(int(lost.sum()), np.int64), sizes[owner[lost]])
        u = np.flatnonzero(first == np.arange(len(first)))
        raw = raw[ragged(t.offs[u], sizes[u])]
        ids, tags = least[u], tags[u]
        t = Text(ids, tags, sizes[u], raw)
        if not want:
            return batch_of(rows)
        w_tag, w_num = joined(want)
        by_tag = np.argsort(_short(tags), kind="stable")
        lo, hi = (np.searchsorted(_short(tags)[by_tag], w_tag, side=side) for side in ("left", "right"))
        w_row, w_num = by_tag[ragged(lo, hi - lo)], np.repeat(w_num, hi - lo)
        order = np.argsort(w_row, kind="stable")
        w_row, w_num = w_row[order], w_num[order]
        held, waiting = [], 0
        for row, start, _, win, name in t.blocks():
            if not len(row):
                continue
            lo, hi = np.searchsorted(w_row, [row[0], row[-1] + 1])
            at = np.searchsorted(row, w_row[lo:hi]) + w_num[lo:hi]
            at = np.unique(at[(at < len(row)) & (row[np.minimum(at, len(row) - 1)] == w_row[lo:hi])])
            row, start, win, name = row[at], start[at], win[at], name[at]
            size = win + SPAN - 1
            bytes_ = raw[ragged(t.offs[row] + start, size)]
            x = np.cumsum(size) - size
            gone = _covered(Suffixes(bytes_), name, x, size, ids[row])
            rows += _spans(np.full(int(gone.sum()), here), ids[row[gone]], tags[row[gone]], start[gone], size[gone])
            stay = np.flatnonzero(~gone)
            to = (_mix(name[stay]) >> np.uint64(7)) % np.uint64(buckets)
            own = (ids[row[stay]], tags[row[stay]].astype(np.uint16), start[stay].astype(np.int32), size[stay].astype(np.int32))
            held.append((to.astype(np.int32), *_six(name[stay]), *own, bytes_ if len(stay) == len(x) else bytes_[ragged(x[stay], size[stay])]))
            waiting += len(held[-1][-1])
            if waiting >= HELD_BYTES:
                rows += _dealt(here, held)
                held, waiting = [], 0
        rows += _dealt(here, held)
        release()
        return batch_of(rows)

    return run


def match(name, ids, start, size, raw):
    """Covered spans among segments: (segment, offset in its document, length).

    Segments are taken a few names at a time, so the arrays of a sort stay small.
    """
    x = np.cumsum(size) - size
    some = np.flatnonzero(_settle(name, ids))
    some = some[np.argsort(name[some], kind="stable")]
    total = np.cumsum(size[some])
    out, at = [], 0
    while at < len(some):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        while end < len(some) and name[some[end]] == name[some[end - 1]]:
            end += 1
        part = some[at:end]
        seg, shift, length = _match_some(name[part], ids[part], size[part], raw[ragged(x[part], size[part])])
        out.append((part[seg], start[part[seg]] + shift, length))
        at = end
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (some, some, some)


def _match_some(name, ids, size, raw):
    """(segment, offset in the segment, length) of covered bytes: whole segments, then single windows of the others."""
    suffixes = Suffixes(raw)
    x = np.cumsum(size) - size
    whole = _covered(suffixes, name, x, size, ids)
    full = np.flatnonzero(whole)
    out = [(full, np.zeros(len(full), np.int64), size[full])]
    left = np.flatnonzero(~whole)
    left = left[_settle(name[left], ids[left])]
    count = size[left] - SPAN + 1
    total, at = np.cumsum(count), 0
    while at < len(left):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 19), side="right")))
        while end < len(left) and name[left[end]] == name[left[end - 1]]:
            end += 1
        seg = np.repeat(left[at:end], count[at:end])
        shift = ragged(np.zeros(end - at, np.int64), count[at:end])
        hit = _covered(suffixes, name[seg], x[seg] + shift, np.full(len(seg), SPAN), ids[seg])
        out.append((seg[hit], shift[hit], np.full(int(hit.sum()), SPAN)))
        at = end
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _match(buckets: int):
    """Step 2, reduce side: suffix sort of a block; covered spans to the documents."""

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        rows = [(int(b), 3, x) for b, k, x in zip(table.column("bucket").to_pylist(), kinds, blobs, strict=True) if k == 3]
        own = [x for k, x in zip(kinds, blobs, strict=True) if k == 4]
        if own:
            parts = [unpack(x) for x in own]
            low, high, home, ids, tags, start, size = (np.concatenate(c) for c in zip(*[p[:-1] for p in parts], strict=True))
            raw = np.concatenate([p[-1] for p in parts])
            seg, at, length = match(_name(low, high), ids, start.astype(np.int64), size.astype(np.int64), raw)
            rows += _spans(home[seg], ids[seg], tags[seg], at, length)
            del parts, raw
        release()
        return batch_of(rows)

    return run


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans sorted by start as maximal runs; touching ones join."""
    reach = np.maximum.accumulate(ends)
    opens = np.concatenate(([True], starts[1:] > reach[:-1]))
    at = np.flatnonzero(opens)
    return starts[at], reach[np.append(at[1:], len(starts)) - 1]


def _keep(as_text: bool):
    """Step 3: the texts without their covered spans."""

    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        out: list[tuple] = []
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        blobs = spans.column("blob").to_pylist()
        if blobs:
            ids, tags, start, size = joined(blobs)
            o = np.lexsort((start, tags, ids))
            ids, tags, start, end = ids[o], tags[o], start[o].astype(np.int64), (start + size)[o].astype(np.int64)
            at = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])))) if len(ids) else []
            for i, j in zip(at, np.append(at[1:], len(ids)), strict=True):
                found[int(ids[i]), int(tags[i])] = _merge(start[i:j], end[i:j])
        for blob in texts.column("blob").to_pylist():
            tags, sizes, n, raw, ids, null = unpack(blob)
            offs, of = np.concatenate(([0], np.cumsum(sizes))), np.repeat(np.arange(len(n)), n)
            for i, j in enumerate(of.tolist()):
                data = raw[offs[j] : offs[j + 1]]
                s, e = found.get((int(ids[i]), int(tags[j]) & 0xFFFF), (None, None))
                if s is not None:
                    edge = np.zeros(len(data) + 1, np.int8)
                    edge[s] += 1
                    edge[e] -= 1
                    data = data[np.cumsum(edge[:-1]) == 0]
                kept = data.tobytes().decode("utf-8", "ignore") if as_text else data.tobytes()
                out.append((None if null[i] else int(ids[i]), int(sizes[j]), s.tolist() if s is not None else [], e.tolist() if e is not None else [], kept))
        cols = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string() if as_text else pa.binary()]
        table = pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "n_bytes", "starts", "ends", "kept"])
        streams = [x for x in texts.column("more").to_pylist() if x]
        if streams:
            read = lambda x: pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(x)).read_all()
            other = pa.concat_tables([read(x) for x in streams])
            for name in other.column_names:
                table = table.append_column(name, other.column(name))
        release()
        return table

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, as_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, starts, ends (removed runs, ends exclusive), kept, then ``carry``.

    ``kept`` holds the remaining bytes; with ``as_text`` they are a string and what
    is left of a character cut in two goes as well.  Null texts count as empty.
    Texts shorter than the span keep everything.  Of copies the one with the
    smallest id stays whole and the others lose all; rows that share an id do not
    remove bytes from each other.  A row with a null id comes after all others.
    Columns named in ``carry`` come back unchanged under names of their own
    (``more_0``, ...), so they may clash with nothing; others are not read.  An
    empty table gives no row.
    """
    carry = carry or []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *[F.col(c).alias(f"more_{i}") for i, c in enumerate(carry)])
    main = rows.select("doc_id", "text")
    total = main.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(8, total // bucket_bytes))
    # Fresh names for each use, so that a table may meet what was made from it.
    grouped = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy("bucket")
    asked = grouped(main.mapInArrow(_names(buckets), _SCHEMA)).applyInArrow(_repeated(buckets), _SCHEMA)
    texts = rows.mapInArrow(_texts(buckets), "bucket long, blob binary, more binary")
    parts = grouped(texts).cogroup(grouped(asked)).applyInArrow(_fetch(buckets), _SCHEMA)
    spans = grouped(parts).applyInArrow(_match(buckets), _SCHEMA)
    # The same packed texts as above: Spark reuses their exchange.
    more = "".join(f", more_{i} {rows.schema[i + 2].dataType.simpleString()}" for i in range(len(carry)))
    out = f"doc_id long, n_bytes long, starts array<long>, ends array<long>, kept {'string' if as_text else 'binary'}{more}"
    return grouped(texts).cogroup(grouped(spans)).applyInArrow(_keep(as_text), out)
