"""Encoding and decoding with a merge-type SentencePiece vocabulary under seeded merge-dropout.

Pieces never hold the word mark behind another character, so words are segmented
apart.  An agenda gives each word's best candidate, the adjacent pair whose union
has the best rank, leftmost first.  A candidate is skipped for good if the hash of
the seed, the word, its document and position and the candidate's place says so; a
later merge that changes a neighbour makes a new candidate.  Every occurrence of a
word is drawn by itself, yet every run gives the same pieces.

What a word does without a skip does not vary, so it is remembered: its pieces and
the candidates that were merged.  An occurrence draws for each of these; if none is
skipped it has these pieces, otherwise its own agenda runs.  The agendas of many
short words advance together in arrays; a long word has a heap, so that its time
is its length times a logarithm.

Characters without a piece become byte pieces, as does a word mark that stands in
the text itself, and decoding gives the text back.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_buffer
from .token_counts import vocabulary_path

DROPOUT, SEED = 0.1, 42
#: Merges remembered per process; words and cells of one array; characters from which a word has a heap; words at once; bytes of texts at once.
MEMORY, BATCH, CELLS, LONG, AT_ONCE, SLICE = 4_000_000, 20_000, 400_000, 64, 200_000, 1 << 20
MARK = "▁"
#: Stands for a mark in the text itself; no text holds a lone surrogate.
_LITERAL = "\ud800"
_CHUNKS = re.compile(MARK + "+[^" + MARK + "]*|[^" + MARK + "]+")
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_NONE = np.int64(1) << np.int64(60)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _mix_one(h: int) -> int:
    h = ((h ^ h >> 30) * int(_M1)) & int(_EMPTY)
    h = ((h ^ h >> 27) * int(_M2)) & int(_EMPTY)
    return h ^ h >> 31


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


class _Store:
    """Arrays of many words behind each other in one that grows."""

    def __init__(self, kind: type):
        self.data, self.used = np.empty(1 << 12, kind), 0
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        end = self.used + len(flat)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.used], np.empty(2 * end - self.used, self.data.dtype)])
        self.data[self.used : end] = flat
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used = end


class Pieces:
    """Vocabulary, pair table, segmenter and memory of one model file."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)])
        self.number = {p: i for i, p in enumerate(self.names) if not special[i]}
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(self.names) if model.is_byte(i)}
        self.unknown = model.unk_id()
        score = np.array([model.get_score(i) for i in range(n)])
        rank = np.empty(n, np.int64)
        rank[np.argsort(-score, kind="stable")] = np.arange(n)
        pairs = [((a << 20) | b, i) for p, i in self.number.items() if len(p) > 1 for k in range(1, len(p)) if (a := self.number.get(p[:k])) is not None and (b := self.number.get(p[k:])) is not None]
        self.pairs: dict[int, int] | None = None
        self._table(np.array([k for k, _ in pairs], np.uint64), np.array([i for _, i in pairs], np.int64))
        self.rank, self.by_rank = rank, np.argsort(rank)
        self.character = np.full(0x110000, -1, np.int64)
        single = [p for p in self.number if len(p) == 1]
        self.character[[ord(p) for p in single]] = [self.number[p] for p in single]
        surface = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.names)]
        self.surface, self.surface_size = np.frombuffer(b"".join(surface), np.uint8), np.array([len(x) for x in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        self.dropout = np.uint64(min(1.0, max(0.0, dropout)) * (1 << 32))
        self.seed = np.uint64(seed & int(_EMPTY))
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.pieces, self.merges, self.keys = _Store(np.int32), _Store(np.uint64), np.empty(0, np.uint64)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with few probes, filled by rounds."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, _EMPTY)
        self.value = np.full(len(self.slots), -1, np.int64)
        todo, probe = np.arange(len(keys)), 0
        while len(todo):
            at = (_mix(keys[todo]) >> self.shift).astype(np.int64) + probe
            free = self.value[at] < 0
            self.value[at[free]] = values[todo[free]]
            self.slots[at[free]] = keys[todo[free]]
            todo = todo[self.slots[at] != keys[todo]]
            probe += 1

    def _union(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces make, -1 for none."""
        key = left.astype(np.uint64) << np.uint64(20) | right.astype(np.uint64)
        at = (_mix(key) >> self.shift).astype(np.int64)
        slot = self.slots[at]
        out = np.where(slot == key, self.value[at], -1)
        todo = np.flatnonzero((slot != key) & (slot != _EMPTY))
        while len(todo):
            at[todo] += 1
            slot = self.slots[at[todo]]
            hit = slot == key[todo]
            out[todo[hit]] = self.value[at[todo[hit]]]
            todo = todo[~hit & (slot != _EMPTY)]
        return out

    def key(self, words: list[str]) -> np.ndarray:
        return _mix(np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64) ^ self.seed)

    def segment(self, words: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pieces, number of pieces a word, merges, number of merges a word); skips follow ``keys``, there are none without.

        Short words of similar length advance together, each long word has a heap.
        """
        lens = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lens, kind="stable")
        short = int(np.searchsorted(lens[order], LONG, side="right"))
        got: list[tuple[np.ndarray, ...]] = []
        at = 0
        while at < short:
            end = min(short, at + BATCH)
            while end > at + 1 and lens[order[end - 1]] * (end - at) > CELLS:
                end = at + max(1, (end - at) // 2)
            some = order[at:end]
            got.append(self._together([words[i] for i in some.tolist()], None if keys is None else keys[some]))
            at = end
        got += [self._alone(words[i], None if keys is None else int(keys[i])) for i in order[short:].tolist()]
        if not got:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        flat, sizes, merges, counts = (np.concatenate(x) for x in zip(*got, strict=True))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return (
            flat[_ragged((np.cumsum(sizes) - sizes)[back], sizes[back])], sizes[back],
            merges[_ragged((np.cumsum(counts) - counts)[back], counts[back])], counts[back],
        )

    def _together(self, words: list[str], keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``segment`` for one batch.  Symbols are columns' cells linked to their live neighbours; cell i of a word begins at character i."""
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        wide = int(lens.max())
        inside = np.arange(wide)[:, None] < lens
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = np.full((wide, n), -1, np.int64)
        sym.T[inside.T] = self.character[codes]
        whole = np.arange(wide)[:, None]
        after, before = np.where(whole + 1 < lens, whole + 1, -1), np.broadcast_to(whole - 1, (wide, n)).copy()
        skips = keys is not None and self.dropout > 0

        def candidates(row: np.ndarray, at: np.ndarray, word: np.ndarray) -> np.ndarray:
            """Rank and place of the union of the cells with their right neighbours; ``_NONE`` without one or if skipped."""
            right = after[row, at]
            a, b = sym[row, at], sym[np.maximum(right, 0), at]
            out = np.full(len(row), _NONE)
            ok = np.flatnonzero((right >= 0) & (a >= 0) & (b >= 0))
            made = self._union(a[ok], b[ok])
            fits = made >= 0
            ok, made = ok[fits], made[fits]
            if skips and len(ok):
                keep = (_mix(keys[word[ok]] + _place(row[ok], right[ok], made)) >> np.uint64(32)) >= self.dropout
                ok, made = ok[keep], made[keep]
            out[ok] = self.rank[made] << 32 | row[ok]
            return out

        kept: list[tuple[np.ndarray, np.ndarray]] = []
        merged: list[tuple[np.ndarray, np.ndarray]] = []
        cand = np.full((wide, n), _NONE)
        r, c = np.nonzero(inside)
        cand[r, c] = candidates(r, c, c)
        alive = col = np.arange(n)  # words that still merge, and their columns
        while True:
            best = cand.min(0)
            go = best < _NONE
            count = int(np.count_nonzero(go))
            if not count:
                break
            if 2 * count < len(col):  # leave finished words behind
                kept.append((alive, sym))
                sym, after, before, cand = sym[:, go], after[:, go], before[:, go], cand[:, go]
                alive, best, col = alive[go], best[go], np.arange(count)
                k = col
            else:
                k = np.flatnonzero(go)
                best = best[k]
            row, made = best & 0xFFFFFFFF, self.by_rank[best >> 32]
            right = after[row, k]
            if not skips:
                merged.append((alive[k], _place(row, right, made)))
            nxt = after[right, k]
            sym[row, k], sym[right, k] = made, -2
            after[row, k], cand[right, k] = nxt, _NONE
            has = nxt >= 0
            before[nxt[has], k[has]] = row[has]
            prev = before[row, k]
            has = np.flatnonzero(prev >= 0)
            both, at = np.concatenate([row, prev[has]]), np.concatenate([k, k[has]])
            cand[both, at] = candidates(both, at, alive[at])
        kept.append((alive, sym))
        flat, cells, sizes = self._done(kept, lens)
        bad = np.flatnonzero(flat < 0)
        if len(bad):  # byte pieces for characters without one
            owner = np.repeat(np.arange(n), sizes)[bad]
            codes = codes[(np.cumsum(lens) - lens)[owner] + cells[bad]]
            spelt = [self._spell(x) for x in map(chr, codes.tolist())]
            width = np.ones(len(flat), np.int64)
            width[bad] = [len(x) for x in spelt]
            sizes = sizes + np.bincount(owner, weights=width[bad] - 1, minlength=n).astype(np.int64)
            fresh = np.repeat(flat, width)
            fresh[_ragged((np.cumsum(width) - width)[bad], width[bad])] = list(chain.from_iterable(spelt))
            flat = fresh
        if not merged:
            return flat.astype(np.int32), sizes, np.zeros(0, np.uint64), np.zeros(n, np.int64)
        owner, place = (np.concatenate(x) for x in zip(*merged, strict=True))
        return flat.astype(np.int32), sizes, place[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)

    @staticmethod
    def _done(kept: list[tuple[np.ndarray, np.ndarray]], lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Live symbols of every word in order, their cells, and their number a word; the last state stored of a word counts."""
        n = len(lens)
        last = np.empty(n, np.int64)
        for i, (alive, _) in enumerate(kept):
            last[alive] = i
        sizes, parts, owners, cells = np.zeros(n, np.int64), [], [], []
        for i, (alive, sym) in enumerate(kept):
            mine = np.flatnonzero(last[alive] == i)
            rows = sym[:, mine].T
            live = rows != -2
            live &= np.arange(rows.shape[1]) < lens[alive[mine]][:, None]
            parts.append(rows[live])
            cells.append(np.nonzero(live)[1])
            count = live.sum(1)
            sizes[alive[mine]] = count
            owners.append(np.repeat(alive[mine], count))
        order = np.argsort(np.concatenate(owners), kind="stable")
        return np.concatenate(parts)[order], np.concatenate(cells)[order], sizes

    def _spell(self, character: str) -> list[int]:
        return [self.bytes.get(z, self.unknown) for z in (MARK if character == _LITERAL else character).encode()]

    def _alone(self, word: str, key: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``segment`` for one word, by a heap."""
        if self.pairs is None:
            full = self.value >= 0
            self.pairs = dict(zip(self.slots[full].tolist(), self.value[full].tolist(), strict=True))
        n, pairs, rank, by_rank = len(word), self.pairs, self.rank, self.by_rank
        sym = self.character[np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)].tolist()
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        limit = int(self.dropout) if key is not None else 0
        heap: list[tuple[int, int, int, int]] = []
        merges = []

        def offer(row: int) -> tuple[int, int, int, int] | None:
            right = after[row]
            if right < 0 or sym[row] < 0 or sym[right] < 0:
                return None
            made = pairs.get(sym[row] << 20 | sym[right])
            if made is None or limit and _mix_one((key + (row << 42) + (right << 21) + made) & int(_EMPTY)) >> 32 < limit:
                return None
            return int(rank[made]), row, right, sym[right]

        heap = [x for x in map(offer, range(n - 1)) if x]
        heapq.heapify(heap)
        while heap:
            place, row, right, other = heapq.heappop(heap)
            made = int(by_rank[place])
            # Stale if a side has merged since: the pair is as it was only if it still makes the piece.
            if sym[row] < 0 or after[row] != right or sym[right] != other or pairs.get(sym[row] << 20 | other) != made:
                continue
            if key is None:
                merges.append((row << 42) + (right << 21) + made)
            sym[row], sym[right], after[row] = made, -2, after[right]
            if after[row] >= 0:
                before[after[row]] = row
            for at in (row, before[row]):
                if at >= 0 and (x := offer(at)):
                    heapq.heappush(heap, x)
        out: list[int] = []
        for at, x in enumerate(sym):
            if x >= 0:
                out.append(x)
            elif x == -1:
                out += self._spell(word[at])
        return np.array(out, np.int32), np.array([len(out)]), np.array(merges, np.uint64), np.array([len(merges)])

    def words(self, text: str) -> list[str]:
        """The words of a text with spaces as marks and one mark put before the text."""
        return _CHUNKS.findall(MARK + text.replace(MARK, _LITERAL).replace(" ", MARK)) if text else []

    def _encode(self, words: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, number of pieces a word): remembered ones where no merge is skipped."""
        if self.merges.used > MEMORY:
            self._forget()
        fresh = list(set(words).difference(self.seen))
        if fresh:
            flat, sizes, merges, counts = self.segment(fresh, None)
            self.seen.update(zip(fresh, range(len(self.keys), len(self.keys) + len(fresh)), strict=True))
            self.pieces.add(flat, sizes)
            self.merges.add(merges, counts)
            self.keys = np.concatenate([self.keys, self.key(fresh)])
        w = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        source, starts, sizes = self.pieces.data[: self.pieces.used], self.pieces.starts[w], self.pieces.sizes[w]
        if self.dropout:
            keys, counts = _mix(self.keys[w] ^ draws), self.merges.sizes[w]
            drawn = _mix(np.repeat(keys, counts) + self.merges.data[_ragged(self.merges.starts[w], counts)])
            own = np.unique(np.repeat(np.arange(len(w)), counts)[drawn >> np.uint64(32) < self.dropout])
            if len(own):
                flat, n, _, _ = self.segment([words[i] for i in own.tolist()], keys[own])
                starts[own], sizes[own] = len(source) + np.cumsum(n) - n, n
                source = np.concatenate([source, flat])
        return source[_ragged(starts, sizes)], sizes

    def encode_many(self, texts: list[str], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, offsets of the texts); every occurrence of a word has its own draw, from its text's start and its position."""
        cut = [self.words(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = list(chain.from_iterable(cut))
        first = np.repeat(_mix(np.array(starts, np.uint64)), counts)
        draws = _mix(first + (_ragged(np.zeros(len(cut), np.int64), counts) + 1).astype(np.uint64))
        parts = [self._encode(flat[lo : lo + AT_ONCE], draws[lo : lo + AT_ONCE]) for lo in range(0, len(flat), AT_ONCE)]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        pieces, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pieces, _offsets(sizes)[_offsets(counts)]

    def encode(self, texts: list[str], starts: list[int]) -> list[list[int]]:
        flat, offs = self.encode_many(texts, starts)
        return [flat[s:e].tolist() for s, e in zip(offs[:-1], offs[1:])]

    def decode_many(self, flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts of piece ids."""
        sizes = self.surface_size[flat]
        data = self.surface[_ragged(self.surface_start[flat], sizes)]
        offs = _offsets(sizes)[offs]
        some = np.flatnonzero(offs[1:] > offs[:-1])
        some = some[data[offs[some]] == 32]  # the space that stands for the mark before the text
        data = np.delete(data, offs[some])
        gone = np.zeros(len(offs), np.int64)
        gone[some + 1] = 1
        return data, offs - np.cumsum(gone)

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids."""
        return self.decode_many(np.array(ids, np.int64), np.array([0, len(ids)]))[0].tobytes().decode("utf-8", "replace")


def _place(row: np.ndarray, right: np.ndarray, made: np.ndarray) -> np.ndarray:
    """A candidate: where its sides begin and what they make."""
    return (row.astype(np.uint64) << np.uint64(42)) + (right.astype(np.uint64) << np.uint64(21)) + made.astype(np.uint64)


@lru_cache(2)
def _coder(path: str, dropout: float, seed: int) -> Pieces:
    """One for all tasks of a worker process."""
    return Pieces(path, dropout, seed)


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", dropout: float = DROPOUT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, pieces (ids), decoded (the text made from them), lossless (whether that is the text).

    The draws of a row follow from its id, from 0 for a null id.  Null and empty
    texts have no pieces.  Other columns are not read; repeated rows give repeated
    results and an empty table none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary_path(model), dropout, seed)
        for b in batches:
            raw, offs = text_buffer(b.column(1))
            lo = 0
            while lo < len(b):
                hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE, side="right")) - 1)
                part, own = b.slice(lo, hi - lo), offs[lo : hi + 1] - offs[lo]
                data = raw[offs[lo] : offs[hi]]
                texts = [x or "" for x in part.column(1).to_pylist()]
                start = [0 if i is None else xxhash.xxh64_intdigest(str(i), seed & 0xFFFFFFFF) for i in part.column(0).to_pylist()]
                flat, at = coder.encode_many(texts, start)
                back, ends = coder.decode_many(flat, at)
                same = np.array_equal(ends, own) and np.array_equal(back, data)
                lossless = np.array([same or np.array_equal(back[s:e], data[x:y]) for s, e, x, y in zip(ends[:-1], ends[1:], own[:-1], own[1:])], bool)
                made = [back[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                arrays = [part.column(0), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat)), pa.array(made, pa.string()), pa.array(lossless)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "pieces", "decoded", "lossless"])
                lo = hi

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, pieces array<int>, decoded string, lossless boolean")
