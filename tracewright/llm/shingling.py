"""Words and shingles of many texts as numbers, without a step per word.

Texts lie behind each other in one buffer.  A word is lower-cased (A-Z) and named by
a polynomial over its bytes, so that a running sum over the buffer gives all words;
a shingle is named by a polynomial over its words.  Names have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import text_buffer

#: Bytes hashed at once.
WINDOW = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP, _FIRST, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xA0761D6478BD642F)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(max(0, n - 1), base))), dtype=np.uint64)[:n]


def _words(raw: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, name) of each word of a piece; ``edge`` marks where a text begins, and one place behind the piece."""
    low = raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    starts = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | edge[:-1]))
    ends = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | edge[1:])) + 1
    sums = np.concatenate(([np.uint64(0)], np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)))))
    names = (sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts]
    return starts, mix(names + (ends - starts).astype(np.uint64) * _STEP)


def words_of(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names of all words in order, number of words of each text); pieces end at a space or where a text ends."""
    starts, names, at, n = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0, len(raw)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    while at < n:
        end = min(n, at + WINDOW)
        while end < n and not edge[end]:
            some = raw[end : end + WINDOW]
            stop = np.flatnonzero((some == 32) | ((some >= 9) & (some <= 13)) | edge[end : end + len(some)])
            if len(stop):
                end += int(stop[0])
                break
            end += len(some)
        s, w = _words(raw[at:end], edge[at : end + 1])
        starts.append(s + at)
        names.append(w)
        at = end
    first = np.concatenate(starts)
    return np.concatenate(names), np.diff(np.searchsorted(first, offs))


def shingles_of(names: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(names of all shingles, number of shingles of each text); a text of fewer words is one shingle."""
    sizes = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(counts)
    at, stop = ragged(ends - counts, sizes), np.repeat(ends, sizes)
    out = np.zeros(len(at), np.uint64)
    for j in range(words):
        inside = at + j < stop
        out = out * _BASE + np.where(inside, names[np.minimum(at + j, max(0, len(names) - 1))], np.uint64(0)) if len(names) else out
    return mix(out), sizes


def distinct(names: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different names of each text, and how many."""
    if not len(names):
        return names, sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((names, owner))
    names, owner = names[order], owner[order]
    new = np.concatenate(([True], (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])))
    return names[new], np.bincount(owner[new], minlength=len(sizes))


def codes_of(names: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SimHash of each text from its different words: bit i is set if over half of them have it; 0 without words."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(names.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(sizes) - sizes)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits((2 * ones > sizes[some][:, None]).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def digests_of(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent names of the word sequence of each text; 0 without words."""
    out = np.zeros((2, len(counts)), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        place = ragged(np.zeros(len(some), np.int64), counts[some])
        for i, base in enumerate((_FIRST, _SECOND)):
            sums = np.add.reduceat(mix(names ^ base) * _powers(base, int(counts.max()))[place], starts)
            out[i, some] = mix(sums + counts[some].astype(np.uint64))
    return out[0], out[1]


def slices_of(column: pa.Array, most: int = WINDOW) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end, bytes, offsets) of runs of texts of about ``most`` bytes; a longer text comes alone."""
    raw, offs = text_buffer(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def shingle_sets(raw: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingles of each text, and how many."""
    return distinct(*shingles_of(*words_of(raw, offs), words))
