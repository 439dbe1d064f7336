"""Suffix sort by hash comparison, for many groups of suffixes at once.

Suffixes of one byte buffer are compared through prefix polynomial hashes: a
binary search over hash equality gives the length of the common extension in a
logarithmic number of steps, and the byte after it decides.  A bottom-up
mergesort runs on all groups together; every element finds its place in the
sibling run by binary search.  Equal neighbours are confirmed byte by byte, so a
hash collision costs time, never a wrong result.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PAD = 64


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


class Suffixes:
    """Suffix comparisons over a buffer; each suffix ends after ``cap`` bytes at most."""

    def __init__(self, raw: np.ndarray):
        self.raw = np.concatenate([raw, np.zeros(_PAD, np.uint8)])
        n = len(self.raw)
        self.up = _powers(_BASE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = _powers(_INVERSE, n)
        terms *= self.raw + np.uint64(1)
        np.cumsum(terms, out=self.sums[1:])

    def same(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the polynomial hashes of ``length`` bytes at x and at y agree."""
        return (self.sums[x + length] - self.sums[x]) * self.up[x] == (self.sums[y + length] - self.sums[y]) * self.up[y]

    def common(self, x: np.ndarray, y: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at x and y, ``cap`` at most."""
        lo, hi = np.zeros(len(x), np.int64), cap.copy()
        for _ in range(int(cap.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            eq = self.same(x, y, mid)
            lo = np.where(eq, mid, lo)
            hi = np.where(eq, hi, np.maximum(mid - 1, lo))
        return lo

    def less(self, x, y, cap_x, cap_y, or_equal) -> np.ndarray:
        cap = np.minimum(cap_x, cap_y)
        n = self.common(x, y, cap)
        inside = n < cap
        bx, by = self.raw[x + np.where(inside, n, 0)], self.raw[y + np.where(inside, n, 0)]
        tie = (cap_x < cap_y) | (or_equal & (cap_x == cap_y))
        return np.where(inside, bx < by, tie)

    def heads(self, x: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """The first 8 bytes of each suffix as a number whose order is theirs."""
        out = np.zeros(len(x), np.uint64)
        for i in range(8):
            b = np.where(cap > i, self.raw[np.minimum(x + i, len(self.raw) - 1)], 0)
            out = (out << np.uint64(8)) | b.astype(np.uint64)
        return out

    def equal_bytes(self, x: np.ndarray, y: np.ndarray, length: np.ndarray, step: int = 1 << 22) -> np.ndarray:
        """Byte comparison of pairs of stretches of the same length."""
        out = np.ones(len(x), bool)
        total = np.cumsum(length)
        at = 0
        while at < len(x):
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + step, side="right")))
            n = length[at:end]
            row = np.repeat(np.arange(end - at), n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            bad = self.raw[x[at:end][row] + within] != self.raw[y[at:end][row] + within]
            out[at:end][row[bad]] = False
            at = end
        return out

    def shared(self, group: np.ndarray, x: np.ndarray, cap: np.ndarray) -> np.ndarray:
        """Elements whose hash over the full length another one of the group has; the others equal none."""
        h = (self.sums[x + cap] - self.sums[x]) * self.up[x] + group * np.uint64(0xC2B2AE3D27D4EB4F) + cap.astype(np.uint64)
        order = np.argsort(h)
        h = h[order]
        twin = np.zeros(len(x) + 1, bool)
        twin[1:-1] = h[1:] == h[:-1]
        return np.sort(order[twin[1:] | twin[:-1]])

    def sort(self, group: np.ndarray, x: np.ndarray, cap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, class): elements in order of group and suffix; equal suffixes of a group share a class."""
        n = len(x)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        head = self.heads(x, cap)
        leader = self._leaders(group, head, x, cap)
        kept = np.flatnonzero(leader == np.arange(n))
        place = np.empty(n, np.int64)
        place[kept[self._merge_sort(group[kept], head[kept], x[kept], cap[kept])]] = np.arange(len(kept))
        order = np.argsort(place[leader], kind="stable")
        return self._classes(order, group, x, cap)

    def _leaders(self, group, head, x, cap, rounds: int = 4) -> np.ndarray:
        """An element of the same group that each element equals by hash, so that copies are merged once."""
        leader = np.arange(len(x))
        order = np.lexsort((head, group))
        for _ in range(rounds):
            g, h = group[order], head[order]
            opens = np.concatenate(([True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])))
            first = order[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
            rest = np.flatnonzero(~opens & (cap[order] == cap[first]))
            rest = rest[self.same(x[order[rest]], x[first[rest]], cap[order[rest]])]
            leader[order[rest]] = first[rest]
            opens[rest] = True  # settled, like the leaders
            order = order[~opens]
            if not len(order):
                break
        return leader

    def _merge_sort(self, group, head, x, cap) -> np.ndarray:
        n = len(x)
        order = np.lexsort((head, group))
        g, h = group[order], head[order]
        opens = np.concatenate(([True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])))
        first = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        size = np.diff(np.append(first, n))
        begin = first[run]
        width = 1
        while True:
            act = np.flatnonzero(size[run] > width)  # elements of runs not sorted yet
            if not len(act):
                break
            s, e = begin[act], begin[act] + size[run[act]]
            r = (act - s) // width
            sib = s + (r ^ 1) * width
            live = sib < e
            act, s, e, r, sib = act[live], s[live], e[live], r[live], sib[live]
            lo, hi = sib.copy(), np.minimum(sib + width, e)
            mine, right = order[act], (r & 1).astype(bool)
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                other = order[mid]
                m = mine[todo]
                before = self.less(x[other], x[m], cap[other], cap[m], right[todo])
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            place = s + (r >> 1) * 2 * width + (act - s - r * width) + (lo - sib)
            new = order.copy()
            new[place] = mine
            order = new
            width *= 2
        return order

    def _classes(self, order, group, x, cap) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        a, b = order[:-1], order[1:]
        equal = (group[a] == group[b]) & (cap[a] == cap[b])
        at = np.flatnonzero(equal)
        hashed = self.same(x[a[at]], x[b[at]], cap[a[at]])
        at = at[hashed]
        exact = self.equal_bytes(x[a[at]], x[b[at]], cap[a[at]])
        if not exact.all():  # a collision: order the elements of these groups by their bytes
            for k in np.unique(group[a[at[~exact]]]):
                where = np.flatnonzero(group[order] == k)
                order[where] = sorted(order[where], key=lambda i: self.raw[x[i] : x[i] + cap[i]].tobytes())
            a, b = order[:-1], order[1:]
            at = np.flatnonzero((group[a] == group[b]) & (cap[a] == cap[b]))
            exact = self.equal_bytes(x[a[at]], x[b[at]], cap[a[at]])
        equal = np.zeros(n - 1, bool)
        equal[at[exact]] = True
        return order, np.concatenate(([0], np.cumsum(~equal)))


def least_by(classes: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For ascending ``classes`` the smallest value of each element's class."""
    if not len(classes):
        return value
    first = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
    return np.minimum.reduceat(value, first)[classes - classes[0]]
