"""A compressed FM-index over a sequence of numbers: Burrows-Wheeler transform in a wavelet matrix, common prefixes as bits.

The suffix array exists while an index is built only.  What stays: the wavelet matrix, for each depth up to the one that
matters a bit per row that says where the rows' first symbols change, and one place per class of rows."""

from __future__ import annotations

import numpy as np

_SIX, _LOW = np.int64(6), np.uint64(63)


class BitVector:
    """Packed bits with a running count per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        w = i >> _SIX
        low = (np.uint64(1) << (i.astype(np.uint64) & _LOW)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position of the k-th one, counted from 0."""
        w = np.searchsorted(self.before, k, side="right") - 1
        left, word = k - self.before[w], self.words[w]
        at = np.zeros(len(k), dtype=np.uint64)
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count((word >> at) & ((np.uint64(1) << np.uint64(width)) - np.uint64(1))).astype(np.int64)
            on = left >= ones
            left = left - ones * on
            at += np.uint64(width) * on.astype(np.uint64)
        return (w << _SIX) + at.astype(np.int64)


class WaveletMatrix:
    """A sequence over 0..sigma-1 in log2(sigma) bit vectors, with rank by symbol."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1 == 1
            self.levels.append((BitVector(bit), int(len(seq) - bit.sum())))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.begin = self._walk(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, (vector, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            ones = vector.rank(i)
            i = np.where((symbol >> b) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs in front of position ``i``."""
        return self._walk(symbol, i) - self.begin[symbol]


def sorted_suffixes(symbols: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments over symbols 1 and up, each closed by a separator of its own (stored as 0): the text, its suffixes in order,
    and how many symbols each suffix shares with the one before it (``depth`` at most)."""
    n_seg = len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    total = int(ends[-1]) + 1
    text = np.zeros(total, dtype=np.int64)
    inner = np.ones(total, dtype=bool)
    inner[ends] = False
    text[inner] = symbols
    # ranks by the first `width` symbols; separators differ, so the order is complete once every suffix has met its own
    rank = text + n_seg
    rank[ends] = np.arange(n_seg)
    ranks = [(1, rank)]
    while ranks[-1][0] <= int(lengths.max(initial=0)):
        width, rank = ranks[-1]
        shifted = np.full(total, -1, dtype=np.int64)
        shifted[:-width] = rank[width:] if width < total else shifted[:-width]
        pair = rank * np.int64(total + n_seg + int(symbols.max(initial=0)) + 3) + shifted + 1
        ranks.append((width * 2, np.unique(pair, return_inverse=True)[1]))
    suffixes = np.argsort(ranks[-1][1], kind="stable")
    shared = np.zeros(total, dtype=np.int64)
    for width, rank in reversed(ranks):
        here = np.minimum(suffixes[1:] + shared[1:], total - 1)
        there = np.minimum(suffixes[:-1] + shared[1:], total - 1)
        shared[1:] += width * (rank[here] == rank[there])
    return text, suffixes, np.minimum(shared, depth)


class FmIndex:
    """Index of segments over symbols 1..sigma-1.  ``depth`` is the length of the matches that matter; ``places`` gives each
    symbol a number, and a class of suffixes that share ``depth`` symbols keeps the least of them."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, depth: int, places: np.ndarray):
        text, suffixes, shared = sorted_suffixes(symbols, lengths, depth)
        self.depth, self.rows = depth, len(text)
        self.sigma = int(symbols.max(initial=0)) + 1
        self.wavelet = WaveletMatrix(text[suffixes - 1], self.sigma)
        count = np.bincount(text, minlength=self.sigma)
        self.first_row = np.cumsum(count) - count
        # for each depth, a one where the rows' first symbols change
        self.cuts = BitVector(np.concatenate([*(shared < d for d in range(1, depth + 1)), np.ones(1, dtype=bool)]))
        cut = np.flatnonzero(shared < depth)
        place_at = np.full(self.rows, np.iinfo(np.int64).max)
        place_at[text > 0] = places
        self.least = np.minimum.reduceat(place_at[suffixes], cut)
        self.classes_before = int(self.cuts.rank(np.array([(depth - 1) * self.rows]))[0])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the rows whose suffixes begin with ``symbol`` and go on as the rows lo..hi."""
        return self.first_row[symbol] + self.wavelet.rank(symbol, lo), self.first_row[symbol] + self.wavelet.rank(symbol, hi)

    def widen(self, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that share their first ``depth`` symbols with ``row``."""
        base = (np.maximum(depth, 1) - 1) * self.rows
        k = self.cuts.rank(base + row + 1)
        lo, hi = self.cuts.select(k - 1) - base, self.cuts.select(k) - base
        return np.where(depth > 0, lo, 0), np.where(depth > 0, hi, self.rows)

    def first_place(self, row: np.ndarray) -> np.ndarray:
        """The least place among the suffixes that share their first ``self.depth`` symbols with ``row``."""
        return self.least[self.cuts.rank((self.depth - 1) * self.rows + row + 1) - 1 - self.classes_before]


def matching_statistics(index: FmIndex, symbols: np.ndarray, lengths: np.ndarray, least: int = 1):
    """Streams runs of symbols through the index from their ends, all side by side.  Yields, for each position at which the
    longest match has ``least`` symbols or more, (run, position in the run, match length, first row, last row + 1).

    A match that cannot go on is shortened from its end to the longest prefix that can: never by more than is
    needed, but for matches beyond the index's depth, which start anew from ``index.depth`` symbols."""
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, size = begin[order], lengths[order]
    lo = np.zeros(len(size), dtype=np.int64)
    hi = np.full(len(size), index.rows, dtype=np.int64)
    matched = np.zeros(len(size), dtype=np.int64)
    for step in range(int(size[0]) if len(size) else 0):
        k = int(np.searchsorted(-size, -step, side="left"))      # runs longer than step
        c = symbols[begin[:k] + size[:k] - 1 - step]
        known = c < index.sigma
        a, b = index.extend(np.where(known, c, 0), lo[:k], hi[:k])
        longer = matched[:k] + 1
        lost = ~known | (a >= b)
        if lost.any():
            u = np.flatnonzero(lost)
            a[u], b[u], longer[u] = _shortened(index, c[u], known[u], lo[u], matched[u])
        lo[:k], hi[:k], matched[:k] = a, b, longer
        use = np.flatnonzero(longer >= least)
        if len(use):
            yield order[use], size[use] - 1 - step, longer[use], lo[use], hi[use]


def _shortened(index: FmIndex, c: np.ndarray, known: np.ndarray, lo: np.ndarray, matched: np.ndarray):
    """The longest prefix of each match that ``c`` extends, found by doubling steps: (first row, last row + 1, length) after it."""
    most = np.where(known, np.minimum(matched, index.depth) - 1, -1)
    most = np.where(known & (matched == 0), -1, most)            # nothing is shorter than an empty match
    good = np.full(len(c), -1, dtype=np.int64)
    a, b = np.zeros(len(c), dtype=np.int64), np.full(len(c), index.rows, dtype=np.int64)
    width = 1 << max(0, int(most.max(initial=0)) + 1).bit_length()
    while width:
        u = np.flatnonzero(good + width <= most)
        if len(u):
            x, y = index.extend(c[u], *index.widen(lo[u], good[u] + width))
            ok = x < y
            v = u[ok]
            a[v], b[v] = x[ok], y[ok]
            good[v] += width
        width >>= 1
    return a, b, good + 1
