"""Inverted multi-index over the two halves of vectors, searched best cell first with bounds that certify the result.

Each half has a codebook; a cell (i, j) lists the rows whose halves are nearest to the codewords i and j.  A row in it
cannot score above

    (q1 . c_i + |q1| R_i) + (q2 . c_j + |q2| R_j),       R: the greatest distance of a row's half to its codeword.

The multi-sequence heap walks the cells by falling sum of the two half bounds.  Once the next bound lies below
what a search still needs, no row in the cells left can matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np

SLACK = 1e-9                        # relative; for rounding in the bounds


def codebook(sample: np.ndarray, words: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Codewords of half-vectors by Lloyd's iterations."""
    points = np.unique(sample, axis=0) if len(sample) else np.zeros((1, sample.shape[1]))
    rng = np.random.default_rng(seed)
    centre = points[rng.permutation(len(points))[:words]].astype(float)
    for _ in range(rounds):
        near = nearest_word(points, centre)
        n = np.bincount(near, minlength=len(centre))
        sums = np.zeros_like(centre)
        np.add.at(sums, near, points)
        centre = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest_word(halves: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(axis=1) - 2 * (halves @ words.T), axis=1) if len(halves) else np.zeros(0, np.int64)


def best_first(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs (i, j) by falling first[i] + second[j]: the multi-sequence heap."""
    one, two = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b = first[one].tolist(), second[two].tolist()
    heap, done = [(-(a[0] + b[0]), 0, 0)], [0] * len(a)        # done[i]: pairs of row i that were taken
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, one[i], two[j]
        done[i] = j + 1
        if i + 1 < len(a) and done[i + 1] == j:                # (i + 1, j - 1) is taken
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))


class MultiIndex:
    """The rows of one shard in cells."""

    def __init__(self, vectors: np.ndarray, words: tuple[np.ndarray, np.ndarray]):
        self.half = words[0].shape[1]
        halves = vectors[:, : self.half], vectors[:, self.half:]
        code = [nearest_word(h, w) for h, w in zip(halves, words, strict=True)]
        self.order = np.lexsort((code[1], code[0]))
        self.vectors = vectors[self.order]
        cell = (code[0] * len(words[1]) + code[1])[self.order]
        self.starts = np.searchsorted(cell, np.arange(len(words[0]) * len(words[1]) + 1)).tolist()
        self.words, self.radii = words, []
        for h, w, c in zip(halves, words, code, strict=True):
            away = np.sqrt(((h - w[c]) ** 2).sum(axis=1))
            self.radii.append(np.array([away[c == k].max(initial=-np.inf) for k in range(len(w))]))     # no row: no bound
        self.visited = 0

    def search(self, query: np.ndarray, needed: Callable[[np.ndarray, np.ndarray], float], batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the cells visited; all rows not returned score less than ``needed`` of those."""
        parts = query[: self.half], query[self.half:]
        size = float(np.abs(query).sum() * max(1.0, np.abs(self.vectors).max(initial=0)))
        bounds = [w @ q + np.sqrt(q @ q) * np.where(np.isfinite(r), r, 0) + SLACK * size for w, q, r in zip(self.words, parts, self.radii, strict=True)]
        bounds = [np.where(np.isfinite(r), b, -np.inf) for b, r in zip(bounds, self.radii, strict=True)]
        rows, scores, take, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0

        def score() -> None:
            at = np.concatenate([np.arange(a, z) for a, z in take])
            rows.append(self.order[at])
            scores.append(np.rint(self.vectors[at] @ query).astype(np.int64) if size < 2**52
                          else self.vectors[at].astype(np.int64) @ query.astype(np.int64))
            take.clear()

        for bound, i, j in best_first(*bounds):
            if bound == -np.inf:
                break
            if n >= batch:                                   # look whether the next bound still matters
                score()
                n, batch = 0, batch * 2
                if bound < needed(np.concatenate(rows), np.concatenate(scores)):
                    break
            a, z = self.starts[i * len(self.words[1]) + j], self.starts[i * len(self.words[1]) + j + 1]
            if z > a:
                take.append((a, z))
                n += z - a
        if take:
            score()
        out = np.concatenate(rows), np.concatenate(scores)
        self.visited += len(out[0])
        return out
