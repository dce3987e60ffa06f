"""Exact top-k search (6): MaxScore over posting lists, shard by shard.

The components of the vectors are terms, their integer weights the impacts.  A shard of
rows holds for each term and sign a posting list (rows, weights).  A query's term t
can add at most U_t = max(q_t * w) over the shard's postings.  Terms ordered by U_t
are split: the non-essential ones are the longest run of small bounds whose sum stays below
the current threshold (the k-th best score so far), as a row found in none of the
others cannot reach it.  The essential lists are traversed and added up; then the
non-essential terms are probed from the largest bound down, for those rows only whose
score so far plus all bounds to come still competes (ties compete, since they go to the smaller
id).  Rows are taken in slices, so that the threshold rises early.  Shards'
best rows are merged by rank.

Scores are exact integers; nothing is approximated or cut.

Odd input: vectors that are null, empty, or hold a null or non-finite component take no part;
vectors of different lengths are compared as if padded with zeros; repeated rows (same id and
vector) are one candidate; a query's own id is no candidate; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.llm.blocks import as_table, best, flat_ids, in_shards, matrix, ranked, searched, usable

SLICE = 2048


class Shard:
    """Posting lists of a slice of rows: for each term the rows with a positive and with a negative weight."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.lists = []
        for t in range(weights.shape[1]):
            w = weights[:, t]
            rows = np.flatnonzero(w)
            self.lists.append((rows, w[rows]))
        self.high, self.low = weights.max(axis=0, initial=0), weights.min(axis=0, initial=0)

    def search(self, query: np.ndarray, bar: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows with their scores, among them all whose score is ``bar`` or more and above 0 in bound."""
        bound = np.maximum(query * self.high, query * self.low)
        order = np.argsort(bound, kind="stable")
        upto = np.cumsum(bound[order])
        split = int(np.searchsorted(upto, bar, side="left"))       # the sum of the first `split` bounds is below bar
        score = np.zeros(len(self.weights), dtype=np.int64)
        seen = np.zeros(len(score), dtype=bool)
        for t in order[split:]:
            if query[t]:
                rows, w = self.lists[t]
                score[rows] += query[t] * w
                seen[rows] = True
        rows = np.flatnonzero(seen) if split else np.arange(len(score))
        score = score[rows]
        for i in range(split - 1, -1, -1):
            alive = score + upto[i] >= bar
            rows, score = rows[alive], score[alive]
            if not len(rows):
                break
            score = score + query[order[i]] * self.weights[rows, order[i]]
        use = score >= bar
        return rows[use], score[use]


def _search(keep: int):
    def build(left: pa.Table):
        held = matrix(left.column("vector")).astype(np.int64)
        ids, row = flat_ids(left.column("ids"))
        first = np.searchsorted(row, np.arange(len(held) + 1))
        shards: dict[int, list[Shard]] = {}                     # by width: queries may be longer than all rows

        def answer(right: pa.Table) -> pa.Table:
            asked = matrix(right.column("vector"), held.shape[1]).astype(np.int64)
            width = asked.shape[1]
            if width not in shards:
                wide = np.pad(held, ((0, 0), (0, width - held.shape[1])))
                shards[width] = [Shard(wide[lo: lo + SLICE]) for lo in range(0, len(held), SLICE)]
            names = right.column("vec_id").to_numpy()
            got = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in names]
            for i, shard in enumerate(shards[width]):
                for k, (name, q) in enumerate(zip(names.tolist(), asked, strict=True)):
                    found, score = got[k]
                    bar = score[-1] if len(score) == keep else -np.inf
                    rows, new = shard.search(q, bar)
                    if not len(rows):
                        continue
                    rows = rows + i * SLICE
                    n = first[rows + 1] - first[rows]
                    at = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    other = ids[at] != name
                    found, score = np.concatenate([found, ids[at][other]]), np.concatenate([score, np.repeat(new, n)[other]])
                    top = best(score, found, keep)
                    got[k] = found[top], score[top]
            return as_table([(q, i, s) for q, (i, s) in zip(names.tolist(), got, strict=True)], pa.int64())
        return answer
    return build


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest inner products of floor(scale * component)."""
    vectors = usable(rows, id_col, vector_col, nonzero=False).withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double")))
    items, shards = in_shards(vectors, k + 1, shard_rows)
    found = searched(items, vectors.where(is_query).distinct(), shards, _search(k), "query_id long, vec_id long, score long")
    return ranked(found, k)
