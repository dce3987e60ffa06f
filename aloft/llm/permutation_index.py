"""Approximate nearest neighbours (4): permutation index with pivot inverted files.

``pivots`` vectors, a bounded sample, are fixed.  A vector is represented by its ``length``
nearest pivots in order; the inverted file of a pivot lists the vectors that rank it,
with its place.  A query walks the files of its own pivots and adds up, for
each vector met, what the shared pivots take off the footrule distance

    sum over pivots |place in query - place in vector|   (place ``length`` where unranked).

The ``share`` of a shard's vectors that come nearest by footrule are reranked by exact cosine.  All
vectors are indexed, in shards; a shard's best by exact cosine are merged by rank.

Recall on the test tables (random directions, the hardest case) is measured in the tests and
stated in the README.

Odd input: vectors that are null, empty, zero, or hold a null or non-finite component
take no part; vectors of different lengths are compared as if padded with zeros; equal vectors tie and the
smaller ids win; repeated rows are one candidate; a query's own id is no candidate; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.llm.blocks import as_table, best, flat_ids, in_shards, matrix, ranked, searched, usable


def cosine(queries: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Cosines of one query with rows of vectors, in double precision, each summed in the same order."""
    dot = np.einsum("j,ij->i", queries, items)
    return dot / (np.sqrt(np.einsum("j,j->", queries, queries)) * np.sqrt(np.einsum("ij,ij->i", items, items)))


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """For each vector its ``length`` nearest pivots (by cosine), nearest first, ties to the earlier pivot."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :length]


class InvertedFiles:
    """For each pivot the rows that rank it and the place they give it."""

    def __init__(self, ranked_pivots: np.ndarray, pivots: int):
        n, self.length = ranked_pivots.shape
        flat = ranked_pivots.ravel()
        by = np.argsort(flat, kind="stable")
        cut = np.searchsorted(flat[by], np.arange(pivots + 1))
        rows, places = by // self.length, by % self.length
        self.files = [(rows[a:b], places[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
        self.n = n

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """The footrule distance of all rows to a query's pivot order; only shared pivots are visited."""
        length = self.length
        distance = np.full(self.n, length * (length + 1), dtype=np.int32)      # nothing shared
        for place, p in enumerate(order.tolist()):
            rows, other = self.files[p]
            distance[rows] -= (2 * length - place - other - np.abs(place - other)).astype(np.int32)
        return distance


def _search(pivots: np.ndarray, width: int, length: int, share: float, keep: int):
    def build(left: pa.Table):
        held = matrix(left.column("vector"), width)
        files = InvertedFiles(orders(held, pivots, length), len(pivots))
        ids, row = flat_ids(left.column("ids"))
        first = np.searchsorted(row, np.arange(len(held) + 1))
        n = min(len(held), max(4 * keep, int(np.ceil(share * len(held)))))

        def answer(right: pa.Table) -> pa.Table:
            asked, out = matrix(right.column("vector"), width), []
            for name, q, order in zip(right.column("vec_id").to_pylist(), asked, orders(asked, pivots, length), strict=True):
                distance = files.footrule(order)
                rows = np.flatnonzero(distance <= np.partition(distance, n - 1)[n - 1])      # ties included
                size = first[rows + 1] - first[rows]
                score = np.repeat(cosine(q, held[rows]), size)
                at = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                other = ids[at] != name
                found, score = ids[at][other], score[other]
                top = best(score, found, keep)
                out.append((name, found[top], score[top]))
            return as_table(out, pa.float64())
        return answer
    return build


def chosen_pivots(vectors: DataFrame, pivots: int) -> tuple[np.ndarray, int]:
    """The ``pivots`` different vectors of least hash among a hashed sample (unit length, padded to the longest vector), and
    the length of the longest vector."""
    h = F.xxhash64(F.lit(9), "vector")
    different, width = vectors.agg(F.approx_count_distinct(h), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    # about 64 candidates a pivot pass the first filter, so the ordering that picks the least sees no more than these
    modulus = max(1, different // (64 * pivots))
    while True:
        chosen = vectors.where(F.pmod(h, F.lit(modulus)) == 0).select("vector").distinct().orderBy(h, "vector").limit(pivots).toArrow()
        if chosen.num_rows == pivots or modulus == 1:
            break
        modulus = max(1, modulus // 8)                                         # too few: a wider sample
    fixed = matrix(chosen.column("vector"), width) if chosen.num_rows else np.zeros((1, width))
    return fixed / np.maximum(np.linalg.norm(fixed, axis=1), 1e-300)[:, None], width


def nearest(rows: DataFrame, is_query: Column, k: int = 5, pivots: int = 128, length: int = 32, share: float = 0.25,
            id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, by cosine.

    The pivots are ``pivots`` different vectors out of a hashed sample (all different vectors if there are fewer)."""
    vectors = usable(rows, id_col, vector_col, nonzero=True)
    fixed, width = chosen_pivots(vectors, pivots)
    items, shards = in_shards(vectors, k + 1, shard_rows)
    search = _search(fixed, width, min(length, len(fixed)), share, k)
    found = searched(items, vectors.where(is_query).distinct(), shards, search, "query_id long, vec_id long, score double")
    return ranked(found, k)
