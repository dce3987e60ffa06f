"""A stated query set against all rows: rows in shards, queries streamed through them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.sources.io import stage


def usable(rows: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(vec_id, vector) with the vectors that take part: not null, all components finite, not all zero if so wanted."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    v = v.where(F.coalesce(finite, F.lit(False)))
    return v.where(F.exists("vector", lambda x: x != 0)) if nonzero else v


def least_ids(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): each different vector with the ``keep`` least different ids that have it, ascending.

    Equal vectors score alike and ties go to the smaller id, so no other id can be among the ``keep`` best.  The limit
    per vector works before the shuffle already, so a vector that many rows share does no harm."""
    w = Window.partitionBy("vector").orderBy("vec_id")
    return (rows.dropDuplicates(["vec_id", "vector"]).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep)
            .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def in_shards(rows: DataFrame, keep: int, shard_rows: int) -> tuple[DataFrame, int]:
    """``least_ids`` of ``rows`` with their ``shard`` in a written table, and the number of shards."""
    shards = max(1, -(-rows.count() // shard_rows))
    return stage(least_ids(rows, keep).withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "vector"), F.lit(shards)).cast("int"))), shards


def searched(items: DataFrame, queries: DataFrame, shards: int, build: Callable[[pa.Table], Callable[[pa.Table], pa.Table]], schema: str) -> DataFrame:
    """Every query (vec_id, vector) against every shard of ``items`` (shard, vector, ids).

    A row moves once, to its shard; only the queries are copied, one copy a shard, and stream through its task
    batch by batch.  ``build`` makes a shard's index, once, and gives the function that answers a batch."""
    columns = ["shard", "is_query", "vector", "ids", "vec_id"]
    held = items.select("shard", F.lit(False).alias("is_query"), "vector", "ids", F.lit(None).cast("long").alias("vec_id"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_query"), "vector",
                           F.lit(None).cast("array<long>").alias("ids"), "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, answer = None, [], None
        for b in batches:
            shard = b.column("shard").to_numpy()
            asks = b.column("is_query").to_numpy(zero_copy_only=False)
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(shard) | (asks[1:] != asks[:-1])) + 1), b.num_rows)
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if shard[lo] != now:
                    now, parts, answer = shard[lo], [], None
                part = b.slice(lo, hi - lo)
                if not asks[lo]:
                    parts.append(part)
                    continue
                if answer is None and parts:
                    answer, parts = build(pa.Table.from_batches(parts)), []
                if answer is not None:
                    yield from answer(pa.Table.from_batches([part])).to_batches()

    both = held.unionByName(asked).select(*columns)
    return both.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "is_query").mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows (shorter ones padded with zeros)."""
    rows = column.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = np.array(rows.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    width = max(width or 0, int(size.max(initial=0)))
    out = np.zeros((len(size), width))
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def flat_ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a column of lists, and the row of each."""
    rows = column.combine_chunks()
    size = rows.value_lengths().to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy(), np.repeat(np.arange(len(rows)), size)


def best(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` best: highest score, ties to the smaller id."""
    if len(scores) > 4 * keep:
        bar = np.partition(scores, len(scores) - keep)[len(scores) - keep]
        use = np.flatnonzero(scores >= bar)
        return use[np.lexsort((ids[use], -scores[use]))[:keep]]
    return np.lexsort((ids, -scores))[:keep]


def ranked(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of all blocks per query, with their rank from 1."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep).select("query_id", "rank", "vec_id", "score")


def as_table(rows: list[tuple[int, np.ndarray, np.ndarray]], score_type: pa.DataType) -> pa.Table:
    """Rows (query, ids, scores) as a table (query_id, vec_id, score)."""
    n = [len(r[1]) for r in rows]
    return pa.Table.from_arrays([
        pa.array(np.repeat(np.array([r[0] for r in rows], dtype=np.int64), n)),
        pa.array(np.concatenate([r[1] for r in rows]) if rows else [], pa.int64()),
        pa.array(np.concatenate([r[2] for r in rows]) if rows else [], score_type)], names=["query_id", "vec_id", "score"])


