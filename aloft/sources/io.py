"""Scans, sinks and dimension tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aloft.session import clear_scratch, scratch_path

def read_table(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
               min_partitions: int | str | None = "auto") -> DataFrame:
    """Parquet scan of a path or glob (S1).  A given schema skips footer inference.

    ``min_partitions="auto"`` spreads a scan that yields fewer splits than
    the cluster has cores (a few large unsplittable files/row groups) with
    one round-robin repartition, so pre-shuffle work is not single-task.
    A large input already has far more splits than cores and is left as is.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return spread(reader.parquet(*paths), min_partitions)


def spread(df: DataFrame, min_partitions: int | str | None = "auto") -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than wanted
    (``"auto"``: the cluster's default parallelism).  Meant for scans, of which the
    splits are known from planning; the rows are the same either way."""
    if min_partitions is None:
        return df
    try:
        want = df.sparkSession.sparkContext.defaultParallelism if min_partitions == "auto" else int(min_partitions)
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access (e.g. Spark Connect): leave as is
        return df
    return df.repartition(want) if have < want else df


def read_csv_named(spark: SparkSession, path: str, schema: StructType | Sequence[str],
                   null_value: str = "\\N") -> DataFrame:
    """Headerless CSV with caller-supplied column names.

    With a list of names every column is read as string (as the source
    does); with a ``StructType`` the types are applied on read.
    """
    if isinstance(schema, StructType):
        return spark.read.schema(schema).csv(path, header=False, nullValue=null_value)
    names = list(schema)
    ddl = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(ddl).csv(path, header=False, nullValue=null_value)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None, fmt: str = "parquet",
                **options) -> str:
    """Parquet (or CSV) sink; fails if the path exists unless ``mode`` says otherwise (S3)."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Restartable Parquet sink (S3): the partitions that ``df`` has rows for are replaced, all others stay.

    Running a day again gives the same table, however often; a run that fails midway changes nothing, as partitions are
    swapped when the job commits.  Readers that join the partition columns with a filtered table skip the other partitions
    (dynamic pruning)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return path


def dim_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A literal dimension table (S4).  The planner knows its size and broadcasts it where that is small."""
    return spark.createDataFrame(list(rows), schema)


def stage(df: DataFrame, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Materialise a stage as Parquet and continue from the written copy.

    Cuts the lineage: a lost executor re-reads the files instead of
    recomputing the plan.  Without a path the stage goes to a unique folder
    under the shared checkpoint dir, which ``clear_stages`` removes when the
    results that read it are done.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, "stage")
    write_table(df, path, mode=mode)
    return spark.read.parquet(path)


def stage_bucketed(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """A stage bucketed and sorted on ``keys`` (S5): joins, groupings and windows on them read it without an exchange.

    Worth it where wide rows are joined on the same keys later, or more than once.  ``buckets`` (default: the session's
    shuffle partitions, so that other sides are dealt alike) get one file each.  A bucket is read by one task, so the keys
    must be fine enough that no value holds a large share of the rows (a hot place by its hours, not the place alone).
    The table's entry in the session's catalog goes with ``clear_stages``.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "bucketed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def clear_stages(spark: SparkSession) -> int:
    """Remove the unique stage folders that this driver has written; returns how many there were."""
    return clear_scratch(spark)


def persist(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Reuse cache for a branch read more than once."""
    return df.persist(level)


def expect_schema(df: DataFrame, required: dict[str, str]) -> DataFrame:
    """Check that ``df`` has the named columns with the given simple type names."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = {c: t for c, t in required.items() if c not in have}
    wrong = {c: (have[c], t) for c, t in required.items() if c in have and have[c] != t}
    if missing or wrong:
        raise ValueError(f"schema mismatch: missing={missing} wrong={wrong}")
    return df
