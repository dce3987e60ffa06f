"""Session helpers: a local builder for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "aloft",
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("ALOFT_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a classic context (e.g. Spark Connect)
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The setting is read from the session (``spark.checkpoint.dir`` or the
    context's checkpoint dir).  Only a local session without one gets a
    fresh folder under the system temp dir; on a cluster an unset value is
    an error, because a machine-local folder is not visible to executors.
    """
    sc = _context(spark)
    d = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="aloft-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() if sc is not None else None) or d


# folders that this driver has named, for clear_scratch
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; ``clear_scratch`` removes it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/aloft-{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Remove the folders that this driver has named by ``scratch_path``; returns how many there were.

    Queries return DataFrames that read them, so only the caller knows when results are done: the bench calls this after
    each query, a pipeline's owner after its last read."""
    context, done = spark.sparkContext, len(_SCRATCH)
    while _SCRATCH:
        name = _SCRATCH.pop()
        if "/aloft-bucketed-" in name:
            spark.sql(f"DROP TABLE IF EXISTS {name.rsplit('/', 1)[-1].replace('-', '_')}")
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return done
