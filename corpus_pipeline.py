"""The corpus pipeline: labelled quality, near copies, secrets, mixture, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.llm import jaccard_join, quality, queries, secret_scan
from aloft.llm.common import table
from aloft.sources.io import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (score below 0.3).  The classifier learns from all labelled documents given."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs.select(*COLUMNS), model).where(F.col("score") >= 0.3).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the least id."""
    docs = docs.select(*COLUMNS)
    return jaccard_join.keep_one(docs, jaccard_join.jaccard_classes(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind; documents without one stay as they are."""
    return secret_scan.redact(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings the sources to their target weights; a document comes once for each epoch that takes it."""
    return queries.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences; one row per piece."""
    return queries.packed(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("packing", pack),
]

# The classifier is learnt by gradient descent, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
