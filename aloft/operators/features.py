"""Feature vectors, deterministic splits and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: str | Sequence[str], seed: int = 0, modulus: int = 100) -> Column:
    """Deterministic bucket in [0, modulus) from the md5 of ``seed:key``.

    The same md5 prefix exists in SQL engines, so a split can be checked by
    an oracle; it depends only on the key, never on file layout.
    """
    keys = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(modulus))


def hash_split(df: DataFrame, key: str | Sequence[str], train_pct: int = 80, seed: int = 0,
               out: str = "is_train") -> DataFrame:
    """Tag rows train/test by key hash (F5); disjoint and complete by construction."""
    return df.withColumn(out, hash_bucket(key, seed) < F.lit(train_pct))


def split(df: DataFrame, key: str | Sequence[str], train_pct: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash."""
    b = hash_bucket(key, seed)
    return df.where(b < train_pct), df.where(b >= train_pct)


def subsample(df: DataFrame, frac: float, key: str | Sequence[str], seed: int = 0) -> DataFrame:
    """Keep a ``frac`` share of rows without replacement, by key hash."""
    return df.where(hash_bucket(key, seed, 1_000_000) < F.lit(int(round(frac * 1_000_000))))


def balance_ratio(df: DataFrame, label: str) -> float:
    """Share of negative rows (one aggregate; a single number reaches the driver)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 0).alias("neg")).first()
    return (r["neg"] / r["n"]) if r["n"] else 0.0


def class_weights(df: DataFrame, label: str, out: str = "classWeights", ratio: float | None = None) -> DataFrame:
    """Positives weigh ratio = negatives/total, negatives 1 - ratio."""
    r = balance_ratio(df, label) if ratio is None else ratio
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(r)).otherwise(F.lit(1.0 - r)))


def feature_stages(num_cols: Sequence[str], cat_cols: Sequence[str] = (), out: str = "features",
                   handle_invalid: str = "keep") -> list:
    """StringIndexer (frequency order, ties alphabetical) -> OneHotEncoder
    (last level kept) -> VectorAssembler (F1-F3)."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_indexed", handleInvalid=handle_invalid,
                         stringOrderType="frequencyDesc") for c in cat_cols]
    # the indexer's "keep" already maps unseen categories to one extra valid index
    enc = [OneHotEncoder(dropLast=False, inputCol=f"{c}_indexed", outputCol=f"{c}_indexed_classVec",
                         handleInvalid="error") for c in cat_cols]
    asm = VectorAssembler(inputCols=[f"{c}_indexed_classVec" for c in cat_cols] + list(num_cols),
                          outputCol=out, handleInvalid="keep" if handle_invalid == "keep" else "error")
    return idx + enc + [asm]


def build_features(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str] = (),
                   fit_on: DataFrame | None = None, out: str = "features",
                   handle_invalid: str = "keep") -> tuple[PipelineModel, DataFrame]:
    """Fit the stage chain (on ``fit_on``, e.g. the train split) and apply it to ``df``."""
    model = Pipeline(stages=feature_stages(num_cols, cat_cols, out, handle_invalid)).fit(
        fit_on if fit_on is not None else df)
    return model, model.transform(df)


def feature_names(df: DataFrame, col: str = "features") -> list[tuple[int, str]]:
    """(index, name) of every slot of an assembled vector, from its ml_attr metadata."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    out = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    return sorted(out)


def feature_importance(spark, model, df: DataFrame, col: str = "features") -> DataFrame:
    """Importance table (name, idx, score = importance x 100), sorted.

    Built from the model's importance vector and the column metadata: both
    are bounded by the number of features, never by rows.
    """
    imp = model.featureImportances.toArray()
    rows = [(name, int(i), float(imp[i] * 100.0)) for i, name in feature_names(df, col)]
    return spark.createDataFrame(rows, "name string, idx int, score double").orderBy(F.desc("score"), "idx")


def select_features(importance: DataFrame, cutoff: float) -> list[tuple[int, str]]:
    """(index, name) of the slots scoring at least ``cutoff`` (F13); a bounded list.  Category slots count like any other."""
    return [(r["idx"], r["name"]) for r in importance.where(F.col("score") >= cutoff).select("idx", "name").orderBy("idx").collect()]


def keep_slots(df: DataFrame, slots: Sequence[int], col: str = "features") -> DataFrame:
    """``df`` with the vector ``col`` cut down to the given slots."""
    cut = VectorSlicer(inputCol=col, outputCol="__kept", indices=sorted(slots)).transform(df)
    return cut.drop(col).withColumnRenamed("__kept", col)
