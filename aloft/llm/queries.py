"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.llm import hard_negatives, jaccard_join, lm_score, maxscore, mixing, packing, permutation_index, quality, secret_scan, sharding, substring_dedup, token_store, whitening
from aloft.llm.common import table
from aloft.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# The table has no domain column; its sources are dealt to four domains by their number.
DOMAIN_SQL = "concat('d', cast(coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) % 4 as string))"
# what the mining contract makes of a label
SHIFTED_LABEL = "case when vec_id % 7 = 0 then (label + 1) % 10 else label end"
MIX_WEIGHTS = {("d0",): 5, ("d1",): 2, ("d2",): 2, ("d3",): 2,
               ("*", "en"): 6, ("*", "de"): 2, ("*", "fr"): 2, ("*", "es"): 1,
               ("*", "*", "src0"): 8}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 1.0, 4, 20260101


def domain() -> Column:
    return F.expr(DOMAIN_SQL)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix_sources(docs, domain(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", "_mix.domain", "_mix.lang", "_mix.source", "_mix.epoch",
                              mixing.word_count().alias("tokens"))


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, VOCABULARY)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.hex("root")).alias("class_root"), "class_id", "n_links", "n_text_links")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")
    token_store.write_store(docs, VOCABULARY, path)
    return token_store.fetch(spark, path, docs)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, F.expr(SHIFTED_LABEL))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "op4_permutation_index": op4_permutation_index,
    "op5_packing": op5_packing,
    "op6_maxscore": op6_maxscore,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_secret_scan": op10_secret_scan,
    "op11_whitening": op11_whitening,
    "op12_token_store": op12_token_store,
    "op13_hard_negatives": op13_hard_negatives,
}
