"""Mixing sources to target weights (3): hierarchical budgets, token prefixes of seeded epochs.

Documents hang on a tree domain > language > source.  A total budget of
tokens goes down the tree by weights.  A node can take at most what its
leaves hold in ``max_epochs`` epochs; what it cannot take goes to its
siblings in proportion to their weights, and to the siblings of its ancestors
only when all of its own are full.  With capacities known for whole subtrees
this is one water filling per node, which windows over the children
(ordered by capacity over weight) solve without iterating.

A leaf with budget b over T tokens takes every document floor(b / T) times,
and of one more epoch the documents that begin within the first b mod T
tokens of that epoch's seeded order.  That order is cut by ranges of its key:
running totals are taken per range and then inside the one range in which the
budget ends, so no task holds a leaf.  A document is then chosen by comparing its
own key with the leaf's last key, without moving texts.

Only DataFrame and SQL functions are used.

Odd input: a null domain, language or source is the branch named ``''``; a
null or empty text has no tokens and rides along with its place in the order; equal rows share
a key and are taken together; a weight of 0 or less gives nothing; an empty
table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.session import ensure_checkpoint_dir
from aloft.sources.io import stage

LEVELS = ("domain", "lang", "source")
RANGE_DIGITS = 3            # ranges of the order: 16**3 per leaf
SALTS = 32                  # parts of a leaf's documents, where the plan is too large to be broadcast


def word_count(text: str | Column = "text") -> Column:
    """Tokens of a text: its words (runs of other than space and 0x09-0x0D)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: int, weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight of a child at ``level`` of the tree (0: domain): of its path, or else of its own name, or else 1."""
    out = F.lit(1)
    by_name = {p[-1]: w for p, w in weights.items() if len(p) == 1 + level and all(x == "*" for x in p[:-1])}
    full = {p: w for p, w in weights.items() if len(p) == 1 + level and p[:-1] and "*" not in p}
    for name, w in by_name.items():
        out = F.when(F.col(LEVELS[level]) == name, w).otherwise(out)
    for path, w in full.items():
        same = F.lit(True)
        for column, value in zip(LEVELS, path, strict=False):
            same = same & (F.col(column) == value)
        out = F.when(same, w).otherwise(out)
    return out.cast("long")


def fill(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Water filling among siblings: ``children`` (with weight w, capacity cap and their parent's ``budget``)
    get ``budget`` of their own.  Whole tokens; the parts lost to rounding go to the first that have room."""
    by = [F.col(p) for p in parents] or [F.lit(0)]
    order = Window.partitionBy(*by).orderBy(F.col("cap") / F.col("w"), name)
    before, all_ = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by)
    c = children.where("w > 0")
    c = c.withColumn("_left", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    c = c.withColumn("_weight", F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    c = c.withColumn("_full", F.col("cap") * F.col("_weight") <= F.col("_left") * F.col("w"))
    rest = F.col("budget") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(all_)
    share = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("w"))).over(all_)
    c = c.withColumn("_rest", rest).withColumn("_share", share)
    c = c.withColumn("_got", F.when(F.col("_full"), F.col("cap"))
                     .otherwise(F.floor(F.col("_rest").cast("double") * F.col("w") / F.greatest(F.col("_share"), F.lit(1)))))
    spare = F.col("_rest") - F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_got"))).over(all_)
    open_rank = F.sum(F.when(F.col("_full"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("_spare", spare).withColumn("_rank", open_rank)
    got = F.col("_got") + F.when(~F.col("_full") & (F.col("_rank") <= F.col("_spare")), 1).otherwise(0)
    return c.withColumn("budget", got.cast("long")).drop("_left", "_weight", "_full", "_rest", "_share", "_got", "_spare", "_rank")


def leaf_budgets(leaves: DataFrame, weights: Mapping[tuple[str, ...], int], share: float, max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with their ``budget``; the total is ``share`` of all tokens."""
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.floor(F.sum("tokens") * F.lit(share)).alias("budget"))
    level1 = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("w", _weight(0, weights))
    level1 = fill(level1.crossJoin(F.broadcast(total)), [], "domain")                       # one row
    level2 = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("w", _weight(1, weights))
    level2 = fill(level2.join(level1.select("domain", "budget"), "domain"), ["domain"], "lang")
    level3 = leaves.withColumn("w", _weight(2, weights))
    return fill(level3.join(level2.select("domain", "lang", "budget"), ["domain", "lang"]), ["domain", "lang"], "source").drop("w", "cap")


def order_key(seed: int, epoch: Column, doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text, F.lit("")))))


def mix_sources(docs: DataFrame, domain: Column, weights: Mapping[tuple[str, ...], int], share: float = 1.0,
                max_epochs: int = 4, seed: int = 20260101, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` once for each epoch that takes them, with ``_mix``: a struct of domain, lang, source, epoch (from 0), tokens."""
    ensure_checkpoint_dir(docs.sparkSession)
    blank = lambda c: F.coalesce(c, F.lit(""))
    branch = [blank(domain).alias("domain"), blank(F.col(lang_col)).alias("lang"), blank(F.col(source_col)).alias("source")]
    slim = docs.select(*branch, F.col(id_col).alias("_id"), word_count(text_col).alias("tokens"), F.md5(blank(F.col(text_col))).alias("_text"))
    slim = slim.checkpoint()          # read several times below; the texts are read once
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    budgets = stage(leaf_budgets(leaves, weights, share, max_epochs).withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")) \
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")))

    def key(text_digest: Column) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit("")), text_digest))

    last = (slim.join(budgets.select(*LEVELS, "full", "rest"), list(LEVELS)).where("rest > 0")
            .select(*LEVELS, "rest", "tokens", key(F.col("_text")).alias("key"))
            .groupBy(*LEVELS, "rest", "key").agg(F.sum("tokens").alias("tokens"))            # equal rows together
            .withColumn("range", F.substring("key", 1, RANGE_DIGITS)))
    ranges = last.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("held"))
    upto = Window.partitionBy(*LEVELS).orderBy("range")
    ranges = ranges.withColumn("before", F.sum("held").over(upto) - F.col("held")).drop("held")
    inside = Window.partitionBy(*LEVELS, "range").orderBy("key")
    placed = last.join(ranges, [*LEVELS, "range"]).where("before < rest") \
        .withColumn("start", F.col("before") + F.sum("tokens").over(inside) - F.col("tokens"))
    cut = placed.where("start < rest").groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    rename = {c: f"_mix_{c}" for c in (*LEVELS, "full", "cut")}
    # a written table: the planner knows its size and broadcasts it where that is small; where it is not, texts meet it by
    # leaf and salt, so a hot leaf is many keys
    plan = stage(budgets.select(*LEVELS, "full").join(cut, list(LEVELS), "left").withColumnsRenamed(rename))
    plan = plan.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(SALTS)).cast("int")
    keyed = docs.select("*", F.struct(*branch, salt.alias("salt")).alias("_mix_leaf"))
    on = [F.col(f"_mix_leaf.{c}") == F.col(f"_mix_{c}") for c in (*LEVELS, "salt")]
    own = order_key(seed, F.col("_mix_full"), F.col(id_col), F.col(text_col))
    copies = F.col("_mix_full") + F.when(own <= F.col("_mix_cut"), 1).otherwise(0)
    out = keyed.join(plan, on).withColumn("_mix_n", copies).where("_mix_n > 0") \
        .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
    return out.select(*docs.columns, F.struct("_mix_leaf.domain", "_mix_leaf.lang", "_mix_leaf.source",
                                              F.col("_mix_epoch").alias("epoch")).alias("_mix"))
