import math
import zlib
from collections import Counter

import pytest
from corpus import corpus, frame
from pyspark.sql import functions as F

from aloft.llm import sharding as S


@pytest.mark.parametrize("pop,good,draws", [(50, 20, 10), (10, 3, 9), (7, 7, 3), (6, 0, 4), (5, 2, 0), (1000, 41, 125)])
def test_one_draw_follows_the_hypergeometric_law(spark, pop, good, draws):
    n = 4000
    got = Counter(r[0] for r in spark.range(n).select(F.expr(S._draw(f"{pop}L", f"{good}L", f"{draws}L", f"((id + 0.5D) / {n})"))).collect())
    for x in range(max(0, draws - pop + good), min(good, draws) + 1):
        p = math.comb(good, x) * math.comb(pop - good, draws - x) / math.comb(pop, draws)
        assert abs(got[x] - n * p) <= 1.01, x


@pytest.mark.parametrize("per_part", [4, 40, 5000])
def test_sizes_slots_and_content(spark, per_part):
    rows = corpus(n=300)
    out = S.shard_documents(frame(spark, rows), rows_per_partition=per_part).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}


def test_matrix_has_exact_margins_and_mean(spark):
    sizes = spark.createDataFrame([(p, 5 + p % 3) for p in range(70)], "part long, n long")
    total = sum(5 + p % 3 for p in range(70))
    sums = Counter()
    for seed in range(3):
        m = {r["part"]: r["upto"] for r in S.communication_matrix(sizes, total, 70, 6, seed).collect()}
        assert {p: u[-1] for p, u in m.items()} == {p: 5 + p % 3 for p in range(70)}
        counts = {p: [b - a for a, b in zip([0, *u], u)] for p, u in m.items()}
        caps = [sum(c[s] for c in counts.values()) for s in range(6)]
        assert sum(caps) == total and max(caps) - min(caps) <= 1
        for c in counts.values():
            sums.update(c)
    assert set(sums) >= {0, 1, 2, 3}          # entries vary as those of a random permutation do


def test_same_result_however_rows_lie(spark):
    docs = frame(spark, corpus())
    a = S.shard_documents(docs, rows_per_partition=10)
    b = S.shard_documents(docs.repartition(7), rows_per_partition=10)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert S.shard_documents(frame(spark, [])).count() == 0


def test_main_path_is_native(spark):
    plan = S.shard_documents(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
