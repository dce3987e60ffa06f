import numpy as np
import pytest
from pyspark.sql import functions as F

from aloft.llm import maxscore, permutation_index

SCHEMA = "vec_id long, embedding array<float>, score string, block string, vector string"


def vectors(seed=0, n=600, d=16):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, d)]) for i in range(n)]
    for i in range(0, 200, 3):
        rows[i] = (i, rows[150][1])                       # one vector that many rows share, queries among them
    odd = [(n, None), (n + 1, []), (n + 50, [0.0] * d), (n + 3, [float("nan")] + [0.1] * (d - 1)), (n + 4, [None] + [0.1] * (d - 1)),
           (n + 5, [float("inf")] + [0.1] * (d - 1)), (None, rows[7][1]), (7, rows[7][1]), *[(0, rows[150][1])] * 9, *[(3, rows[150][1])] * 9]
    return [(i, v, "s", "b", "v") for i, v in rows + odd]


def usable(rows, zero_ok):
    out = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero_ok or any(v)):
            out[i] = np.array(v, dtype=np.float32).astype(float)
    return out


def brute(table, score, k=5):
    out = {}
    for q in table:
        if q % 50 == 0:
            best = sorted((-score(table[q], v), i) for i, v in table.items() if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("shard_rows", [50, 8192])
def test_maxscore_is_exact(spark, shard_rows):
    rows = vectors()
    table = {i: np.floor(256 * v).astype(int) for i, v in usable(rows, True).items()}
    got = collected(maxscore.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, shard_rows=shard_rows))
    assert got == brute(table, lambda a, b: int(a @ b))


def test_maxscore_skips_rows():
    rng = np.random.default_rng(1)
    weights = np.where(rng.random((500, 40)) < 0.1, rng.integers(-50, 50, (500, 40)), 0)
    query = np.where(rng.random(40) < 0.3, rng.integers(-50, 50, 40), 0)
    exact = weights @ query
    bar = np.sort(exact)[-5]
    rows, score = maxscore.Shard(weights).search(query, bar)
    assert sorted(zip(rows, score)) == sorted((i, exact[i]) for i in np.flatnonzero(exact >= bar))


@pytest.mark.parametrize("shard_rows", [64, 8192])
def test_nearest_with_everything_reranked(spark, shard_rows):
    rows = vectors(1)
    table = usable(rows, False)
    got = collected(permutation_index.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, share=1.0, shard_rows=shard_rows))
    want = brute(table, lambda a, b: round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 12))
    assert {q: [x[:2] for x in v] for q, v in got.items()} == {q: [x[:2] for x in v] for q, v in want.items()}
    assert all(abs(a[2] - b[2]) < 1e-11 for q in want for a, b in zip(got[q], want[q]))


def test_nearest_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = usable([(r["vec_id"], r["embedding"]) for r in df.collect()], False)
    got = collected(permutation_index.nearest(df, F.col("vec_id") % 50 == 0))
    ids = np.array(list(table))
    x = np.stack(list(table.values()))
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = total = 0
    for q, found in got.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -2
        hit += len({f[1] for f in found} & set(ids[np.argsort(-s)[:5]].tolist()))
        total += 5
    assert len(got) == (ids % 50 == 0).sum() and hit / total >= 0.9


def test_footrule():
    order = np.array([[2, 0, 1], [0, 1, 3], [4, 3, 0]])
    index = permutation_index.InvertedFiles(order, 5)
    query = [0, 2, 4]

    def place(o, p):
        return list(o).index(p) if p in o else 3

    want = [sum(abs(place(o, p) - place(query, p)) for p in range(5)) for o in order]
    assert index.footrule(np.array(query)).tolist() == want


def test_few_and_none(spark):
    three = spark.createDataFrame(vectors()[1:3] + [(50, [1.0] * 16, "", "", "")], SCHEMA)
    for op in (maxscore.top_k, permutation_index.nearest):
        assert len(op(three, F.col("vec_id") % 50 == 0).collect()) == 2
        assert op(three.where("false"), F.col("vec_id") % 50 == 0).count() == 0
        assert op(three.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_with_many_copies_of_each_vector(spark):
    rng = np.random.default_rng(2)
    base = [[float(np.float32(x)) for x in rng.normal(0, 0.3, 16)] for _ in range(20)]
    df = spark.createDataFrame([(i, base[i % 20], "", "", "") for i in range(10_000)], SCHEMA)
    got = collected(permutation_index.nearest(df, F.col("vec_id") % 1009 == 0, pivots=2))
    want = {q: [i for i in range(q % 20, 140, 20) if i != q][:5] for q in range(0, 10_000, 1009)}
    assert {q: [x[1] for x in v] for q, v in got.items()} == want
    for n in (2, 20, 128):
        fixed, _ = permutation_index.chosen_pivots(df.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")), n)
        assert len(np.unique(fixed, axis=0)) == len(fixed) == min(n, 20)


def test_nearest_pads_vectors_of_different_lengths(spark):
    rng = np.random.default_rng(3)
    size = [16] * 290 + [5] * 7 + [24, 24, 40]
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, d)], "", "", "") for i, d in enumerate(size)]
    table = {i: np.pad(v, (0, 40 - len(v))) for i, v in usable(rows, False).items()}
    got = collected(permutation_index.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, pivots=4, share=1.0, shard_rows=64))
    want = brute(table, lambda a, b: round(float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), 12))
    assert {q: [x[:2] for x in v] for q, v in got.items()} == {q: [x[:2] for x in v] for q, v in want.items()}
