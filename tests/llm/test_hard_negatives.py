import numpy as np
import pytest
from pyspark.sql import functions as F

from aloft.llm import hard_negatives, multi_index
from aloft.llm.queries import SHIFTED_LABEL

SCHEMA = "vec_id long, embedding array<float>, label int, score string, shard string, kind string, vector string, wanted string"


def table(seed=0, n=700, d=9):
    r = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0.02, 0.3, d)], int(r.integers(0, 4))) for i in range(n)]
    for i in range(0, 300, 3):
        rows[i] = (i, rows[150][1], rows[i][2])                # one vector that many rows share, anchors among them
    rows += [rows[4]] * 20 + [rows[200]] * 5                    # repeated rows
    return rows + [(n, None, 1), (n + 1, rows[2][1], None), (n + 2, [None] + rows[0][1][1:], 1), (n + 3, [float("nan")] * d, 1), (n + 4, [float("inf")] * d, 0),
                   (None, rows[2][1], 2), (n + 5, [], 1), (n + 6, rows[1][1][:4], 3), (n + 7, [0.0] * d, 0), (800, [-x for x in rows[1][1]], 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"skvwx") for r in rows], SCHEMA).repartition(4)


def brute(rows, low=30, high=90, n_pos=5, n_neg=10):
    use, d = set(), max((len(v) for _, v, _ in rows if v), default=0)
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        use.add((i, label, tuple(int(np.floor(256 * x)) for x in v) + (0,) * (d - len(v))))
    out = []
    for a, label, q in use:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, other, v in use if i != a)
        for s, p, _ in [t for t in scored if t[2] == label][:n_pos]:
            inside = [t for t in scored if t[2] != label and low * -s <= 100 * -t[0] <= high * -s][:n_neg]
            out += [(a, p, k + 1, t[1], -s, -t[0]) for k, t in enumerate(inside)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0, F.expr(SHIFTED_LABEL), **more).collect())


@pytest.mark.parametrize("shard_rows,words", [(60, 3), (4096, 16)])
def test_mining_equals_brute_force(spark, shard_rows, words):
    rows = table()
    want = brute(rows)
    assert len(want) > 200
    assert mined(frame(spark, rows), shard_rows=shard_rows, words=words) == want


def test_other_windows(spark):
    rows = table(seed=3, n=300)
    assert mined(frame(spark, rows), low=-200, high=40, positives=2, negatives=3) == brute(rows, -200, 40, 2, 3)


def test_odd_tables(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(0, None, 1), (100, [1.0], None)])) == []
    assert mined(frame(spark, [(0, [], 1), (3, [], 1), (4, [], 2)])) == [(0, 4, 1, 3, 0, 0)]     # 0 is divisible by 7: label 2
    one = [(100, [1.0], 1), (3, [0.5], 1), (4, [0.3], 2), (5, [0.4], 2)]
    assert mined(frame(spark, one)) == brute(one)


def test_cells_come_by_falling_bound():
    r = np.random.default_rng(0)
    a, b = r.normal(size=7), r.integers(0, 3, 5).astype(float)
    got = list(multi_index.best_first(a, b))
    assert len(got) == 35 and len({g[1:] for g in got}) == 35
    assert all(x[0] >= y[0] for x, y in zip(got, got[1:])) and all(abs(g[0] - a[g[1]] - b[g[2]]) < 1e-12 for g in got)


def test_search_certifies_and_skips():
    r = np.random.default_rng(1)
    centre = r.integers(-300, 300, (30, 16))
    rows = (centre[r.integers(0, 30, 6000)] + r.integers(-6, 7, (6000, 16))).astype(float)
    words = multi_index.codebook(rows[:2000, :8], 16), multi_index.codebook(rows[:2000, 8:], 16)
    index = multi_index.MultiIndex(rows, words)
    for q in rows[:40]:
        index.visited = 0
        exact = np.sort(rows @ q)[::-1]
        found, scores = index.search(q, lambda _, s: np.partition(s, len(s) - 10)[len(s) - 10] if len(s) >= 10 else -np.inf)
        assert (np.sort(scores)[::-1][:10] == exact[:10]).all() and (rows[found] @ q == scores).all()
    assert index.visited < 6000
