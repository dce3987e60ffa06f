from fractions import Fraction

import numpy as np
import pytest

from aloft.llm import spectral, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, x string, component string, whitened string"


def table(seed=0, n=300, d=40):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(d, d)) * np.linspace(1, 0.1, d)
    rows = [(i, [float(np.float32(v)) for v in mix @ r.normal(size=d) + 50]) for i in range(n)]
    rows += [rows[3]] * 70                                    # one row many times
    return rows + [(n, None), (n + 1, [None] + rows[0][1][1:]), (n + 2, [float("nan")] + rows[0][1][1:]), (n + 3, [float("inf")] + rows[0][1][1:]),
                   (None, rows[5][1]), (n + 4, rows[6][1][:7]), (n + 5, [])]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "x", "c", "w") for r in rows], SCHEMA).repartition(5)


def brute(rows, k=32):
    """Exact sums and covariance in fractions, numpy's eigenvalues."""
    kept = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d, n = max(len(v) for _, v in kept), len(kept)
    x = [v + [1_000_000] * (d - len(v)) for _, v in kept]
    s = [sum(v[j] for v in x) for j in range(d)]
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    cov = np.array([[float(Fraction(sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in x), n**3)) for j in range(d)] for i in range(d)])
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, s)] for v in x])
    e, v = np.linalg.eigh(cov)
    return [i for i, _ in kept], n, dev, cov, centred, e[::-1][:k], v[:, ::-1][:, :k]


def test_whitening_equals_the_plain_form(spark):
    rows = table(n=80, d=36)
    ids, n, dev, cov, centred, e, v = brute(rows)
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == n * 32 and {r["n"] for r in got} == {n} and {r["component"] for r in got} == set(range(1, 33))
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == sorted(zip(map(str, ids), dev))
    error = {r["identity_error"] for r in got}
    assert len(error) == 1 and 0 <= error.pop() < 1e-9
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    plain = centred @ v / np.sqrt(e)
    for c in range(32):
        mine = np.array([by[(i, c + 1)] for i in ids])
        assert min(np.abs(mine - plain[:, c]).max(), np.abs(mine + plain[:, c]).max()) < 1e-8
        share = {r["explained"] for r in got if r["component"] == c + 1}
        assert len(share) == 1 and abs(share.pop() / (e[c] / np.trace(cov)) - 1) < 1e-10


def test_the_result_does_not_depend_on_the_layout(spark):
    rows = frame(spark, table(n=60, d=8))
    a = whitening.fit(rows.repartition(1))
    b = whitening.fit(rows.repartition(7, "vec_id"))
    assert a.n == b.n and a.sums == b.sums and (a.components == b.components).all() and (a.values == b.values).all()


def test_odd_tables(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None), (2, [float("nan")])])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [0.5, 0.25])] * 9)).collect() == []        # no variance
    assert whitening.whitened(frame(spark, [(1, []), (2, [])])).collect() == []
    got = whitening.whitened(frame(spark, [(1, [1.0, 7.0]), (2, [3.0, 7.0]), (3, [5.0])] )).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 6
    one = whitening.whitened(frame(spark, [(1, [1.0, 1.0]), (2, [3.0, 3.0]), (3, [5.0, 5.0])])).collect()
    assert {r["component"] for r in one} == {1} and {round(r["explained"], 12) for r in one} == {1.0}
    huge = whitening.whitened(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])])).collect()
    assert {r["deviation"] for r in huge} == {None, 36864} and max(r["identity_error"] for r in huge) < 1e-4


def test_products_are_exact():
    r = np.random.default_rng(1)
    for high in (100, 1 << 26, 1 << 41):
        z = r.integers(-high, high, (700, 5))
        want = z.astype(object).T @ z.astype(object)
        assert (whitening.gram(z) == want).all()


@pytest.mark.parametrize("name", ["plain", "graded", "repeated", "singular", "cluster", "one"])
def test_spectral_divide_and_conquer(name):
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.normal(size=(24, 24)))[0]
    values = {"plain": r.random(24), "graded": 10.0 ** -np.arange(24), "repeated": np.repeat([3.0, 1.0, 0.0], 8),
              "singular": np.append(r.random(5), np.zeros(19)), "cluster": 1 + 1e-10 * np.arange(24), "one": np.ones(24)}[name]
    a = q @ np.diag(values) @ q.T
    e, v = spectral.eigenvectors(a)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 and np.abs(v.T @ v - np.eye(24)).max() < 1e-13
    assert np.abs(a @ v - v * e).max() < 1e-13


def test_polar_factor():
    r = np.random.default_rng(3)
    a = r.normal(size=(30, 30))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    u = spectral.polar(a)
    assert np.abs(u - v @ np.diag(np.sign(e)) @ v.T).max() < 1e-11
