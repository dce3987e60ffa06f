import hashlib
import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
import zlib
from corpus import corpus, frame

from aloft.llm import quality as Q


def test_gradients_lower_the_loss_and_learn_which_passage_matters():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 9, 400)
    h = rng.normal(0, 1, (counts.sum(), 6))
    y = rng.integers(0, 2, 400).astype(float)
    first = np.cumsum(counts) - counts
    h[first[y == 0], 2] += 5                     # one bad passage makes a bad document
    m = Q.fit(h, counts, y)
    assert ((m.score(h, counts) >= 0.5) == y).mean() > 0.9


def test_passages():
    words = [f"w{i}" for i in range(130)]
    h, counts = Q.encode(pa.array(["", None, " ".join(words), "one two", " \n"]))
    assert counts.tolist() == [1, 1, 3, 1, 1] and h.shape == (7, Q.WIDTH) and np.isfinite(h).all()
    again, _ = Q.encode(pa.array([" ".join(words[:64])]))
    k = [i for i in range(Q.WIDTH) if i != Q.WIDTH - 3]          # but the share of different words in the whole text
    assert np.allclose(again[0, k], h[2, k])


def test_held_out_accuracy_and_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = Q.train(docs, labels)
    out = Q.with_score(docs.select("doc_id", "text"), model).select("doc_id", "score", Q.held_out().alias("held_out")).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    x = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    good = x.score >= 0.3
    assert (good == (x.quality == 1)).mean() > 0.97
    assert good[x.quality == 1].mean() > 0.99


def test_odd_input(spark):
    rows = corpus()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(1, 1, None), (2, 0, 1), (3, None, 0), (4, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    out = Q.with_score(docs, Q.train(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    for none in (labels.where("false"), labels.where("quality = 1")):
        model = Q.train(docs, none)
        assert all(0 <= r["score"] <= 1 for r in Q.with_score(docs, model).collect())
    empty = frame(spark, [])
    assert Q.with_score(empty, Q.train(empty, labels)).count() == 0


def test_repeated_rows_of_a_labelled_id_teach_once(spark):
    rows = corpus(n=60)
    ids = [i for i, t, *_ in rows if i is not None and 0 <= i < 60 and t and t.split() and zlib.crc32(str(i).encode()) % 5]
    once = [r for r in {r[0]: r for r in rows if r[0] in ids}.values()]
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    texts = [f"other text {k} of this id" for k in range(400)]
    least = min(texts, key=lambda t: hashlib.md5(t.encode()).digest())
    rest = [r for r in once if r[0] != ids[0]]
    many = frame(spark, rest + [(ids[0], t, *once[0][2:]) for t in texts])
    single = frame(spark, rest + [(ids[0], least, *once[0][2:])])
    a, b = Q.train(many, labels), Q.train(single, labels)
    probe = Q.encode(pa.array([t for _, t, *_ in rows], pa.string()))
    assert np.allclose(a.score(*probe), b.score(*probe))


def test_score_equals_plain_loops():
    r = np.random.default_rng(0)
    width, gates, counts = 5, 3, np.array([1, 4, 2])
    h = r.normal(size=(counts.sum(), width))
    model = Q.Model(r.normal(size=width), r.random(width) + 0.5, r.normal(size=(width, gates)), r.normal(size=(width, gates)), r.normal(size=gates),
                          r.normal(size=width), 0.3)
    want, at = [], 0
    for n in counts:
        rows = [(x - model.mean) / model.scale for x in h[at: at + n]]
        at += n
        e = [sum(model.w[g] * math.tanh(x @ model.v[:, g]) / (1 + math.exp(-(x @ model.u[:, g]))) for g in range(gates)) for x in rows]
        a = [math.exp(v) / sum(map(math.exp, e)) for v in e]
        z = sum(w * x for w, x in zip(a, rows))
        want.append(1 / (1 + math.exp(-(z @ model.c + model.b))))
    assert np.allclose(model.score(h, counts), want, rtol=1e-12)


def test_fit_descends_along_the_gradient():
    """Each parameter's first Adam step is rate * sign(gradient): compared with finite differences of the plain loss."""
    r = np.random.default_rng(1)
    width, counts = 4, np.array([3, 1, 5, 2, 4, 3])
    h, y = r.normal(size=(counts.sum(), width)), np.array([1.0, 0, 1, 0, 0, 1])
    zero, one = (Q.fit(h, counts, y, gates=2, steps=n, rate=1e-4, decay=0.0) for n in (0, 1))

    def loss(**change):
        s = np.clip(replace(zero, **change).score(h, counts), 1e-12, 1 - 1e-12)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name in ("v", "u", "w", "c"):
        p, q = getattr(zero, name), getattr(one, name)
        for i in np.ndindex(p.shape):
            step = np.zeros_like(p)
            step[i] = 1e-5
            slope = (loss(**{name: p + step}) - loss(**{name: p - step})) / 2e-5
            if abs(slope) > 1e-6:
                assert np.sign(q[i] - p[i]) == -np.sign(slope), (name, i)
