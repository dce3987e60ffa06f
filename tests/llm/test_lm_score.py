import math
from collections import Counter

import pytest
from corpus import corpus, frame

from aloft.llm.common import chunk_of
from aloft.llm.lm_score import cross_entropy_difference


def brute(rows, target):
    grams = lambda t: list(zip([None, *t[:-1]], t))
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    c, b = [Counter(), Counter()], [Counter(), Counter()]
    for i, w in words:
        for k in (0, 1):
            if k == 0 or i in target:
                c[k].update(w + [None] * bool(w))
                b[k].update(grams(w))
    size = [sum(n for x, n in m.items() if x is not None) for m in c]
    v = len([x for x in c[0] if x is not None])
    out = {}
    for i, w in words:
        own, pairs, loss = Counter(w + [None] * bool(w)), Counter(grams(w)), [0.0, 0.0]
        for h, x in grams(w):
            for k in (0, 1):
                f = k == 0 or i in target
                u = (c[k][x] - f * own[x] + 0.5) / (size[k] - f * len(w) + 0.5 * (v + 1))
                loss[k] -= math.log((b[k][h, x] - f * pairs[h, x] + 2 * u) / (c[k][h] - f * own[h] + 2))
        out[i, len(w)] = (loss[1] / len(w), loss[0] / len(w)) if w else (None, None)
    return out


@pytest.mark.parametrize("chunk_bytes,target", [(2000, set(range(0, 60, 2))), (4 << 20, set(range(30))), (5000, set())])
def test_matches_plain_models(spark, chunk_bytes, target):
    rows = corpus(seed=5, n=150)
    ids = spark.createDataFrame([(i,) for i in [*target, None, 3, 999_999] if i != 3 or 3 in target], "doc_id long")
    got = cross_entropy_difference(frame(spark, rows), ids, chunk_bytes=chunk_bytes).collect()
    want = brute(rows, target)
    assert len(got) == len(rows)
    for r in got:
        t, b = want[r["doc_id"], r["n_words"]]
        if t is None:
            assert r["target_loss"] is None and r["score"] is None
        else:
            assert r["target_loss"] == pytest.approx(t, rel=1e-6) and r["background_loss"] == pytest.approx(b, rel=1e-6)
            assert r["score"] == pytest.approx(t - b, abs=1e-5)


def test_many_texts_under_one_id_and_under_none(spark):
    rows = [(7 if k % 2 else None, f"w{k % 50} v{k % 7} u{k}", "en", "s", 1, 1, "", "", "", "", "") for k in range(5000)]
    docs = frame(spark, rows)
    chunks = docs.groupBy(chunk_of(20).alias("chunk"), "doc_id").count().collect()
    assert len(chunks) == 40 and max(r["count"] for r in chunks) < 250
    ids = spark.createDataFrame([(7,)], "doc_id long")
    got = {chunk_bytes: sorted((r["doc_id"] or 0, r["n_words"], round(r["target_loss"], 9), round(r["background_loss"], 9)) for r in
                               cross_entropy_difference(docs, ids, chunk_bytes=chunk_bytes).collect()) for chunk_bytes in (4000, 4 << 20)}
    assert len(got[4000]) == 5000 and got[4000] == got[4 << 20]      # the chunks don't show in the scores


def test_empty(spark):
    ids = spark.createDataFrame([], "doc_id long")
    assert cross_entropy_difference(frame(spark, []), ids).count() == 0
