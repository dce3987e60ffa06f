from collections import Counter, defaultdict

import pytest
from corpus import corpus, frame, ordered

from aloft.llm import jaccard_join as J
from aloft.llm.graph import components
from aloft.llm.queries import op7_jaccard_join


def brute(rows):
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[t or ""].append(i)
    sets = {}
    for t in texts:
        w = t.encode().split()
        sets[t] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    names = list(texts)
    root = {t: t for t in names}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    docs, others = Counter(), Counter()
    for x, a in enumerate(names):
        for b in names[x + 1:]:
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                docs[a] += len(texts[b])
                docs[b] += len(texts[a])
                others[a] += 1
                others[b] += 1
                root[find(a)] = find(b)
    least = {}
    for t in names:
        for i in texts[t]:
            if i is not None:
                least[find(t)] = min(least.get(find(t), i), i)
    return ordered((i, least.get(find(t or "")), len(texts[t or ""]) - 1 + docs[t or ""], others[t or ""]) for i, t, *_ in rows)


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_matches_all_pairs(spark, block_rows):
    rows = corpus(seed=8, n=260)
    out = J.jaccard_classes(frame(spark, rows), block_rows=block_rows)
    assert ordered(tuple(r) for r in out.select("doc_id", "class_id", "n_links", "n_text_links").collect()) == brute(rows)
    assert J.jaccard_classes(frame(spark, [])).count() == 0


def test_large_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        w[i] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s", 1, 1, "", "", "", "", ""))
    out = J.jaccard_classes(frame(spark, rows), block_rows=40).collect()
    assert {(r["class_id"], r["n_text_links"]) for r in out} == {(0, 149)}


def test_repeats_within_a_text(spark):
    once = " ".join(f"w{i}" for i in range(300))
    phrase = "one two three four five six seven eight "
    texts = [once, once + " " + once, phrase * 20, phrase * 60]
    rows = [(i, t, "en", "s", 1, 1, "", "", "", "", "") for i, t in enumerate(texts)]
    out = J.jaccard_classes(frame(spark, rows)).select("doc_id", "class_id", "n_links", "n_text_links").collect()
    assert ordered(tuple(r) for r in out) == brute(rows) == [(0, 0, 1, 1), (1, 0, 1, 1), (2, 2, 1, 1), (3, 2, 1, 1)]


def test_keep_one(spark):
    rows = corpus(seed=8, n=200)
    docs = frame(spark, rows)
    classes = J.jaccard_classes(docs)
    out = J.keep_one(docs, classes).collect()
    want = {c for _, c, *_ in brute(rows)}
    assert len(out) == len({r[1] for r in brute(rows)}) and {r["doc_id"] for r in out} == want
    assert J.keep_one(docs, classes).columns == docs.columns


def test_classes_that_share_an_id_or_have_none(spark):
    text = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdefg"]
    near = text[0].replace("a39", "x")
    ids = [(None, text[0]), (None, near), (None, text[1]), (None, text[2]), (None, ""), (5, text[3]), (5, text[4]), (9, text[4] + " x"), (7, text[5]), (None, text[5]), (8, text[6])]
    docs = frame(spark, [(i, t, "en", "s", 1, 1, "", "", "", "", "") for i, t in ids])
    classes = J.jaccard_classes(docs)
    by_tid = {}
    for r in classes.collect():
        by_tid.setdefault(bytes(r["root"]), set()).add(r["class_id"])
    assert len(by_tid) == 8 and ordered((c,) for v in by_tid.values() for c in v) == ordered([(5,), (5,), (7,), (8,)] + [(None,)] * 4)
    out = J.keep_one(docs, classes).collect()
    assert len(out) == 8
    kept = ordered((r["doc_id"], r["text"]) for r in out if r["text"] not in (text[0], near))
    assert kept == ordered([(None, text[1]), (None, text[2]), (None, ""), (5, text[3]), (5, text[4]), (7, text[5]), (8, text[6])])


def test_op7_tells_classes_without_an_id_apart(spark, tmp_path):
    rows = [(None, " ".join(f"{c}{k}" for k in range(40)), "en", "s", 1, 1, "", "", "", "", "") for c in "abc"]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert len({r["class_root"] for r in op7_jaccard_join(spark, str(tmp_path)).collect()}) == 3


def test_stop_depth():
    assert J.stop_depth(16, 6, 0.8, 0.9995) == 4
    with pytest.raises(ValueError):
        J.stop_depth(1, 6, 0.8, 0.999)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 150)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
