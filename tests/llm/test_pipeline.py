"""The pipeline against plain versions of its stages, each judged on its own input."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import test_jaccard_join
import test_mixing
from corpus import corpus, frame
from test_secret_scan import base
from tokenizers import Tokenizer

import corpus_pipeline as P
from aloft.llm import queries, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def bag(rows):
    return Counter(tuple(r[c] for c in COLUMNS) for r in rows)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Prose with copies and secrets, and junk; labels for some of it."""
    d = str(tmp_path_factory.mktemp("sf"))
    r = random.Random(2)
    rows = corpus(seed=21, n=150)
    junk = [(2000 + i, " ".join(f"W{r.randrange(9)}!!" for _ in range(r.randint(20, 200))), "en", "src0", 5, 7, "t", "s", "x", "k", "n") for i in range(40)]
    frame(spark, rows + junk).write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, 0) for i, *_ in rows if i is not None and i % 2 == 0] + [(i, 0, 0) for i, *_ in junk if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The input and output of each stage, written and read again as the driver does."""
    out, docs = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = tmp_path_factory.mktemp("stages")
    for name, function in P.STAGES:
        function(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        new = spark.read.parquet(f"{top}/{name}")
        out.append((docs, new))
        docs = new
    return out


def test_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "secrets", "mixing", "packing"]
    assert all(new.columns == COLUMNS for _, new in stages[:-1])


def test_quality(spark, sf_dir, stages):
    docs, new = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = docs.collect()
    taught = [(r["doc_id"], r["text"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    bags = sorted((i, h.tobytes(), y) for i, t, y in taught for h in [quality.encode(pa.array([t], pa.string()))[0][:, :]])
    bags = [(i, np.frombuffer(h, np.float32).reshape(-1, quality.WIDTH), y) for i, h, y in bags]
    bags = [(h[np.unique(np.linspace(0, len(h) - 1, min(len(h), 64)).astype(int))], y) for _, h, y in bags]
    model = quality.fit(np.concatenate([h for h, _ in bags]), np.array([len(h) for h, _ in bags]), np.array([y for _, y in bags], dtype=float))
    score = model.score(*quality.encode(pa.array([r["text"] for r in rows], pa.string())))
    assert bag(new.collect()) == bag([r for r, s in zip(rows, score, strict=True) if s >= 0.3])
    kept = {r["doc_id"] for r in new.collect()}
    assert not any(i is not None and i >= 2000 for i in kept)          # the junk is gone, the prose with words is not
    assert sum(i is not None and i < 150 for i in kept) > 140


def test_near_copies(stages):
    docs, new = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    classes = test_jaccard_join.brute(rows)
    assert len(new.collect()) == len({c for _, c, *_ in classes})
    assert {r["doc_id"] for r in new.collect()} == {c for _, c, *_ in classes}
    assert not bag(new.collect()) - bag(docs.collect())


def test_secrets(stages):
    docs, new = stages[2]
    before, after = bag(docs.collect()), bag(new.collect())
    with_secret = Counter({r: n for r, n in before.items() if base(r[1] or "")})
    assert with_secret and before - with_secret == after & (before - with_secret)
    changed = after - before
    assert sum(changed.values()) == sum(with_secret.values()) and not any(base(r[1] or "") for r in changed)
    assert all(len(r[1]) == r[4] for r in changed)


def test_mixture(spark, stages):
    docs, new = stages[3]
    rows = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]

    def domain(source):
        digits = ""
        for c in reversed(source or ""):
            if not c.isdigit():
                break
            digits = c + digits
        return "d" + str(int(digits or 0) % 4)

    want = test_mixing.brute([(i, t, lang, s) for i, t, lang, s, _ in rows], queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_EPOCHS,
                             queries.MIX_SEED, domain)
    got = Counter((r["doc_id"], r["text"] or "", r["lang"] or "", r["source"] or "") for r in new.collect())
    copies = Counter()
    for (i, t, _, lang, s, _), n in want.items():
        copies[i, t, lang, s] += n
    assert got == copies


def test_pieces(stages):
    docs, new = stages[4]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, pieces = docs.collect(), new.collect()
    tokens, got = defaultdict(int), defaultdict(int)
    for r in rows:
        tokens[r["doc_id"]] += len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    for p in pieces:
        got[p["doc_id"]] += p["length"]
    assert got == tokens
    filled = Counter()
    for p in pieces:
        filled[p["sequence_id"]] += p["length"]
    assert all(n == 2048 for s, n in filled.items() if s < max(filled))


def test_run_equals_the_stages(spark, sf_dir, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    total = sum(r["length"] for r in stages[-1][1].collect())
    out = P.run(spark, sf_dir).collect()
    assert sum(r["length"] for r in out) == total and set(key) <= set(out[0].asDict())
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in out if r["start"] == 0) == Counter(
        (r["doc_id"], r["doc_tokens"]) for r in stages[-1][1].collect() if r["start"] == 0)


def test_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
