import glob
import zlib

import numpy as np
import public_tokenizers
from corpus import corpus, frame
from tokenizers import Tokenizer

from aloft.llm import mph, token_store
from aloft.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    """{doc_id: sorted ids of its documents}, and the order of ids."""
    plain, out = Tokenizer.from_file(PATH), {}
    for i, t, *_ in rows:
        out.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    return {i: sorted(v) for i, v in out.items()}


def check(spark, rows, got):
    want = brute(rows)
    got = sorted(got, key=lambda r: r["start"])
    assert len(got) == len(rows)
    at = 0
    for r in got:                                             # gapless, in ascending order of the ids, null first
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    mine = {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
        mine.setdefault(r["doc_id"], []).append(ids.tolist())
    assert {i: sorted(v) for i, v in mine.items()} == want


def test_store_equals_the_tokenizer(spark):
    rows = corpus()
    for shard_ids, bucket_keys in ((16 << 20, 50_000), (500, 7)):
        path = scratch_path(spark, "test-tokens")
        shards = token_store.write_store(frame(spark, rows), PATH, path, shard_ids=shard_ids, bucket_keys=bucket_keys)
        total = shards.agg({"docs": "sum"}).first()[0]
        assert total == len(rows)
        check(spark, rows, token_store.fetch(spark, path, frame(spark, rows), with_ids=True).collect())
    assert shards.count() > 20


def test_payload_is_the_raw_ids(spark):
    rows = [(i, f"word{i} and words", *[None] * 9) for i in range(30)]
    path = scratch_path(spark, "test-tokens")
    token_store.write_store(frame(spark, rows), PATH, path, shard_ids=20)
    plain = Tokenizer.from_file(PATH)
    raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(path.replace("file:", "") + "/payload/*.ids")))
    assert np.frombuffer(raw, "<u2").tolist() == [x for _, t, *_ in rows for x in plain.encode(t, add_special_tokens=False).ids + [2]]


def test_keyed_access(spark):
    rows = corpus(n=40)
    path = scratch_path(spark, "test-tokens")
    token_store.write_store(frame(spark, rows), PATH, path, shard_ids=300, bucket_keys=5)
    keys = spark.createDataFrame([(5,), (5,), (None,), (987654321,), (-77,), (1003,)], "doc_id long")
    got = token_store.fetch(spark, path, keys).collect()
    ids = [i for i, *_ in rows]
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i in ids if i in (5, None, 1003))


def test_one_id_under_many_documents(spark):
    rows = [(7, "the same row again and again", *[None] * 9)] * 3000 + [(7, f"another {i}", *[None] * 9) for i in range(2000)] + [(8, "", *[None] * 9)]
    path = scratch_path(spark, "test-tokens")
    shards = token_store.write_store(frame(spark, rows), PATH, path, shard_ids=1000)
    assert shards.agg({"docs": "max"}).first()[0] <= 1000
    check(spark, rows, token_store.fetch(spark, path, frame(spark, rows), with_ids=True).collect())


def test_empty_table(spark):
    path = scratch_path(spark, "test-tokens")
    assert token_store.write_store(frame(spark, []), PATH, path).count() == 0
    assert token_store.fetch(spark, path, frame(spark, corpus(n=12))).collect() == []


def test_minimal_perfect_hash():
    r = np.random.default_rng(0)
    for n in (0, 1, 2, 64, 5000):
        high, low = r.integers(0, 1 << 63, n, dtype=np.uint64), r.integers(0, 3, n, dtype=np.uint64)
        table = mph.build(high, low)
        assert sorted(mph.slots(table, high, low).tolist()) == list(range(n))
        assert 64 * len(table["words"]) <= 4.5 * n + 64 * len(table["sizes"])
    strange = r.integers(0, 1 << 63, 5000, dtype=np.uint64)
    slot = mph.slots(table, strange, low)
    known = slot >= 0
    stored = np.zeros(5000, "<u4")
    stored[mph.slots(table, high, low)] = mph.fingerprint(high, low)
    assert not (stored[slot[known]] == mph.fingerprint(strange, low)[known]).any()
    assert len(token_store.unpack_arrays(token_store.pack_arrays(table))["words"]) == len(table["words"])
