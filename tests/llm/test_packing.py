import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus import corpus, frame
from tokenizers import Tokenizer

from aloft.llm.packing import RoundRobin, pack
from aloft.llm import tokens
from aloft.llm.tokens import TokenTable, token_table

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_token_ids_equal_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    texts = [t for _, t, *_ in corpus()] + ["it's <|endoftext|> x<|startoftext|>y", "ΑΣ ΑΣ. İstanbul ǅ Å K ﬁ é", "don't 12ab³ ½ x_y-z 你好 😀 ﷺ \x7f", "ÀÖØÞßàöøÿ×÷ ªº µ I'LL"]
    table = TokenTable(PATH)
    for _ in range(2):                         # the second time from the table
        ids, counts = table.encode(pa.array(texts, pa.string()), 1)
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids + [1], t


@pytest.mark.parametrize("targets", [None, {"a": 1, "b": 3, "c": 1}])
def test_round_robin_in_closed_form(targets):
    totals = {"a": 5000, "b": 70001, "c": 333, "d": 1}
    plan = RoundRobin.of(totals, targets, 256, 32)
    sent = plan.sent(np.arange(plan.rounds + 1))
    assert (np.diff(sent, axis=0) >= 0).all() and (sent[-1] == plan.totals).all() and not sent[0].any()
    assert (np.abs(sent.sum(axis=1)[:-1] - 256 * np.arange(plan.rounds)) <= 32 * 4).all()
    cover = np.zeros(sum(totals.values()), dtype=int)
    rng = np.random.default_rng(0)
    for k, name in enumerate(plan.names):
        cuts = np.unique(np.append(rng.integers(1, totals[name], totals[name] // 90), [0, totals[name]]))
        start, n = cuts[:-1], np.diff(cuts)
        run, first, length, place, b = plan.pieces(np.full(len(start), k), start, n)
        assert (np.bincount(run, weights=length) == n).all() and (place // 256 == (place + length - 1) // 256).all()
        x = (start[run] + first)
        assert (sent[b, k] <= x).all() and (x + length <= sent[b + 1, k]).all()
        for p, m in zip(place, length, strict=True):
            cover[p: p + m] += 1
    assert (cover == 1).all()


def test_every_window_has_the_target_proportions():
    plan = RoundRobin.of({"a": 100_000, "b": 50_000, "c": 10_000}, None, 2048, 128)
    got = np.diff(plan.sent(np.arange(plan.rounds)), axis=0)
    assert (np.abs(got - plan.totals / plan.totals.sum() * 2048) < 128 + 1).all()


@pytest.mark.parametrize("totals,names", [({"hot": 2_000_000_000, "small": 500}, ["small"]), ({f"s{i:03}": 3000 for i in range(300)}, None)])
def test_pieces_look_at_their_own_grains_only(totals, names):
    plan = RoundRobin.of(totals, None, 2048, 128)
    source = np.concatenate([np.full(-(-totals[n] // 500), plan.names.index(n)) for n in names or plan.names])
    start = np.concatenate([np.arange(0, totals[n], 500) for n in names or plan.names])
    tracemalloc.start()
    run, first, length, place, b = plan.pieces(source, start, np.full(len(start), 500))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    assert (np.bincount(run, weights=length) == 500).all()
    k, x = source[run], start[run] + first
    rows = np.arange(len(b))
    assert (plan.sent(b)[rows, k] <= x).all() and (x + length <= plan.sent(b + 1)[rows, k]).all()
    if names is None:
        order = np.argsort(place)
        assert (place[order] == np.cumsum(length[order]) - length[order]).all() and length.sum() == sum(totals.values())


def check_pieces(rows, out, window):
    """Sequences are full and gapless, and every id of every document lies in one piece."""
    plain = Tokenizer.from_file(PATH)
    length = Counter()
    by_seq = defaultdict(list)
    for r in out:
        length[r["sequence_id"]] += r["length"]
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for s, pieces in by_seq.items():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at == window or s == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(plain.encode(t or "", add_special_tokens=False).ids + [1])
    assert sum(length.values()) == sum(len(x) for v in ids.values() for x in v)
    of = defaultdict(list)
    for r in out:
        of[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    for i, v in ids.items():
        if len(v) == 1:
            at = 0
            for s, n, crc in sorted(of[i]):
                assert s == at and crc == zlib.crc32(np.array(v[0][s: s + n], dtype="<u4").tobytes())
                at += n
            assert at == len(v[0])
        else:
            assert sum(p[1] for p in of[i]) == sum(map(len, v))


def test_pieces(spark):
    rows = corpus()
    check_pieces(rows, pack(frame(spark, rows), PATH, window=256, grain=16).collect(), 256)
    assert pack(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("targets", [None, {"src0": 2, "src1": 1, "other": 5}])
def test_more_sources_than_queues(spark, targets):
    rows = corpus()
    out = pack(frame(spark, rows), PATH, window=256, grain=16, max_sources=3, targets=targets).collect()
    check_pieces(rows, out, 256)
    assert {r["source"] for r in out} == {r[3] or "" for r in rows}


def test_twenty_thousand_sources(spark):
    rows = [(i, f"a few words {i}", "en", f"s{i}", 1, 7, *"tsxkn") for i in range(20_000)] + [(-i - 1, "the hot source", "en", "hot", 1, 7, *"tsxkn") for i in range(10_000)]
    check_pieces(rows, pack(frame(spark, rows), PATH).collect(), 2048)


def test_a_workers_table_is_bounded_and_empty_after_a_task(monkeypatch):
    monkeypatch.setattr(tokens, "_TABLE_BYTES", 20_000)
    plain = Tokenizer.from_file(PATH)
    with token_table(PATH) as table:
        most = 0
        for i in range(20):
            texts = [f"word{i}x{j} common words ÜBER" for j in range(30)]
            ids, counts = table.encode(pa.array(texts), 1)
            assert ids.tolist() == [x for t in texts for x in [*plain.encode(t, add_special_tokens=False).ids, 1]]
            most = max(most, len(table.at))
        assert 0 < most < 300 and table.held > 0
    assert list(table.at) == ["\n"] and not len(table.ids) and not table.held
