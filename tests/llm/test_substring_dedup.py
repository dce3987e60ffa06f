import hashlib
from collections import Counter

import numpy as np
import pytest
from corpus import corpus, frame, ordered

from aloft.llm import substring_dedup
from aloft.llm.fm_index import BitVector, FmIndex, WaveletMatrix, matching_statistics, sorted_suffixes
from aloft.llm.substring_dedup import first_places, remove_repeats


def segments(rng, sigma, n, longest):
    length = rng.integers(1, longest + 1, n)
    symbols = rng.integers(1, sigma, length.sum())
    return symbols, length, [symbols[a:b].tolist() for a, b in zip(np.cumsum(length) - length, np.cumsum(length), strict=True)]


@pytest.mark.parametrize("sigma,n,longest,depth", [(3, 40, 12, 5), (30, 200, 34, 20), (2, 5, 8, 3)])
def test_index_finds_all_occurrences(sigma, n, longest, depth):
    symbols, length, runs = segments(np.random.default_rng(sigma), sigma, n, longest)
    text = [x for k, r in enumerate(runs) for x in [*((1, x) for x in r), (0, k)]]
    _, suffixes, shared = sorted_suffixes(symbols, length, depth)
    assert suffixes.tolist() == sorted(range(len(text)), key=lambda i: text[i: i + longest + 1])
    for x, y, m in zip(suffixes[:-1], suffixes[1:], shared[1:], strict=True):
        assert m == next(k for k in range(depth + 1) if k == depth or text[x + k: x + k + 1] != text[y + k: y + k + 1])
    places = np.random.default_rng(1).permutation(len(symbols))
    place_at = dict(zip([i for i, x in enumerate(text) if x[0]], places.tolist(), strict=True))
    index = FmIndex(symbols, length, depth, places)
    for run, at, matched, low, high in matching_statistics(index, symbols, length):
        for r, p, m, a, b, least in zip(run, at, matched, low, high, index.first_place(low), strict=True):
            assert m == len(runs[r]) - p
            assert set(suffixes[a:b].tolist()) == {i for i in range(len(text)) if text[i: i + m] == [(1, x) for x in runs[r][p:]]}
            if m >= depth:
                assert least == min(place_at[i] for i in range(len(text)) if text[i: i + depth] == [(1, x) for x in runs[r][p: p + depth]])


@pytest.mark.parametrize("sigma,depth", [(2, 4), (3, 6), (4, 3), (9, 20)])
def test_statistics_of_foreign_streams(sigma, depth):
    rng = np.random.default_rng(sigma)
    symbols, length, runs = segments(rng, sigma, 30, 14)
    index = FmIndex(symbols, length, depth, np.arange(len(symbols)))
    held = {tuple(r[i:j]) for r in runs for i in range(len(r)) for j in range(i, len(r) + 1)}
    asked, size, streams = segments(rng, sigma + 1, 40, 18)      # one symbol more than the index has
    got = {(int(r), int(p)): int(m) for run, at, ms, _, _ in matching_statistics(index, asked, size) for r, p, m in zip(run, at, ms, strict=True)}
    for r, s in enumerate(streams):
        for p in range(len(s)):
            longest = max(m for m in range(len(s) - p + 1) if tuple(s[p: p + m]) in held)
            m = got.get((r, p), 0)
            assert m == longest if longest <= depth else depth <= m <= longest
    assert set(got.values()) >= {1, 2}                           # shorter matches than the depth occur and are gone on from


@pytest.mark.parametrize("part_words", [60, 400, 1 << 18])
def test_first_places_by_parts(part_words, monkeypatch):
    rng = np.random.default_rng(part_words)
    stock = rng.integers(1, 5, 300)
    cuts = [(a, a + n) for a, n in zip(rng.integers(0, 250, 60), rng.integers(20, 50, 60), strict=True)]
    runs = sorted({tuple(stock[a:b].tolist()) for a, b in cuts}, key=lambda r: hashlib.md5(str(r).encode()).digest())
    size = np.array([len(r) for r in runs])
    first = rng.permutation(len(runs)).astype(np.int64) << 32
    where: dict = {}
    for r, f in zip(runs, first.tolist(), strict=True):
        for j in range(len(r) - 19):
            where[r[j: j + 20]] = min(where.get(r[j: j + 20], 1 << 62), f + j)
    seen = Counter()
    plain = substring_dedup.matching_statistics

    def watched(index, symbols, lengths, least):
        seen.update(int(m) for _, _, ms, _, _ in plain(index, symbols, lengths) for m in ms)
        return plain(index, symbols, lengths, least)

    monkeypatch.setattr(substring_dedup, "matching_statistics", watched)
    got = first_places(np.concatenate([np.array(r) for r in runs]), size, first, part_words)
    assert got.tolist() == [where[r[j: j + 20]] for r in runs for j in range(len(r) - 19)]
    assert any(m < 20 for m in seen) and any(m >= 20 for m in seen)


def test_select():
    bits = np.random.default_rng(3).random(1000) < 0.1
    bits[200:500] = False
    ones = np.flatnonzero(bits)
    assert BitVector(bits).select(np.arange(len(ones))).tolist() == ones.tolist()


def test_wavelet_rank():
    seq = np.random.default_rng(0).integers(0, 37, 1000)
    w = WaveletMatrix(seq, 37)
    for c in range(37):
        at = np.arange(1001)
        assert (w.rank(np.full(1001, c), at) == np.concatenate([[0], np.cumsum(seq == c)])).all()


def brute(rows):
    docs = {(i, t or "") for i, t, *_ in rows}
    key = lambda d: (d[0] is None, d[0] or 0, int.from_bytes(hashlib.md5(d[1].encode()).digest()[:8], "little"))
    seen, out = set(), {}
    for d in sorted(docs, key=key):
        w = d[1].encode().split()
        gone = set()
        for a in range(len(w) - 19):
            k = tuple(w[a:a + 20])
            if k in seen:
                gone |= set(range(a, a + 20))
            seen.add(k)
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return ordered((i, *out[i, t or ""]) for i, t, *_ in rows)


@pytest.mark.parametrize("chunk_bytes", [3000, 4 << 20])
def test_matches_plain_windows(spark, chunk_bytes):
    rows = corpus(seed=11, n=200)
    got = remove_repeats(frame(spark, rows), chunk_bytes=chunk_bytes).collect()
    assert ordered(tuple(r) for r in got) == brute(rows)


@pytest.mark.parametrize("part_words", [200, 3000])
def test_many_parts_match_plain_windows(spark, part_words):
    rows = corpus(seed=11, n=200)
    got = remove_repeats(frame(spark, rows), chunk_bytes=100_000, part_words=part_words).collect()
    assert ordered(tuple(r) for r in got) == brute(rows)


def test_a_passage_of_all_documents_is_sent_once_a_chunk(spark):
    passage = " ".join(f"p{i}" for i in range(22))
    rows = [(i, " ".join([*(f"a{i}x{k}" for k in range(30)), passage, *(f"b{i}x{k}" for k in range(30))]), "en", "s", 1, 1, "", "", "", "", "")
            for i in range(1500)]
    sent, chunks = Counter(), set()
    for r in substring_dedup._routed(frame(spark, rows), "doc_id", "text", 20_000)[0].collect():
        chunks.add(r["chunk"])
        if r["kind"] == substring_dedup.SEGMENT:
            sent[r["shard"]] += len(r["start"]) // 4
            assert len(r["words"]) // 8 <= 22 + 19 * len(r["start"]) // 4   # the passage alone: what stands around it is not repeated
    assert sum(sent.values()) <= 3 * len(chunks)
    assert ordered(tuple(r) for r in remove_repeats(frame(spark, rows), chunk_bytes=20_000).collect()) == brute(rows)


@pytest.mark.parametrize("chunk_bytes", [2000, 4 << 20])
def test_equal_words_and_edges(spark, chunk_bytes):
    same = " ".join(["w"] * 120)
    head = " ".join(f"h{i}" for i in range(40))
    rows = [(i, t, "en", "s", 1, 1, "", "", "", "", "") for i, t in enumerate(
        [same, same + " end", head, f"{head} {same}", f"x {head[:-4]}", " ".join(head.split()[10:]), f"{same} {head} {same}", None, ""])]
    rows += [(None, f"{head} z{i % 3}", *rows[0][2:]) for i in range(6)]
    got = remove_repeats(frame(spark, rows), chunk_bytes=chunk_bytes).collect()
    assert ordered(tuple(r) for r in got) == brute(rows)


def test_empty(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
