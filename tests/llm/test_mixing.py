import hashlib
import re
from collections import Counter, defaultdict

import pytest
from corpus import corpus, frame
from pyspark.sql import functions as F

from aloft.llm import mixing as M


def water(children, budget):
    """children: name -> (cap, weight).  Plain iterative filling in whole tokens, remainders to the first open ones."""
    got, left, rest = {}, dict(children), budget
    left = {n: cw for n, cw in left.items() if cw[1] > 0}
    order = sorted(left, key=lambda n: (left[n][0] / left[n][1], n))
    while left:
        w = sum(x[1] for x in left.values())
        full = [n for n, (cap, wt) in left.items() if cap * w <= rest * wt]
        if not full:
            break
        n = min(full, key=order.index)
        got[n] = left.pop(n)[0]
        rest -= got[n]
    if left:
        w = sum(x[1] for x in left.values())
        share = {n: int(rest * wt / w) for n, (_, wt) in left.items()}
        spare = rest - sum(share.values())
        for k, n in enumerate(x for x in order if x in left):
            got[n] = share[n] + (k < spare)
    return got


def two_domains(source):
    return "d" + str(int((re.search("([0-9]+)$", source or "") or [0, 0])[1]) % 2)


def brute(rows, weights, share, epochs, seed, domain=two_domains):
    leaf = defaultdict(list)
    for i, t, lang, source, *_ in rows:
        text = t or ""
        leaf[domain(source), lang or "", source or ""].append((i, text, len(re.findall(r"[^\x20\x09-\x0D]+", text))))

    def weight(path):
        for p in (path, ("*",) * (len(path) - 1) + path[-1:]):
            if p in weights:
                return weights[p]
        return 1

    tokens = {k: sum(x[2] for x in v) for k, v in leaf.items()}

    def caps(depth, prefix):
        out = Counter()
        for k, v in tokens.items():
            if k[:depth] == prefix:
                out[k[: depth + 1]] += v * epochs
        return {k: (c, weight(k)) for k, c in out.items()}

    budget = {(): int(sum(tokens.values()) * share)}
    for depth in range(3):
        for prefix in [p for p in budget if len(p) == depth]:
            budget.update(water(caps(depth, prefix), budget[prefix]))
    out = []
    for k, docs in leaf.items():
        if k not in budget:
            continue
        full = budget[k] // tokens[k] if tokens[k] else 0
        rest, at = budget[k] - full * tokens[k], 0
        md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
        keyed = defaultdict(list)
        for i, text, n in docs:
            keyed[md5(f"{seed}|{full}|{'' if i is None else i}|{md5(text)}")].append((i, text, n))
        for key in sorted(keyed):
            more = at < rest
            for i, text, n in keyed[key]:
                out += [(i, text, *k, e) for e in range(full + more)]
                at += n
    return Counter(out)


@pytest.mark.parametrize("share,epochs,weights", [
    (1.0, 4, {("d0",): 3, ("*", "en"): 5, ("*", "*", "src0"): 4, ("d1", "de", "src1"): 9}),
    (0.3, 1, {}), (2.5, 3, {("d1",): 50, ("*", "de"): 0}), (9.0, 2, {("d0",): 7})])
def test_matches_plain_filling(spark, share, epochs, weights):
    rows = corpus(n=250)
    domain = F.expr("concat('d', cast(coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) % 2 as string))")
    out = M.mix_sources(frame(spark, rows), domain, weights, share, epochs, seed=4)
    got = Counter((r["doc_id"], r["text"] or "", r["_mix"]["domain"], r["_mix"]["lang"], r["_mix"]["source"], r["_mix"]["epoch"]) for r in out.collect())
    assert got == brute(rows, weights, share, epochs, 4)


def test_empty_and_native(spark):
    out = M.mix_sources(frame(spark, []), F.lit("d"), {})
    assert out.count() == 0
    plan = M.mix_sources(frame(spark, corpus()), F.lit("d"), {})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shortage_goes_to_siblings_first(spark):
    # a/x/s1 is short: its sibling s2 gets the rest, and the other domain nothing of it
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("b", "x", "s3", 1000)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in M.leaf_budgets(leaves, {}, 0.5, 1).collect()}
    assert got == {"s1": 10, "s2": 492, "s3": 503} or got == {"s1": 10, "s2": 493, "s3": 502}


def test_many_leaves_and_a_hot_one_without_broadcast(spark):
    rows = [(i, f"a few words {i}", "en", f"leaf{i}", 1, 7, *"tsxkn") for i in range(2_000)] + [(-i - 1, f"hot {i % 50}", "en", "hot", 1, 7, *"tsxkn") for i in range(1_000)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = M.mix_sources(frame(spark, rows), F.lit("d0"), {("*", "*", "hot"): 500}, 0.7, 2, seed=4)
        got = Counter((r["doc_id"], r["text"] or "", r["_mix"]["domain"], r["_mix"]["lang"], r["_mix"]["source"], r["_mix"]["epoch"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute(rows, {("*", "*", "hot"): 500}, 0.7, 2, 4, lambda s: "d0")


def test_thirty_thousand_leaves(spark):
    rows = [(i, f"a few words {i}", "en", f"leaf{i}", 1, 7, *"tsxkn") for i in range(30_000)] + [(-i - 1, "hot words", "en", "hot", 1, 7, *"tsxkn") for i in range(5_000)]
    out = M.mix_sources(frame(spark, rows), F.lit("d0"), {}, 1.0, 1)
    assert out.count() == len(rows)
