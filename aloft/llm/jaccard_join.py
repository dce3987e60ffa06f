"""N-gram Jaccard join (7): MinHash LSH forest, then exact verification.

Two texts are linked if the Jaccard similarity of their sets of ``SHINGLE``-word
shingles is at least ``threshold``.  A text of fewer words has one shingle (all its words);
texts without a word are linked to no other text.

Each different text gets a MinHash signature of ``trees`` x ``labels`` values: its
path of labels in each of the forest's prefix tries.  Sorted by path, the texts
that share a prefix are neighbours.  The match starts at the full paths and the
prefixes are shortened label by label until a pair at the threshold meets in some
trie with at least the target recall, 1 - (1 - t^depth)^trees >= recall
(``stop_depth``).  All texts below a trie node of that depth form a group.

Groups are cut into blocks by rows and bytes, and pairs of blocks are verified in tasks of
their own: a pair is looked at in the first trie in which it meets only, dropped
if sizes or signatures (by more than six standard deviations) rule the threshold out,
and otherwise verified on the exact sets.  A task returns for each text its number of
links, and a spanning forest of them: never the pairs, of which a large group has very many.

Odd input: a null text is an empty text; equal texts are one text with several
documents (class members of each other, counted in ``n_links``); a null id is kept; repeated rows get
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import Rolling, Words, mix, slices, spans_of, text_id
from aloft.llm.graph import components
from aloft.sources.io import stage

SHINGLE = 5
TREES, LABELS = 16, 6


def stop_depth(trees: int, labels: int, threshold: float, recall: float) -> int:
    """Labels of prefix to match: shortened from the full path until the recall at the threshold suffices."""
    for depth in range(labels, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    raise ValueError("more trees are needed for this recall")


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingles of all texts, in order and with repeats, and how many each text has."""
    words = Words(texts)
    n = np.where(words.counts > 0, np.maximum(1, words.counts - SHINGLE + 1), 0)
    of, place = spans_of(n)
    length = np.minimum(words.counts, SHINGLE)[of]
    return Rolling(words.hashes()).run(words.starts[of] + place, length), n


def _sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of each run, sorted, and how many."""
    of = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.bincount(of[new], minlength=len(counts))


def signatures(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """MinHash signatures (32 bits a value) of runs of shingles; an empty run has all bits set."""
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full((len(counts), size), np.uint32(0xFFFFFFFF))
    full = np.flatnonzero(counts)
    begin = (np.cumsum(counts) - counts)[full]
    if len(full):
        for k in range(size):
            # a multiplication and the high bits, then a shift that the next multiplication depends on
            h = (values ^ (values >> np.uint64(29))) * odd[k]
            out[full, k] = np.minimum.reduceat((h >> np.uint64(32)).astype(np.uint32), begin)
    return out


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tid, n_shingles, n_bytes, sig): one narrow pass over the texts; ``n_shingles`` counts different ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            values, n = shingles(b.column("text"))
            ends = np.cumsum(n)
            different = np.array([len(np.unique(values[e - m: e])) for e, m in zip(ends.tolist(), n.tolist(), strict=True)], dtype=np.int64)
            sig = signatures(values, n, TREES * LABELS)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("tid"), pa.array(different), pc.binary_length(b.column("text")).cast(pa.int64()),
                 pa.array([x.tobytes() for x in sig.astype("<u4")], pa.binary())], names=["doc_id", "tid", "n_shingles", "n_bytes", "sig"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .select("doc_id", text_id().alias("tid"), "text")
    return d.mapInArrow(run, "doc_id long, tid binary, n_shingles long, n_bytes long, sig binary")


def _paths(texts: DataFrame, depth: int) -> DataFrame:
    """(tid, tree, node, n_bytes): the trie node of each text at ``depth`` in each tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), dtype="<u4").reshape(-1, TREES, LABELS)
            node = np.zeros((len(sig), TREES), dtype=np.uint64)
            for k in range(depth):
                node = mix(node * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k].astype(np.uint64) + np.uint64(1))
            at = np.repeat(np.arange(len(sig)), TREES)
            yield pa.RecordBatch.from_arrays(
                [b.column("tid").take(pa.array(at)), pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(sig))),
                 pa.array(node.ravel().view(np.int64)), b.column("n_bytes").take(pa.array(at))], names=["tid", "tree", "node", "n_bytes"])

    return texts.select("tid", "n_bytes", "sig").mapInArrow(run, "tid binary, tree int, node long, n_bytes long")


def _surviving(sig: np.ndarray, sizes: np.ndarray, block: np.ndarray, tree: int, depth: int, left: int, right: int,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs between the blocks ``left`` and ``right`` (or inside one) to be verified here."""
    a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
    bound = threshold - 6 * np.sqrt(threshold * (1 - threshold) / sig.shape[1])
    shaped = sig.reshape(len(sig), TREES, LABELS)
    out_a, out_b = [], []
    for lo in range(0, len(a), 256):
        x = a[lo: lo + 256]
        ok = (x[:, None] < b[None, :]) if left == right else np.ones((len(x), len(b)), dtype=bool)
        small, big = np.minimum(sizes[x][:, None], sizes[b]), np.maximum(sizes[x][:, None], sizes[b])
        ok &= small >= threshold * big - 1e-9
        i, j = np.nonzero(ok)
        for part in range(0, len(i), 200_000):
            p, q = x[i[part: part + 200_000]], b[j[part: part + 200_000]]
            keep = np.ones(len(p), dtype=bool)
            for t in range(tree):                              # met before: verified there
                keep &= (shaped[p, t, :depth] != shaped[q, t, :depth]).any(axis=1)
            p, q = p[keep], q[keep]
            alike = np.zeros(len(p), dtype=np.int32)
            for t in range(TREES):
                alike += (shaped[p, t] == shaped[q, t]).sum(axis=1, dtype=np.int32)
            keep = alike >= bound * sig.shape[1]
            out_a.append(p[keep])
            out_b.append(q[keep])
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _linked(texts: pa.Array, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of texts reach the threshold, on their exact sets of shingles."""
    used, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a):]
    values, n = _sets(*shingles(texts.take(pa.array(used))))
    of = np.repeat(np.arange(len(used)), n)
    common = np.zeros(len(a), dtype=np.int64)
    if len(used) <= 8:
        ends = np.cumsum(n)
        runs = [values[e - m: e] for e, m in zip(ends, n, strict=True)]
        common = np.array([len(np.intersect1d(runs[i], runs[j], assume_unique=True)) for i, j in zip(a, b, strict=True)], dtype=np.int64)
    else:
        _, column, held = np.unique(values, return_inverse=True, return_counts=True)
        shared = held[column] > 1                             # a shingle of one text alone is in no intersection
        of, column = of[shared], column[shared]
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        of, column = of[order], column[order]
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            s = slice(*np.searchsorted(column, [lo, lo + 4096]))
            has = np.zeros((len(used), 4096), dtype=np.float32)
            has[of[s], column[s] - lo] = 1
            common += (has @ has.T)[a, b].astype(np.int64)
    return common >= threshold * (n[a] + n[b] - common) - 1e-9


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The positions of links that make up a spanning forest."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(i)
    return np.array(out, dtype=np.int64)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups out of batches that are sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and tuple(c[0] for c in columns) != last
        at = 0
        for cut in np.flatnonzero(new).tolist():
            held.append(b.slice(at, cut - at))
            yield pa.Table.from_batches([h for h in held if h.num_rows])
            held, at = [], cut
        held.append(b.slice(at))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def links(texts: DataFrame, docs: DataFrame, text_col: str, threshold: float, recall: float, block_rows: int,
          block_bytes: int) -> DataFrame:
    """For different texts (tid, n_docs, sig...): rows (tid, other, texts, docs).

    ``texts`` and ``docs`` are how many linked texts, and documents with them, one task has found for ``tid``;
    rows with ``other`` are links of a spanning forest instead."""
    depth = stop_depth(TREES, LABELS, threshold, recall)
    paths = _paths(texts.where("n_shingles > 0"), depth)
    size = paths.groupBy("tree", "node").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"),
                                              F.sum(F.xxhash64("tid") % 1_000_000_007).alias("s"), F.bit_xor(F.xxhash64("tid")).alias("x")).where("n > 1")
    # a node that holds the same texts as one of an earlier tree has no pair that did not meet there
    size = size.groupBy("n", "bytes", "s", "x").agg(F.min(F.struct("tree", "node")).alias("k")).select("k.tree", "k.node", F.greatest(
        F.ceil(F.col("n") / block_rows), F.ceil(F.col("bytes") / block_bytes)).cast("int").alias("blocks"))
    member = paths.join(size, ["tree", "node"]).withColumn("block", F.pmod(F.xxhash64("tid", "tree"), "blocks").cast("int"))
    pairs = member.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("tid", "tree", "node", "block", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"))
    body = docs.select(text_id(text_col).alias("tid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = pairs.select("tid").distinct()
    body = body.join(wanted, "tid", "left_semi").groupBy("tid").agg(F.first("text").alias("text"))
    full = pairs.join(texts.select("tid", "n_docs", "n_shingles", "sig"), "tid").join(body, "tid")
    keys = ["tree", "node", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tid", "other", "texts", "docs"]
        for g in groups(batches, keys):
            tree, left, right = (g.column(k)[0].as_py() for k in ("tree", "left", "right"))
            sig = np.frombuffer(b"".join(g.column("sig").to_pylist()), dtype="<u4").reshape(g.num_rows, -1)
            a, b = _surviving(sig, g.column("n_shingles").to_numpy(), g.column("block").to_numpy(), tree, depth, left, right, threshold)
            if not len(a):
                continue
            ok = _linked(g.column("text").combine_chunks(), a, b, threshold)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            n, many = g.num_rows, g.column("n_docs").to_numpy()
            ends, others = np.concatenate([a, b]), np.concatenate([b, a])
            found, weight = np.bincount(ends, minlength=n), np.bincount(ends, weights=many[others], minlength=n).astype(np.int64)
            hit, tids = np.flatnonzero(found), g.column("tid").combine_chunks()
            yield pa.RecordBatch.from_arrays([tids.take(pa.array(hit)), pa.nulls(len(hit), pa.binary()),
                                              pa.array(found[hit].astype(np.int64)), pa.array(weight[hit])], names=names)
            tie = _forest(a, b, n)
            zero = pa.array(np.zeros(len(tie), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([tids.take(pa.array(a[tie])), tids.take(pa.array(b[tie])), zero, zero], names=names)

    dealt = full.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "tid binary, other binary, texts long, docs long")


def jaccard_classes(docs: DataFrame, threshold: float = 0.8, recall: float = 0.9995, id_col: str = "doc_id",
                    text_col: str = "text", block_rows: int = 1024, block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: doc_id, tid (its text's identity), root (its class: the least tid in it, never null), class_id
    (the least doc_id of its class, null if it has none; classes may share one), n_links (other documents linked to it,
    copies of its own text included), n_text_links (other texts linked to its text)."""
    signed = stage(sign(docs, id_col, text_col))
    texts = signed.groupBy("tid").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_docs"), F.first("n_shingles").alias("n_shingles"),
                                      F.first("n_bytes").alias("n_bytes"), F.first("sig").alias("sig"))
    found = stage(links(texts, docs, text_col, threshold, recall, block_rows, block_bytes))
    counts = found.where("other is null").groupBy("tid").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    roots = components(found.where("other is not null"), "tid", "other").withColumnsRenamed({"node": "tid"})
    least = signed.groupBy("tid").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_docs"))
    per_text = least.join(roots, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    per_class = per_text.groupBy("root").agg(F.min("least").alias("class_id"))
    per_text = per_text.join(per_class, "root").join(counts, "tid", "left") \
        .select("tid", "root", "class_id", (F.col("n_docs") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    return signed.select("doc_id", "tid").join(per_text, "tid").select("doc_id", "tid", "root", "class_id", "n_links", "n_text_links")


def keep_one(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class (by its root): the one with the least id (a null id last)."""
    names = docs.columns
    slim = [c for c in names if c != text_col]
    keyed = docs.select("*", text_id(text_col).alias("_tid"))
    by_text = classes.groupBy("tid").agg(F.first("root").alias("_class")).withColumnRenamed("tid", "_tid")
    kept = (keyed.select(*slim, "_tid").join(by_text, "_tid")
            .groupBy("_class").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "_tid", *slim)).alias("k"))
            .select("k._tid", *[F.col(f"k.{c}").alias(c) for c in slim]))
    bodies = keyed.select("_tid", text_col).join(kept.select("_tid"), "_tid", "left_semi").groupBy("_tid").agg(F.first(text_col, ignorenulls=True).alias(text_col))
    return kept.join(bodies, "_tid").select(*names)
