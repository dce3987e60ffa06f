"""LM scoring (9): cross-entropy difference of matched n-gram models.

The target model is counted on the documents of the target (here: those that
``labels`` calls good), the background model on all documents; both have the same
order (bigrams over interpolated unigrams), the same smoothing and one
shared vocabulary: every word of the corpus, and one place for words unseen.

    P(w | h) = (c(h w) + m * U(w)) / (c(h) + m),    U(w) = (c(w) + a) / (N + a (V + 1))

A document's own counts are taken out of each model that counted it, so a
document is not scored by itself; those of its copies stay in, as they are documents of their own, so a text that comes twice
has a low loss under each model that counted the other copy.  Its score is the mean over its words of
loss under the target minus loss under the background (nats): the lower, the
closer to the target.  The first word of a text follows a start mark.

Counts cover all documents.  They are added up by ``counting``: each chunk of documents sends its
different words and word pairs with their counts, and gets back the totals it
cannot know by itself.  No table of the vocabulary or the pairs exists in one place.

Odd input: a null or empty text has no words and null losses; a null id is scored and
never in the target; repeated rows count as often as they come and get equal scores; without a
target, its model is flat; any number of texts may share an id, or have none; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import Rolling, Words, chunk_of
from aloft.llm.counting import REQUEST, answered, key_bits, requests, totals

_START = np.uint64(0x5BD1E995A7C3F00D)
SCORES = "doc_id long, n_words long, target_loss double, background_loss double, score double"


def _key(h: np.ndarray, bits: int, word: bool) -> np.ndarray:
    """The high ``bits`` of a hash, the lowest of them set for words and clear for pairs."""
    low = np.uint64(1 << (64 - bits))
    return (h & ~(low + (low - np.uint64(1)))) | (low if word else np.uint64(0))


class _Counted:
    """Keys of a chunk: words (lowest bit of the key set) and word pairs, by place and as sorted different keys with counts."""

    def __init__(self, texts: pa.Array, target: np.ndarray, bits: int):
        words = Words(texts)
        self.n_docs, self.doc, self.counts = len(texts), words.doc, words.counts
        h = words.hashes()
        before = np.empty_like(h)
        before[1:] = h[:-1]
        self.first = first = np.zeros(len(h), dtype=bool)
        first[words.starts[words.counts > 0]] = True
        before[first] = _START
        pair = Rolling(np.column_stack([before, h]).ravel()).run(2 * np.arange(len(h)), 2)
        start = _key(_START, bits, True)
        self.keys, index = np.unique(np.concatenate([_key(h, bits, True), _key(pair, bits, False), _key(before, bits, True)]), return_inverse=True)
        n = len(h)
        self.word, self.pair, self.history = index[:n], index[n: 2 * n], index[2 * n:]
        weight = target[self.doc].astype(float)
        # a word counts once as itself; the history of a pair is counted apart from it, as the word before
        all_ = np.bincount(self.word, minlength=len(self.keys)) + np.bincount(self.pair, minlength=len(self.keys))
        inside = np.bincount(self.word, weights=weight, minlength=len(self.keys)) + np.bincount(self.pair, weights=weight, minlength=len(self.keys))
        started = np.searchsorted(self.keys, start)
        if n and self.keys[min(started, len(self.keys) - 1)] == start:
            all_[started] += int(first.sum())
            inside[started] += weight[first].sum()
        self.local = np.column_stack([all_, inside.astype(np.int64)])

    def own(self, index: np.ndarray) -> np.ndarray:
        """How often each place's key occurs in its own document."""
        key = self.doc * np.int64(len(self.keys) + 1) + index
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        return n[back]


def _is_target(t: pa.Table, side: pa.Table) -> np.ndarray:
    return np.isin(t.column("doc_id").fill_null(-1).to_numpy(), side.column("doc_id").drop_null().to_numpy())


def _count(buckets: int, bits: int):
    def run(key, t: pa.Table, side: pa.Table) -> pa.Table:
        c = _Counted(t.column("text").combine_chunks(), _is_target(t, side), bits)
        return pa.Table.from_batches([requests(key[0].as_py(), c.keys, c.local, buckets)])
    return run


def _differs(own: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Totals that a chunk does not know from its own counts."""
    return (own != whole).any(axis=1)


def _score(buckets: int, bits: int, m: float, a: float):
    def run(key, t: pa.Table, side: pa.Table) -> pa.Table:
        target = _is_target(t, side.filter(side.column("bucket").is_null()))
        c = _Counted(t.column("text").combine_chunks(), target, bits)
        vocabulary, *words = side.column("stats").drop_null()[0].as_py()
        known, whole = answered(side.filter(side.column("bucket").is_valid()), c.keys, buckets, 2)
        counts = c.local.copy()
        counts[known] = whole
        loss = []
        in_target = target[c.doc].astype(np.int64)
        own_word = c.own(c.word)
        own_history = np.concatenate([np.ones(1, np.int64), own_word[:-1]])[: len(own_word)]
        own_history[c.first] = 1                                   # the start mark, once a document
        own = (c.own(c.pair), own_history, own_word)
        per_doc = c.counts[c.doc]
        for model, mine in ((1, in_target), (0, np.ones_like(in_target))):
            pair, history, word = (np.maximum(counts[x, model] - o * mine, 0) for x, o in zip((c.pair, c.history, c.word), own, strict=True))
            unigram = (word + a) / (words[model] - per_doc * mine + a * (vocabulary + 1))
            p = (pair + m * unigram) / (history + m)
            loss.append(np.bincount(c.doc, weights=-np.log(p), minlength=c.n_docs))
        n = c.counts
        with np.errstate(invalid="ignore", divide="ignore"):
            target_loss, background = loss[0] / n, loss[1] / n
        none = n == 0
        return pa.Table.from_arrays([t.column("doc_id"), pa.array(n), pa.array(target_loss, mask=none), pa.array(background, mask=none),
                                     pa.array(target_loss - background, mask=none)], names=[f.split()[0] for f in SCORES.split(", ")])
    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             chunk_bytes: int = 4 << 20, m: float = 2.0, a: float = 0.5) -> DataFrame:
    """One row per document (see SCORES); ``target_ids`` has the ids of the target's documents in ``doc_id``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, bits = max(1, -(-total // chunk_bytes)), key_bits(total)

    # by id and text: the texts under one id, or under none, are spread; labels go to the chunks that have their id
    d = d.withColumn("chunk", chunk_of(n))
    texts = d.select("doc_id", "text", "chunk").groupBy("chunk")
    target = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    wanted = d.where("doc_id is not null").select(F.col("chunk").alias("chunk"), F.col("doc_id").alias("doc_id")).distinct().join(target, "doc_id", "left_semi").select("chunk", "doc_id")
    buckets = max(1, n // 2)
    sent = texts.cogroup(wanted.groupBy("chunk")).applyInArrow(_count(buckets, bits), REQUEST)
    back = totals(sent, _differs, 1 << (64 - bits), int(_key(_START, bits, True)))
    # the sums over all chunks: different words, words in each model.  One row, given to every chunk.
    stats = back.where("chunk = -1").agg(F.array(*[F.coalesce(F.sum(F.element_at("stats", i)), F.lit(0)) for i in (1, 2, 3)]).alias("stats"))
    stats = d.sparkSession.range(n).select(F.col("id").cast("int").alias("chunk")).crossJoin(F.broadcast(stats))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("bucket", "int"), ("answered", "binary"), ("totals", "binary"), ("stats", "array<long>"))]
    side = (wanted.select("chunk", "doc_id", *none[1:]).unionByName(back.where("chunk >= 0").select("chunk", none[0], "bucket", "answered", "totals", none[4]))
            .unionByName(stats.select("chunk", *none[:4], "stats")))
    return texts.cogroup(side.groupBy("chunk")).applyInArrow(_score(buckets, bits, m, a), SCORES)
