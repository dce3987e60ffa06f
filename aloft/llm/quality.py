"""Quality classifier (1): gated attention over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded
from its own words: shares of character classes, word shapes, repetition, and
a signed random projection of its words.  A gated attention layer

    e_i = w . (tanh(V h_i) * sigmoid(U h_i)),   a = softmax(e) in the document

weighs the passages, and a logistic layer scores the weighted passage
representation sum_i a_i h_i.  Only documents carry labels; the attention is
learnt from them (gradient descent, numpy).

Learning takes a sample of labelled rows of at most ``max_labelled``
documents (those with the smallest hash of the id) and at most ``max_passages``
passages of each, evenly spaced; both are parameters.  Scoring reads every
passage of every document.

Odd input: a null or empty text is one empty passage and gets a score like
any other; a null id is scored; repeated rows get equal scores; an id with
several labels counts as good if most of them say so; without labels of both
kinds the score is the share of good labels (0.5 without any); an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from aloft.llm.common import Words, mix, slices, spans_of, text_id

PASSAGE = 64
PROJECTED = 16

_KINDS = np.full(256, 9)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?", b"!",
                             b"|", b"$%&*#@^~", b"'\"()[]{}<>", bytes(range(128, 256)))):
    _KINDS[list(_chars)] = _i
_N_KINDS = 10
WIDTH = _N_KINDS + 3 + PROJECTED + 5


def _word_features(words: Words) -> np.ndarray:
    """A row of features for each word of the vocabulary."""
    v = words.vocabulary
    data = np.frombuffer(v.buffers()[2] or b"", dtype=np.uint8) if len(v) else np.zeros(0, np.uint8)
    at = np.frombuffer(v.buffers()[1], dtype=np.int32)[v.offset: v.offset + len(v) + 1].astype(np.int64) if len(v) else np.zeros(1, np.int64)
    length = np.diff(at)
    of, _ = spans_of(length)
    kinds = np.bincount(of * _N_KINDS + _KINDS[data[at[0]: at[-1]]], minlength=len(v) * _N_KINDS).reshape(len(v), _N_KINDS)
    share = kinds / np.maximum(length, 1)[:, None]
    letters = kinds[:, 0] + kinds[:, 1] + kinds[:, 8]
    shape = np.column_stack([np.minimum(length, 40) / 10, (kinds[:, 1] > 0) & (kinds[:, 0] == 0), letters == 0])
    h = mix(np.fromiter(map(xxhash.xxh3_64_intdigest, v.to_pylist()), dtype=np.uint64, count=len(v)))
    signs = ((h[:, None] >> np.arange(PROJECTED, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1
    return np.column_stack([share, shape, signs]).astype(np.float32)


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The encoded passages of all texts, and how many each text has (one at least)."""
    words = Words(texts)
    n_passages = np.maximum(1, -(-words.counts // PASSAGE))
    first = np.cumsum(n_passages) - n_passages
    total = int(n_passages.sum())
    place = np.arange(len(words.index)) - words.starts[words.doc]
    passage = first[words.doc] + place // PASSAGE
    size = np.bincount(passage, minlength=total)
    out = np.zeros((total, WIDTH), dtype=np.float32)
    if len(words.index):
        features = _word_features(words)
        full = np.flatnonzero(size)
        begin = (np.cumsum(size) - size)[full]
        k = features.shape[1]
        out[full, :k] = np.add.reduceat(features[words.index], begin, axis=0) / size[full, None]
        different = np.unique(passage * np.int64(len(words.vocabulary)) + words.index) // len(words.vocabulary)
        same = np.zeros(len(words.index), dtype=bool)
        same[1:] = (words.index[1:] == words.index[:-1]) & (passage[1:] == passage[:-1])
        in_doc = np.unique(words.doc * np.int64(len(words.vocabulary)) + words.index) // len(words.vocabulary)
        doc_share = np.bincount(in_doc, minlength=len(words.counts)) / np.maximum(words.counts, 1)
        scale = np.maximum(size, 1)
        out[:, k] = np.bincount(different, minlength=total) / scale
        out[:, k + 1] = np.bincount(passage[same], minlength=total) / scale
        out[:, k + 2] = np.repeat(doc_share, n_passages)
        out[:, k + 3] = np.minimum(size, PASSAGE) / PASSAGE
    out[:, -1] = size == 0
    return out, n_passages


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: float

    def score(self, passages: np.ndarray, counts: np.ndarray) -> np.ndarray:
        h = (passages - self.mean) / self.scale
        z = _attend(h, counts, self.v, self.u, self.w)[0]
        return 1 / (1 + np.exp(-(z @ self.c + self.b)))


def _attend(h, counts, v, u, w):
    starts = np.cumsum(counts) - counts
    t, g = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
    e = (t * g) @ w
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    a /= np.repeat(np.add.reduceat(a, starts), counts)
    return np.add.reduceat(a[:, None] * h, starts, axis=0), a, t, g, starts


def fit(passages: np.ndarray, counts: np.ndarray, labels: np.ndarray, gates: int = 8, steps: int = 250,
        rate: float = 0.03, decay: float = 1e-4, seed: int = 7) -> Model:
    """Gradient descent (Adam) on the documents' log loss."""
    width = passages.shape[1] if len(passages) else WIDTH
    zero = np.zeros((width, gates))
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(width), np.ones(width), zero, zero, np.zeros(gates), np.zeros(width), float(np.log(share / (1 - share))))
    mean, scale = passages.mean(axis=0), passages.std(axis=0) + 1e-3
    h = ((passages - mean) / scale).astype(np.float64)
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, 0.1, (width, gates)), rng.normal(0, 0.1, (width, gates)), rng.normal(0, 0.1, gates), np.zeros(width), np.zeros(1)]
    m, s = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    for step in range(1, steps + 1):
        v, u, w, c, b = p
        z, a, t, g, starts = _attend(h, counts, v, u, w)
        y = 1 / (1 + np.exp(-(z @ c + b[0])))
        d = (y - labels) / len(labels)
        da = (h @ c) * np.repeat(d, counts)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        gate = de[:, None] * w
        grads = [h.T @ (gate * g * (1 - t * t)), h.T @ (gate * t * g * (1 - g)), (t * g).T @ de, z.T @ d, np.array([d.sum()])]
        for i, grad in enumerate(grads):
            grad = grad + decay * p[i] * (i < 4)
            m[i] = 0.9 * m[i] + 0.1 * grad
            s[i] = 0.999 * s[i] + 0.001 * grad * grad
            p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, *p[:4], float(p[4][0]))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 3000,
          max_passages: int = 64) -> Model:
    """A model learnt from labelled rows that are not held out."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.avg(label).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    # one text per chosen id, so max_labelled bounds the rows that the driver gets and no id outweighs the others
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y")
              .agg(F.min(F.struct(text_id().alias("tid"), "text")).alias("k")).select("doc_id", "k.text", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            h, counts = encode(batch.column("text"))
            ends = np.cumsum(counts)
            rows = []
            for lo, hi in zip(ends - counts, ends, strict=True):
                at = np.unique(np.linspace(lo, hi - 1, min(hi - lo, max_passages)).astype(int))
                rows.append(h[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(rows, pa.binary())], names=["doc_id", "y", "h"])

    t = sample.mapInArrow(run, "doc_id long, y double, h binary").toArrow().sort_by([("doc_id", "ascending"), ("h", "ascending")])
    bags = [np.frombuffer(x, dtype="<f4").reshape(-1, WIDTH) for x in t.column("h").to_pylist()]
    counts = np.array([len(x) for x in bags], dtype=np.int64)
    y = (t.column("y").to_numpy() >= 0.5).astype(float)
    return fit(np.concatenate(bags) if bags else np.zeros((0, WIDTH)), counts, y)


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (0 to 1) in a last column; one narrow pass."""
    if name in docs.columns:
        docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, 1 << 20):
            s = model.score(*encode(b.column(b.schema.get_field_index(text_col))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
