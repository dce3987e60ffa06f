"""Hard-negative mining (13): exact windows of an inverted multi-index, shard by shard.

A score is the integer inner product of floor(scale * component).  For each anchor the first ``positives`` other
rows of its label are found first; each of them opens a window: the rows of other labels whose score lies between
``low`` and ``high`` hundredths of the positive's score, of which the first ``negatives`` are returned (higher scores first,
ties by smaller id).

Rows are dealt to shards once; the anchors (with their positives' scores in the second
search) go to every shard, the rows stay where they are.  A shard's task indexes its rows
(``multi_index``) and answers the anchors as they stream in.  A search stops when the next cell's bound
lies below the last positive needed, or below every window's last negative needed (below the window's
lower end, where too few were found), so a shard's answer is exact, and so is the merged one.
The two codebooks are learnt from ``sample`` different rows at most; all rows are indexed, with exact radii.

Odd input: rows with a null id, label or vector, or with a null or non-finite component take no part; shorter vectors
(empty ones too) are as if padded with zeros; integers beyond 2**26 count as that; repeated rows (same id, label and
vector) are one row; rows under an anchor's own id are neither its positives nor its negatives; different rows under
an anchor's id are anchors each; rows of equal vector and label are kept with the least ids that can matter; a positive of score 0 has
the window 0, one below 0 none; an anchor without a row of its label or in its windows gives no row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.blocks import flat_ids, matrix
from aloft.llm.multi_index import MultiIndex, codebook
from aloft.sources.io import stage

CLIP = float(1 << 26)
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
HIT = "anchor_id long, anchor_key long, wanted long, vec_id long, score long"
# lower and upper end of a window, exact: low*p <= 100*s <= high*p
ROW, ASKED = 0, 1


def usable(rows: DataFrame, scale: int, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, with whole numbers as components."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("int").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), c * scale))).cast("int"))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    return v.select("vec_id", "label", whole.alias("vector"))


def dealt(rows: DataFrame, keep: int, shard_rows: int) -> DataFrame:
    """(shard, vector, label, ids): the different pairs of vector and label with their ``keep`` least ids, in a written table.

    The limit per pair works before the shuffle already, so a vector that many rows share does no harm."""
    w = Window.partitionBy("vector", "label").orderBy("vec_id")
    items = (rows.dropDuplicates(["vec_id", "vector", "label"]).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep)
             .groupBy("vector", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    shards = max(1, -(-rows.count() // shard_rows))
    return stage(items.select(F.pmod(F.xxhash64(F.lit(7), "vector", "label"), F.lit(shards)).cast("int").alias("shard"), "vector", "label", "ids"))


def codebooks(items: DataFrame, words: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of both halves, learnt from the ``sample`` rows of least hash among about eight times as many."""
    n, width = items.agg(F.count("*"), F.max(F.size("vector"))).first()
    h = F.xxhash64(F.lit(8), "vector")
    some = items.where(F.pmod(h, F.lit(max(1, n // (8 * sample)))) == 0).select("vector", h.alias("h")).orderBy("h", "vector").limit(sample)
    points = matrix(some.select("vector").toArrow().column("vector"), width or 1)
    half = (points.shape[1] + 1) // 2
    return codebook(points[:, :half], words), codebook(points[:, half:], words)


def streamed(items: DataFrame, asked: DataFrame, shards: int, search) -> DataFrame:
    """Each shard's rows, then all queries, through ``search(batches)``: one task per shard, rows moved once, queries copied to the shards."""
    none = {"anchor_id": "long", "anchor_key": "long", "wanted": "array<long>", "ids": "array<long>"}
    columns = ["shard", "kind", "vector", "label", *none]

    def same(df: DataFrame, kind: int) -> DataFrame:
        df = df.withColumn("kind", F.lit(kind))
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in columns])

    to_all = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = same(items, ROW).unionByName(same(to_all, ASKED))
    return both.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind").mapInArrow(search, HIT)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    for b in batches:
        shard, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
        cuts = np.append(np.append(0, np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1), b.num_rows)
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield int(shard[lo]), int(kind[lo]), b.slice(lo, hi - lo)


class ShardRows:
    """A shard's index with the labels and ids of its rows."""

    def __init__(self, parts: list[pa.RecordBatch], words: tuple[np.ndarray, np.ndarray]):
        table = pa.Table.from_batches(parts)
        self.index = MultiIndex(matrix(table.column("vector"), sum(w.shape[1] for w in words)), words)
        self.label = table.column("label").to_numpy()
        self.ids, row = flat_ids(table.column("ids"))
        self.first = np.searchsorted(row, np.arange(len(self.label) + 1))

    def spread(self, rows: np.ndarray, scores: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows with their scores, without an anchor's own id."""
        n = self.first[rows + 1] - self.first[rows]
        at = np.repeat(self.first[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        other = self.ids[at] != own
        return self.ids[at][other], np.repeat(scores, n)[other]


def _answer(words: tuple[np.ndarray, np.ndarray], one):
    """Streams shards through ``one(shard, query, label, own id, wanted)``, which gives (wanted, ids, scores) triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, shard = None, [], None
        for at, kind, b in _runs(batches):
            if at != held:
                held, parts, shard = at, [], None
            if kind == ROW:
                parts.append(b)
                continue
            if not parts and shard is None:
                continue                                       # a shard without rows
            if shard is None:
                shard, parts = ShardRows(parts, words), []
            queries = matrix(pa.chunked_array([b.column("vector")]), sum(w.shape[1] for w in words))
            out = []
            for q, label, name, key, wanted in zip(queries, *(b.column(c).to_pylist() for c in ("label", "anchor_id", "anchor_key", "wanted")), strict=True):
                out += [(name, key, *found) for found in one(shard, q, label, name, wanted)]
            n = [len(r[3]) for r in out]
            flat = [np.repeat(np.array([r[k] for r in out], dtype=np.int64), n) for k in (0, 1, 2)]
            flat += [np.concatenate([r[k] for r in out]) if out else np.zeros(0, np.int64) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in flat], names=["anchor_id", "anchor_key", "wanted", "vec_id", "score"])
    return run


def first_ones(ids: np.ndarray, scores: np.ndarray, keep: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:keep]


def _positives(keep: int):
    def one(shard: ShardRows, q: np.ndarray, label: int, own: int, wanted):
        def same(rows: np.ndarray, scores: np.ndarray):
            mine = shard.label[rows] == label
            return shard.spread(rows[mine], scores[mine], own)

        def needed(rows: np.ndarray, scores: np.ndarray) -> float:
            got = same(rows, scores)[1]
            return np.partition(got, len(got) - keep)[len(got) - keep] if len(got) >= keep else -np.inf

        ids, scores = same(*shard.index.search(q, needed))
        top = first_ones(ids, scores, keep)
        yield 0, ids[top], scores[top]
    return one


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores s with low*positive <= 100*s <= high*positive."""
    return -(-low * positive // 100), high * positive // 100


def _negatives(keep: int, low: int, high: int):
    def one(shard: ShardRows, q: np.ndarray, label: int, own: int, wanted: list[int]):
        windows = {p: window(p, low, high) for p in wanted}
        windows = {p: w for p, w in windows.items() if w[0] <= w[1]}
        if not windows:
            return

        def other(rows: np.ndarray, scores: np.ndarray):
            use = shard.label[rows] != label
            return shard.spread(rows[use], scores[use], own)

        def needed(rows: np.ndarray, scores: np.ndarray) -> float:
            got, bar = other(rows, scores)[1], np.inf
            for lo, hi in windows.values():
                inside = got[(got >= lo) & (got <= hi)]
                bar = min(bar, np.partition(inside, len(inside) - keep)[len(inside) - keep] if len(inside) >= keep else lo)
            return bar

        ids, scores = other(*shard.index.search(q, needed))
        for p, (lo, hi) in windows.items():
            inside = np.flatnonzero((scores >= lo) & (scores <= hi))
            top = inside[first_ones(ids[inside], scores[inside], keep)]
            yield p, ids[top], scores[top]
    return one


def mine(rows: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
         words: int = 16, sample: int = 4096, shard_rows: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), see above; ``is_anchor`` is on (vec_id, label, vector)."""
    use = usable(rows, scale, label, id_col, vector_col)
    items = dealt(use, max(positives, negatives) + 1, shard_rows)
    shards = (items.agg(F.max("shard")).first()[0] or 0) + 1
    books = codebooks(items, words, sample)
    anchors = stage(use.where(is_anchor).distinct()
                    .select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "vector").alias("anchor_key"), "label", "vector"))
    anchor = ["anchor_id", "anchor_key"]

    def merged(found: DataFrame, by: list[str], keep: int) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)

    first = stage(merged(streamed(items, anchors, shards, _answer(books, _positives(positives))), anchor, positives)
                  .select(*anchor, F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores = first.groupBy(*anchor).agg(F.collect_set("positive_score").alias("wanted"))        # at most ``positives`` each
    found = merged(streamed(items, anchors.join(scores, anchor), shards, _answer(books, _negatives(negatives, low, high))), [*anchor, "wanted"], negatives)
    found = found.select(*anchor, F.col("wanted").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return first.join(found, [*anchor, "positive_score"]).select(*RESULT)
