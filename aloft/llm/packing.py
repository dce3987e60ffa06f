"""Packing (5): deficit round-robin over source queues, in closed form.

Each source is a queue of its documents' tokens.  Round after round (a round
is one window of ``window`` tokens) every source is credited with its share
of the window and sends as many whole grains of ``grain`` tokens as its credit
covers; what is left is its deficit, carried to the next round.  So after b
rounds source s has sent

    sent_s(b) = grain * floor(credit_s(b) / grain),    credit_s(b) = w_s * v(b)

(all that it has, once credit covers that), where the virtual time v(b) solves
sum_s min(T_s, w_s v) = window * b: when a queue runs dry, the others share
its part.  The state after any round follows from the sources' totals alone:
no round waits for another, and deficits carry across windows, partitions and
tasks exactly.  Target weights default to the sources' totals, with which
all queues keep their share to the very end.

The stream of rounds is cut every ``window`` tokens into sequences, so only the last
sequence is padded.  A sequence differs from its round by less than a grain
per source.  A document is cut where its source's turn or a sequence ends.

Tokens go through one written table (ids as 16-bit numbers), one shuffle and
small running totals per (queue, part); the driver gets the totals of the
queues only, ``max_sources`` at most.  With more sources than that the larger ones keep queues of their own and the
others share queues by a hash of their names (a shared queue has its sources' tokens and targets added up): a window
holds window / grain grains, so it could not show more sources at once anyway.

Odd input: a null or empty text is one token (the end id); a null source is the
queue named ''; a null id is kept; repeated rows are packed as often as they
come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import slices, spans_of
from aloft.llm.tokens import token_table
from aloft.sources.io import stage

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "source string, round long")
# cells of (round, source) looked at together
CELLS = 1 << 19


@dataclass(frozen=True)
class RoundRobin:
    names: tuple[str, ...]
    totals: np.ndarray
    weights: np.ndarray
    window: int
    grain: int

    @classmethod
    def of(cls, totals: Mapping[str, int], targets: Mapping[str, float] | None, window: int, grain: int) -> RoundRobin:
        names = tuple(sorted(totals))
        t = np.array([totals[n] for n in names], dtype=np.int64)
        w = t.astype(float) if targets is None else np.array([targets.get(n, 0.0) for n in names])
        w = np.where((w > 0) | (t == 0), w, max(w.max(initial=0.0), 1.0) * 1e-6)     # without a target: last
        return cls(names, t, np.where(t > 0, w, 1.0), window, grain)

    @property
    def rounds(self) -> int:
        return -(-int(self.totals.sum()) // self.window)

    @cached_property
    def _dry(self) -> tuple[np.ndarray, np.ndarray]:
        """The virtual times at which queues run dry, from 0 and ascending, and the tokens of the whole stream up to each."""
        at = self.totals / self.weights
        order = np.argsort(at, kind="stable")
        at, weights = at[order], self.weights[order]
        left = weights[::-1].cumsum()[::-1] - weights
        sent = np.maximum.accumulate(np.cumsum(self.totals[order]) + at * left)
        return np.concatenate([[0.0], at]), np.concatenate([[0.0], sent])

    def _time(self, b: np.ndarray) -> np.ndarray:
        """Virtual time at the beginning of round ``b``."""
        dry, sent = self._dry
        return np.interp(b.astype(float) * self.window, sent, dry)

    def _sent(self, b: np.ndarray, v: np.ndarray, weights: np.ndarray, totals: np.ndarray) -> np.ndarray:
        credit = weights * v
        out = np.minimum(np.floor(credit / self.grain).astype(np.int64) * self.grain, totals)
        return np.where((credit >= totals) | (b >= self.rounds), totals, out)

    def sent(self, b: np.ndarray) -> np.ndarray:
        """Tokens that each source has sent before round ``b`` (rows: rounds, columns: sources)."""
        return self._sent(b[:, None], self._time(b)[:, None], self.weights, self.totals)

    def _sent_of(self, source: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Tokens that one source has sent before round ``b``, for pairs of them."""
        return self._sent(b, self._time(b), self.weights[source], self.totals[source])

    def _round(self, source: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The round in which token ``x`` of a source is sent: about where its grain's credit is reached, then corrected."""
        dry, sent = self._dry
        need = np.minimum((x // self.grain + 1) * self.grain, self.totals[source])
        b = np.ceil(np.interp(need / self.weights[source], dry, sent) / self.window).astype(np.int64) - 1
        b = np.clip(b, 0, self.rounds - 1)
        while True:
            off = (self._sent_of(source, b + 1) <= x).astype(np.int64) - (self._sent_of(source, b) > x)
            if not off.any():
                return b
            b = b + off

    def _ahead(self, source: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where in the stream a source's part of round ``b`` begins."""
        rounds, row = np.unique(b, return_inverse=True)
        order = np.argsort(row, kind="stable")
        out = np.empty(len(b), dtype=np.int64)
        step = max(1, CELLS // len(self.totals))
        for lo in range(0, len(rounds), step):
            here = order[slice(*np.searchsorted(row, [lo, lo + step], sorter=order))]
            before, after = self.sent(rounds[lo: lo + step]), self.sent(rounds[lo: lo + step] + 1)
            part = after - before
            ahead = np.cumsum(part, axis=1) - part
            out[here] = before.sum(axis=1)[row[here] - lo] + ahead[row[here] - lo, source[here]]
        return out

    def pieces(self, source: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where the runs start..start+n of sources' queues go, cut by rounds and sequences:
        (run, first token in the run, tokens, place in the stream, round)."""
        lowest = start // self.grain
        run, grain = spans_of((start + n - 1) // self.grain - lowest + 1)
        begin = (grain + lowest[run]) * self.grain
        b = self._round(source[run], np.maximum(begin, start[run]))
        head = np.ones(len(run), dtype=bool)                  # grains of a run that go in one round are one piece
        head[1:] = (run[1:] != run[:-1]) | (b[1:] != b[:-1])
        last = np.append(np.flatnonzero(head)[1:], len(run))[: int(head.sum())] - 1
        end = np.minimum(begin[last] + self.grain, (start + n)[run[last]])
        run, b, first = run[head], b[head], np.maximum(begin, start[run])[head]
        length = end - first
        place = self._ahead(source[run], b) + first - self._sent_of(source[run], b)
        first = first - start[run]
        cuts = (place + length - 1) // self.window - place // self.window
        of, i = spans_of(cuts + 1)
        begin = np.maximum(place[of], (place[of] // self.window + i) * self.window)
        end = np.minimum((place + length)[of], (place[of] // self.window + i + 1) * self.window)
        return run[of], first[of] + begin - place[of], end - begin, begin, b[of]


def tokenized(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, n, ids): the ids of each whole text with ``end_id`` behind, as little-endian 16-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with token_table(vocabulary) as tokens:
            for b in slices(batches, "text", 2 << 20):
                ids, counts = tokens.encode(b.column("text"), end_id)
                ends = np.concatenate([[0], np.cumsum(counts) * 2]).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u2"))])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(counts), blob],
                                                 names=["doc_id", "source", "n", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
                       F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, source string, n long, ids binary")


def with_queue(rows: DataFrame, targets: Mapping[str, float] | None, max_sources: int) -> tuple[DataFrame, dict[str, int], Mapping[str, float] | None]:
    """``rows`` with the ``queue`` of their source, and the queues' totals and targets (see the module's head)."""
    held = rows.groupBy("source").agg(F.sum("n").alias("held"))
    largest = held.orderBy(F.desc("held"), "source").limit(max_sources + 1).collect()
    if len(largest) <= max_sources:
        return rows.withColumn("queue", F.col("source")), {r["source"]: r["held"] for r in largest}, targets
    spark, own = rows.sparkSession, max_sources // 2
    alone = spark.createDataFrame([(r["source"], True) for r in largest[:own]], "source string, alone boolean")
    shared = F.concat(F.lit("\0shared "), F.pmod(F.xxhash64("source"), F.lit(max_sources - own)).cast("string"))

    def queued(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(alone), "source", "left").withColumn("queue", F.when(F.col("alone"), F.col("source")).otherwise(shared)).drop("alone")

    wanted = spark.createDataFrame([(k, float(v)) for k, v in (targets or {}).items()], "source string, target double")
    queues = queued(held).join(wanted, "source", "left").groupBy("queue").agg(F.sum("held").alias("held"), F.coalesce(F.sum("target"), F.lit(0.0)).alias("target")).collect()
    return queued(rows), {r["queue"]: r["held"] for r in queues}, targets and {r["queue"]: r["target"] for r in queues}


def pack(docs: DataFrame, vocabulary: str, window: int = 2048, grain: int = 128, end_id: int = 1,
         targets: Mapping[str, float] | None = None, max_sources: int = 10_000, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece (see PIECES); ``round`` is the round-robin round that sent it."""
    rows = stage(tokenized(docs, vocabulary, end_id, id_col, text_col, source_col)
                 .withColumn("rid", F.monotonically_increasing_id()))       # a written id: the same for every reader
    rows = rows.withColumn("part", F.shiftright("rid", 33))
    rows, totals, targets = with_queue(rows, targets, max_sources)
    plan = RoundRobin.of(totals, targets, window, grain)
    held = rows.groupBy("queue", "part").agg(F.sum("n").alias("held"))
    base = held.withColumn("before", F.sum("held").over(Window.partitionBy("queue").orderBy("part")) - F.col("held"))
    inside = Window.partitionBy("queue", "part").orderBy("rid")
    queued = (rows.withColumn("upto", F.sum("n").over(inside)).join(base.select("queue", "part", "before"), ["queue", "part"])
              .select("doc_id", "source", "queue", "n", "ids", (F.col("before") + F.col("upto") - F.col("n")).alias("start")))
    number = {n: i for i, n in enumerate(plan.names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", 1 << 20):
            n, start = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "start"))
            source = np.array([number[x] for x in batch.column("queue").to_pylist()])
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype="<u2").astype("<u4")
            run, at, length, place, b = plan.pieces(source, start, n)
            begin = (np.cumsum(n) - n)[run] + at
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * i: 4 * j]) for i, j in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(run)), pa.array(at), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[run]),
                 pa.array(place // window), pa.array(place % window), batch.column("source").take(pa.array(run)), pa.array(b)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "round"])

    return queued.mapInArrow(cut, PIECES)
