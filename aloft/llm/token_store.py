"""Token-id files with keyed access (12): raw id payloads, and a minimal perfect hash index over the document keys.

A store is a folder:

    payload/<shard>.ids   the ids of its documents one after another, little-endian, 16 bits each (32 where the
                          vocabulary is larger); nothing else
    payload/<shard>.ends  for each document of the shard the number of ids up to its end (64-bit)
    index/<bucket>.mph    the keys of a bucket: arrays of the minimal perfect hash, fingerprints, and for each slot the
                          pieces (shard, first document in the shard, documents) that hold the key's documents
    shards/               a Parquet table: shard, docs, ids, first_doc, first_id (before it in the whole store)
    meta.json             width of an id, number of buckets

Shards follow each other in ascending order of the ids of the documents.  Access by key takes one look at the
key's bucket, one at the ends and one at the payload, however large the store is.

Documents are sorted by range (one shuffle of the texts) and each range's task tokenizes and writes its shards, a document at
a time in whole; a shard is closed when it holds ``shard_ids`` ids.  A file appears under its name when it
is whole, and a task run again writes the same bytes again.  The index gets one row per key and shard, bucket
by bucket, so no task holds more than a bucket.  Files are written and read by the tasks through Arrow's file systems
in the folder given, which all executors must see (``spark.checkpoint.dir`` for the query).

Odd input: a null or empty text is the end id alone; a null id is a key of its own, before all others; documents under one
id are ordered by a hash of the text, and all of them are found under the id; repeated rows are stored as often
as they come; an empty table gives a store without shards; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aloft.llm import mph
from aloft.llm.common import slices, spans_of
from aloft.llm.tokens import token_table, vocabulary_size
from aloft.sources.io import stage, write_table

MAGIC = b"ALOFTMPH"
ENTRY = "doc_id long, shard long, first long, n long"
FOUND = "doc_id long, shard long, place long, offset long, n_tokens long, ids_crc32 long"
ROLLS = 1 << 20                                        # shards that one task can write


class Folder:
    """Files below a folder in any file system that Arrow knows."""

    def __init__(self, path: str):
        scheme, colon, rest = path.partition(":")
        if colon and scheme == "file":                 # file:/a and file:///a are the same folder
            path = "file:///" + rest.lstrip("/")
        self.system, self.base = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def writer(self, name: str):
        """(stream, done): the file gets its name when ``done`` is called."""
        target = f"{self.base}/{name}"
        self.system.create_dir(target.rpartition("/")[0], recursive=True)
        context = TaskContext.get()
        draft = f"{target}.{context.taskAttemptId() if context else 0}.tmp"
        stream = self.system.open_output_stream(draft)

        def done() -> None:
            stream.close()
            self.system.move(draft, target)
        return stream, done

    def write(self, name: str, data: bytes) -> None:
        stream, done = self.writer(name)
        stream.write(data)
        done()

    def open(self, name: str):
        return self.system.open_input_file(f"{self.base}/{name}")

    def read(self, name: str) -> bytes:
        with self.open(name) as f:
            return f.read()


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one file: magic, length of the header, header (JSON), raw arrays."""
    header = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
    return MAGIC + len(header).to_bytes(8, "little") + header + b"".join(a.tobytes() for a in arrays.values())


def unpack_arrays(data: bytes) -> dict[str, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    at = 16 + int.from_bytes(data[8:16], "little")
    out = {}
    for name, (kind, n) in json.loads(data[16:at]).items():
        out[name] = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += out[name].nbytes
    return out


class ShardWriter:
    def __init__(self, folder: Folder, shard: int, width: int):
        self.folder, self.shard, self.width, self.docs, self.ids = folder, shard, width, 0, 0
        self.ends: list[np.ndarray] = []
        self.stream, self.done = folder.writer(f"payload/{shard:016x}.ids")

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.stream.write(ids.astype(f"<u{self.width}").tobytes())
        self.ends.append(self.ids + np.cumsum(counts))
        self.docs += len(counts)
        self.ids += len(ids)

    def close(self) -> None:
        self.done()
        self.folder.write(f"payload/{self.shard:016x}.ends", np.concatenate(self.ends).astype("<u8").tobytes())


def _write_shards(path: str, vocabulary: str, end_id: int, shard_ids: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, writer = Folder(path), None
        shard = TaskContext.get().partitionId() * ROLLS
        with token_table(vocabulary) as tokens:
            for b in slices(batches, "text", 2 << 20):
                ids, counts = tokens.encode(b.column("text"), end_id)
                ends = np.cumsum(counts)
                out_shard, out_first, lo = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64), 0
                while lo < len(counts):
                    if writer is None:
                        writer = ShardWriter(folder, shard, width)
                    before = ends[lo] - counts[lo]
                    hi = min(len(counts), int(np.searchsorted(ends, before + shard_ids - writer.ids)) + 1)
                    out_shard[lo:hi], out_first[lo:hi] = shard, writer.docs + np.arange(hi - lo)
                    writer.add(ids[before: ends[hi - 1]], counts[lo:hi])
                    if writer.ids >= shard_ids:
                        writer.close()
                        writer, shard = None, shard + 1
                    lo = hi
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out_shard), pa.array(out_first), pa.array(counts)],
                                                 names=["doc_id", "shard", "first", "n"])
            if writer is not None:
                writer.close()
    return run


def _build_index(path: str):
    def run(group: pa.Table) -> pa.Table:
        high, low = mph.split_keys(group.column("key").to_pylist())
        shard, first, docs = (group.column(c).to_numpy() for c in ("shard", "first", "docs"))
        order = np.lexsort((shard, low, high))                # a key's pieces side by side, in the order of the shards
        high, low, shard, first, docs = (a[order] for a in (high, low, shard, first, docs))
        head = np.ones(len(high), dtype=bool)
        head[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        begin = np.flatnonzero(head)
        table = mph.build(high[begin], low[begin])
        slot = mph.slots(table, high[begin], low[begin])
        n_pieces = np.diff(np.append(begin, len(high)))
        by_slot = np.argsort(slot)
        of, place = spans_of(n_pieces[by_slot])
        rows = begin[by_slot][of] + place
        table |= {"fingerprints": mph.fingerprint(high[begin], low[begin])[by_slot],
                  "starts": np.append(0, np.cumsum(n_pieces[by_slot])).astype("<u8"),
                  "shard": shard[rows].astype("<u8"), "first": first[rows].astype("<u8"), "docs": docs[rows].astype("<u8")}
        data = pack_arrays(table)
        bucket = group.column("bucket")[0].as_py()
        Folder(path).write(f"index/{bucket:016x}.mph", data)
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "keys": pa.array([len(begin)], pa.int64()),
                         "bytes": pa.array([len(data)], pa.int64())})
    return run


def _key(doc_id: str = "doc_id") -> Column:
    """128-bit identity of a document key; null is a key too."""
    return F.unhex(F.md5(F.coalesce(F.concat(F.lit("k"), F.col(doc_id).cast("string")), F.lit("n"))))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(buckets))


def write_store(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2, part_bytes: int = 128 << 20, shard_ids: int = 16 << 20,
                bucket_keys: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as a store in ``path`` (a new folder); returns the table of its shards."""
    spark = docs.sparkSession
    width = 2 if vocabulary_size(vocabulary) <= 1 << 16 and end_id < 1 << 16 else 4
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    # the last key parts rows that are alike, so a row that comes very often does not make one task
    d = d.withColumns({"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = [F.col(n).asc_nulls_first() for n in ("doc_id", "text_hash", "row")]
    placed = d.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    entries = stage(placed.mapInArrow(_write_shards(path, vocabulary, end_id, shard_ids, width), ENTRY))
    shards = entries.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)      # one row per shard
    shards = shards.select("shard", "docs", "ids", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(n) for c, n in (("docs", "first_doc"), ("ids", "first_id"))])
    write_table(shards, f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards")
    buckets = max(1, -(-(shards.agg(F.sum("docs")).first()[0] or 0) // bucket_keys))
    pieces = entries.groupBy("doc_id", "shard").agg(F.min("first").alias("first"), F.count("*").alias("docs"))
    pieces = pieces.withColumn("key", _key()).withColumn("bucket", _bucket(buckets))
    stage(pieces.drop("doc_id").groupBy("bucket").applyInArrow(_build_index(path), "bucket long, keys long, bytes long"))
    Folder(path).write("meta.json", json.dumps({"width": width, "buckets": buckets, "end_id": end_id}).encode())
    return shards


def _look_up(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, held, table = Folder(path), None, {}
        for b in batches:
            bucket = b.column("bucket").to_numpy()
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(bucket)) + 1), len(bucket))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                part = b.slice(lo, hi - lo)
                if not part.num_rows:
                    continue
                if bucket[lo] != held:
                    name = f"index/{bucket[lo]:016x}.mph"
                    there = folder.system.get_file_info(f"{folder.base}/{name}").type == fs.FileType.File
                    held, table = bucket[lo], unpack_arrays(folder.read(name)) if there else None
                if table is None:
                    continue                                   # a bucket without keys has no file
                high, low = mph.split_keys(part.column("key").to_pylist())
                slot = mph.slots(table, high, low)
                known = np.flatnonzero(slot >= 0)
                known = known[table["fingerprints"][slot[known]] == mph.fingerprint(high[known], low[known])]
                begin = table["starts"][slot[known]].astype(np.int64)
                of, place = spans_of(table["starts"][slot[known] + 1].astype(np.int64) - begin)
                rows = begin[of] + place
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(known[of])), *[pa.array(table[c][rows].astype(np.int64)) for c in ("shard", "first", "docs")]],
                    names=["doc_id", "shard", "first", "docs"])
    return run


def _read_payload(path: str, width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, held, payload, ends = Folder(path), None, None, np.zeros(0, np.int64)
        try:
            for b in batches:
                doc_id, shard, first, docs = (b.column(c) for c in ("doc_id", "shard", "first", "docs"))
                shard, first, docs = shard.to_numpy(), first.to_numpy(), docs.to_numpy()
                cuts = np.append(np.append(0, np.flatnonzero(np.diff(shard)) + 1), len(shard))
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    if lo == hi:
                        continue
                    if shard[lo] != held:
                        if payload is not None:
                            payload.close()
                        held = shard[lo]
                        ends = np.append(0, np.frombuffer(folder.read(f"payload/{held:016x}.ends"), dtype="<u8").astype(np.int64))
                        payload = folder.open(f"payload/{held:016x}.ids")
                    of, place = spans_of(docs[lo:hi])
                    at = first[lo:hi][of] + place
                    for cut in range(0, len(at), 4096):
                        rows = at[cut: cut + 4096]
                        out, crc = [], []
                        for a, z in zip(ends[rows].tolist(), ends[rows + 1].tolist(), strict=True):
                            ids = np.frombuffer(payload.read_at((z - a) * width, a * width), dtype=f"<u{width}").astype("<u4").tobytes()
                            crc.append(zlib.crc32(ids))
                            if with_ids:
                                out.append(ids)
                        yield pa.RecordBatch.from_arrays(
                            [doc_id.take(pa.array(lo + of[cut: cut + 4096])), pa.array(np.full(len(rows), held)), pa.array(rows), pa.array(ends[rows]),
                             pa.array(ends[rows + 1] - ends[rows]), pa.array(crc, pa.int64()), *([pa.array(out, pa.binary())] if with_ids else [])],
                            names=["doc_id", "shard", "place", "offset", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])
        finally:
            if payload is not None:
                payload.close()
    return run


def fetch(spark: SparkSession, path: str, keys: DataFrame, with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """The stored documents under the different ``keys``, read through the index: (doc_id, start, n_tokens, ids_crc32, shard, place),
    and their ids as little-endian 32-bit numbers if so wanted.  Keys that the store doesn't have give no row."""
    meta = json.loads(Folder(path).read("meta.json"))
    asked = keys.select(F.col(id_col).cast("long").alias("doc_id")).distinct().withColumn("key", _key()).withColumn("bucket", _bucket(meta["buckets"]))
    asked = asked.repartition("bucket").sortWithinPartitions("bucket")
    pieces = asked.mapInArrow(_look_up(path), "doc_id long, shard long, first long, docs long")
    pieces = pieces.repartition("shard").sortWithinPartitions("shard", "first")
    found = pieces.mapInArrow(_read_payload(path, meta["width"], with_ids), FOUND + (", ids binary" if with_ids else ""))
    base = spark.read.parquet(f"{path}/shards").select("shard", "first_id")
    return found.join(base, "shard").select("doc_id", (F.col("first_id") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "place",
                                            *(["ids"] if with_ids else []))
