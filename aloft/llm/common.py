"""Helpers shared by the operators of this package.

Conventions used throughout:

* a *word* is a maximal run of bytes other than space and 0x09-0x0D, unchanged;
* a null text is an empty text unless an operator says otherwise;
* operators read the columns they name and ignore all others, so extra
  columns with any name do no harm;
* repeated rows with the same id and text are told apart nowhere: each gets
  the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_id(text: str | Column = "text") -> Column:
    """128-bit identity of a text (16 bytes); a null text counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(c, F.lit(""))))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``max_bytes`` in each
    (a single longer text makes a slice of its own); bounds a task's memory."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield b.slice(lo, hi - lo)


class Words:
    """The words of a column of texts: ``index`` into ``vocabulary`` word by word,
    ``counts`` words per text, ``starts`` of each text's first word."""

    def __init__(self, texts: pa.Array):
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = parts.flatten()
        lens = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        enc = flat.dictionary_encode()
        index = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = enc.dictionary
        self.doc = np.repeat(np.arange(len(lens)), lens)
        blank = pc.index(self.vocabulary, "").as_py()        # what splitting leaves before, after and instead of words
        if blank >= 0:
            keep = index != blank
            index, self.doc = index[keep], self.doc[keep]
        self.index = index
        self.counts = np.bincount(self.doc, minlength=len(lens)).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        vocabulary = np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocabulary.to_pylist()), dtype=U64,
                                 count=len(self.vocabulary))
        return vocabulary[self.index]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the result."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_STEP = 0x9E3779B97F4A7C15  # any odd number
_BACK = pow(_STEP, -1, 1 << 64)


class Rolling:
    """Polynomial hashes (mod 2**64) of any run of a sequence of 64-bit values."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        power = np.full(n, _STEP, dtype=U64)
        power[:1] = 1
        power = np.cumprod(power, dtype=U64)
        back = np.full(n + 1, _BACK, dtype=U64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=U64)
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(x * power, dtype=U64)])

    def run(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start])


def spans_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths laid end to end: the run of each element and its place in the run."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return run, place


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, compressed as the byte planes of their differences (the planes of high and unused bits all but vanish)."""
    return pack(np.diff(keys, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=U64)


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """Documents as (doc_id, tid, text, chunk): chunks of about ``chunk_bytes`` of text, dealt by a
    hash of id and text.  One pass over the text counts its bytes."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    return d.select("doc_id", text_id().alias("tid"), "text", chunk_of(n).alias("chunk")), n


def chunk_of(n: int, doc_id: str = "doc_id", tid: Column | None = None) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), F.col(doc_id), text_id() if tid is None else tid), F.lit(n)).cast("int")
