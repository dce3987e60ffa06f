"""Counts of keys over all chunks of a corpus, given back to the chunks.

A chunk of documents sends its different 64-bit keys with their counts, cut by
the keys' high bits into buckets; a bucket adds up the counts of all chunks and
tells each chunk the totals of its keys.  Keys travel as packed arrays (see
``pack_keys``), so the JVM moves a few rows per chunk and not one per word.
No task sees more than its share of the keys, whatever their frequencies.

Keys may be cut to their high ``key_bits``: as many as keep the share of keys that meet
another one by chance under about a millionth at the corpus's size, and no more to be moved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aloft.llm.common import pack, pack_keys, unpack, unpack_keys

REQUEST = "bucket int, chunk int, keys binary, counts binary"
REPLY = "chunk int, bucket int, answered binary, totals binary, stats array<long>"


def key_bits(total_bytes: int) -> int:
    """Bits of key for a corpus of that many bytes: more of them the larger it is."""
    return min(64, max(1, total_bytes).bit_length() + 20)


def _buckets(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end): the runs of sorted ``keys`` that go to each bucket."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    used, first = np.unique(bucket, return_index=True)
    return list(zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=False))


def requests(chunk: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A chunk's sorted different ``keys`` with their ``counts`` (one column or several, 32 bits) as request rows."""
    counts = (counts if counts.ndim > 1 else counts[:, None]).astype("<u4")
    rows = _buckets(keys, buckets)
    return pa.RecordBatch.from_arrays([
        pa.array([k for k, _, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int32()),
        pa.array([pack_keys(keys[a:b]) for _, a, b in rows], pa.binary()),
        pa.array([pack(counts[a:b].T.tobytes()) for _, a, b in rows], pa.binary())], names=["bucket", "chunk", "keys", "counts"])


def totals(sent: DataFrame, reply, flag: int = 0, skip: int | None = None) -> DataFrame:
    """Adds up each bucket.  ``reply(own, all)`` says which keys of a chunk are answered, given its own counts and the
    totals of all chunks (arrays: keys x columns).  An extra row with chunk -1 has ``stats``: how many different keys have
    the bit ``flag``, and the sum of their counts by column (the key ``skip`` left out)."""
    def run(t: pa.Table) -> pa.Table:
        chunks = t.column("chunk").to_pylist()
        keys = [unpack_keys(k) for k in t.column("keys").to_pylist()]
        counts = [np.frombuffer(unpack(c), dtype="<u4").reshape(-1, len(k)).T for c, k in zip(t.column("counts").to_pylist(), keys, strict=True)]
        every, index = np.unique(np.concatenate(keys), return_inverse=True)
        stacked = np.concatenate(counts)
        summed = np.column_stack([np.bincount(index, weights=stacked[:, c], minlength=len(every)) for c in range(stacked.shape[1])]).astype(np.int64)
        out, at = [], 0
        for chunk, k, c in zip(chunks, keys, counts, strict=True):
            whole = summed[index[at: at + len(k)]]
            at += len(k)
            use = reply(c, whole)
            if use.any():
                out.append((chunk, pack(np.packbits(use).tobytes()), pack(np.ascontiguousarray(whole[use].T.astype("<i8")).view(np.uint8).reshape(-1, 8).T.tobytes()), None))
        flagged = every & np.uint64(flag) != 0
        if skip is not None:
            flagged &= every != np.uint64(skip)
        out.append((-1, b"", b"", [int(flagged.sum()), *summed[flagged].sum(axis=0).tolist()]))
        bucket = t.column("bucket")[0].as_py()
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([bucket] * len(out), pa.int32()),
                                     pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary()),
                                     pa.array([o[3] for o in out], pa.list_(pa.int64()))], names=["chunk", "bucket", "answered", "totals", "stats"])

    return sent.groupBy("bucket").applyInArrow(run, REPLY)


def answered(t: pa.Table, keys: np.ndarray, buckets: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The places in a chunk's sorted ``keys`` that were answered, and their totals.  The chunk knows what it asked for, so
    an answer is a bit per key and the totals of those set."""
    span = {k: (a, b) for k, a, b in _buckets(keys, buckets)}
    at, got = [np.zeros(0, np.int64)], [np.zeros((0, width), np.int64)]
    for bucket, mask, c in zip(*(t.column(n).to_pylist() for n in ("bucket", "answered", "totals")), strict=True):
        a, b = span[bucket]
        at.append(a + np.flatnonzero(np.unpackbits(np.frombuffer(unpack(mask), dtype=np.uint8), count=b - a)))
        got.append(np.ascontiguousarray(np.frombuffer(unpack(c), dtype=np.uint8).reshape(8, -1).T).view("<i8").reshape(width, -1).T)
    return np.concatenate(at), np.concatenate(got)
