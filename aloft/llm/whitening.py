"""Embedding whitening (11): components by QDWH divide and conquer, whitening by a broadcast matrix.

An entry c, as double, becomes the integer x = floor(scale * c) + offset.  The covariance V
of all x-vectors that take part (divisor n) is exact before it is rounded to double: one pass adds up
counts and sums as integers; a second one takes the nearest integer mean off, multiplies what is left and adds the products
up as integers; the rest of the mean (at most half a unit) is taken out in integer arithmetic on the driver.
So an offset, however large, costs no digits, and the result is the same for any layout of the rows.

``spectral.eigenvectors`` splits V's spectrum by projectors from polar decompositions.  The driver holds d x d
numbers for vectors of d components; nothing there grows with the rows.  The
whitening matrix (d x ``components``) goes to the tasks, and a last pass adds up the covariance of the whitened rows,
centred, before the rows are returned.

Odd input: vectors that are null, or hold a null or non-finite entry, take no part; shorter vectors (empty ones too) are
as if padded with zero entries; repeated rows count as often as they come; a null id is kept; entries beyond 2**40 / scale
count as that; components without variance (up to rounding) have no unit vector to whiten and are left out, so equal
vectors and an empty table give an empty result; a deviation that no long can hold is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.spectral import EPS, eigenvectors

OFFSET = 1_000_000
CLIP = float(1 << 40)
_LOW = 40
SUMS = "i int, j int, hi long, lo long"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def remaining(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): the rows that take part, with their integers without the offset."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), c * scale))).cast("long"))
    return v.where(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))).select("vec_id", whole.alias("x"))


def _integers(batch: pa.RecordBatch, width: int = 0) -> np.ndarray:
    """The vectors of a batch as rows, padded with zeros."""
    rows = batch.column(batch.schema.get_field_index("x"))
    size = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), dtype=np.int64)
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = rows.flatten().to_numpy(zero_copy_only=False)
    return out


def gram(z: np.ndarray) -> np.ndarray:
    """The exact products z.T @ z of integers (up to 2**41) as Python integers: float products of blocks so small that no digit is lost."""
    high = int(np.abs(z).max(initial=0))
    total = np.zeros((z.shape[1], z.shape[1]), dtype=object)
    if high < 1 << 20:
        step = max(1, (1 << 52) // max(1, high * high))
        for lo in range(0, len(z), step):
            part = z[lo: lo + step].astype(float)
            total += (part.T @ part).astype(np.int64)
        return total
    top, low = z >> 20, z & ((1 << 20) - 1)                    # |top| <= 2**21: products below 2**43
    for lo in range(0, len(z), 256):
        a, b = top[lo: lo + 256].astype(float), low[lo: lo + 256].astype(float)
        cross = a.T @ b
        total += (((a.T @ a).astype(np.int64).astype(object) << 40) + ((cross + cross.T).astype(np.int64).astype(object) << 20)
                  + (b.T @ b).astype(np.int64))
    return total


def _rows(i: np.ndarray, j: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """Integers of any size as two longs each."""
    value = value.astype(object)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array((value >> _LOW).astype(np.int64)),
                                       pa.array((value & ((1 << _LOW) - 1)).astype(np.int64))], names=["i", "j", "hi", "lo"])


def _added(sums: DataFrame) -> dict[tuple[int, int], int]:
    """The totals by (i, j): one row for each, in number bounded by the vectors' length."""
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("hi", "lo")]
    return {(r["i"], r["j"]): (int(r["hi"]) << _LOW) + int(r["lo"]) for r in sums.groupBy("i", "j").agg(*wide).collect()}


def _first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums = 0, np.zeros(0, dtype=object)
    for b in batches:
        x = _integers(b)
        n += len(x)
        if x.shape[1] > len(sums):
            sums = np.append(sums, np.zeros(x.shape[1] - len(sums), dtype=object))
        sums[: x.shape[1]] += x.sum(axis=0)                     # at most 2**40 times a batch's rows: no overflow
    if n:
        j = np.arange(-1, len(sums))
        yield _rows(np.full(len(j), -1), j, np.append(np.array([n], dtype=object), sums))


def _second_sums(middle: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(middle)
        total, seen = np.zeros((d, d), dtype=object), False
        for b in batches:
            total, seen = total + gram(_integers(b, d) - middle), True
        if seen and d:
            i, j = np.triu_indices(d)
            yield _rows(i, j, total[i, j])
    return run


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    components: np.ndarray          # as columns
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n*x - S in integers (Python's where longs are too short), and x - S/n as doubles."""
        sums = np.array(self.sums, dtype=object)
        reach = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        moved = x * self.n - sums.astype(np.int64) if reach < 1 << 62 else x.astype(object) * self.n - sums
        return moved, (moved / self.n).astype(float)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.components / np.sqrt(self.values))

    @staticmethod
    def deviation(moved: np.ndarray) -> list[int | None]:
        """The sum of squares of each row, exact; None where no long can hold it."""
        high = int(max(moved.max(initial=0), -moved.min(initial=0)))
        if moved.dtype != object and high * high * max(1, moved.shape[1]) < 1 << 62:
            return np.einsum("ij,ij->i", moved, moved).tolist()
        squares = [sum(v * v for v in row) for row in moved.tolist()]
        return [s if s < 1 << 63 else None for s in squares]


def covariance(n: int, sums: list[int], middle: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """V, rounded once: products are of x - middle."""
    left = [s - n * m for s, m in zip(sums, middle, strict=True)]
    v = np.zeros((len(sums), len(sums)))
    for (i, j), p in products.items():
        v[i, j] = v[j, i] = (n * p - left[i] * left[j]) / (n * n)
    return v


def fit(rows: DataFrame, components: int = 32, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all rows that take part; None if none does."""
    fit_list = remaining(rows, scale, id_col, vector_col)
    first = _added(fit_list.select("x").mapInArrow(_first_sums, SUMS))
    if not first:
        return None
    n = first[(-1, -1)]
    sums = [first[(-1, j)] for j in range(len(first) - 1)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    products = _added(fit_list.select("x").mapInArrow(_second_sums(np.array(middle, dtype=np.int64)), SUMS))
    v = covariance(n, sums, middle, products)
    values, vectors = eigenvectors(v)
    keep = int((values > len(sums) * EPS * values.max(initial=0)).sum())
    keep = min(keep, components)
    return Whitening(n, tuple(sums), vectors[:, :keep], values[:keep], float(np.trace(v)))


def identity_error(rows: DataFrame, model: Whitening, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured on all of them."""
    k = len(model.values)
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = model.whiten(model.centred(_integers(b, d))[1])
            m, own = len(w), w.mean(axis=0)
            step = own - mean                                   # two centred parts make one (Chan)
            spread += (w - own).T @ (w - own) + np.outer(step, step) * (n * m / (n + m))
            n, mean = n + m, mean + step * (m / (n + m))
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, np.full(k, -1)), pa.int32()), pa.array(np.append(j, np.arange(k)), pa.int32()),
                 pa.array(np.append((spread + n * np.outer(mean, mean))[i, j], n * mean))], names=["i", "j", "value"])

    parts = remaining(rows, scale, id_col, vector_col).select("x").mapInArrow(run, "i int, j int, value double")
    got = {(r["i"], r["j"]): r["value"] for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    # each task's products are centred on its own mean; the means differ by rounding and sampling only, and meet here
    mean = np.array([got[(-1, j)] for j in range(k)]) / model.n
    return max(abs(v / model.n - mean[i] * mean[j] - (i == j)) for (i, j), v in got.items() if i >= 0)


def whitened(rows: DataFrame, components: int = 32, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row that takes part and component (see RESULT), components numbered from 1 by falling eigenvalue."""
    model = fit(rows, components, scale, id_col, vector_col)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], RESULT)
    error = identity_error(rows, model, scale, id_col, vector_col)
    k, d = len(model.values), len(model.sums)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                b = batch.slice(lo, 2048)
                m = b.num_rows
                moved, centred = model.centred(_integers(b, d))
                of = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(of), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n)),
                     pa.array(model.deviation(moved), pa.int64()).take(of), pa.array(model.whiten(centred).ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return remaining(rows, scale, id_col, vector_col).mapInArrow(run, RESULT)
