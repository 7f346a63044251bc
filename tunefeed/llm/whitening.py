"""Whitened embeddings by polarisation covariance.

* An entry c becomes the integer x = floor(scale * c). Fitted is on each distinct x vector
  once: n vectors with per-dimension sums S.
* Centred, an entry is v = n * x - S, an integer too. Tasks add up the exact squares of v for
  every dimension i, and of v_i + v_j for every pair of dimensions: no product of two
  different dimensions is ever formed.
* Half the difference of those sums, (Q(i, j) - Q(i) - Q(j)) / 2, is the exact sum of
  v_i * v_j (polarisation); over n^3 it is the covariance, rounded once, to a double.
* ``eigh`` of that matrix, whose size is the number of dimensions, gives the components.

Sums are exact whatever their size: squares are taken in 64 bits of halves where v is large,
of Python integers where it is larger still, and cross the shuffle in digits of 40 bits.

Rows whose vector is null, or holds null or non-finite entries, are left out, as are vectors
of another length than most rows have (ties: the greater length) and vectors without entries.
x beyond 64 bits is the nearest 64-bit integer. Repeated vectors count once for the fit; each
row comes back. Rows with a null id come back with it. Components of no variance (eigenvalue
not above rounding) cannot be whitened and are left out; of one distinct vector, or an empty
table, nothing comes back. ``deviation`` is NULL beyond 38 digits. Only the named columns are
read, so others may have any name. Very long vectors are worked on in blocks of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.session import shared_path

SCALE = 256
COMPONENTS = 4
#: Rows whose squares are added up at once; with ``_SMALL`` and ``_HALVED`` sums fit in 62 bits.
BLOCK = 1024
_SMALL, _HALVED, _HALF = 1 << 26, 1 << 50, 24
_DIGIT = 40
_LARGEST = 10**38


def _top(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min())) if values.size else 0


def column_sums(values: np.ndarray) -> list[int]:
    """Exact sum of each column."""
    if values.dtype != object and _top(values) * max(values.shape[0], 1) >= 1 << 62:
        values = values.astype(object)
    return [int(s) for s in values.sum(axis=0)]


def square_sums(values: np.ndarray) -> list[int]:
    """Exact sum of the squares of each column."""
    total = [0] * values.shape[1]
    for i in range(0, values.shape[0], BLOCK):
        block = values[i : i + BLOCK]
        top = _top(block)
        if block.dtype == object or top >= _HALVED:
            sums = [int(s) for s in (block.astype(object) ** 2).sum(axis=0)]
        elif top < _SMALL:
            sums = (block * block).sum(axis=0).tolist()
        else:
            high, low = block >> _HALF, block & ((1 << _HALF) - 1)
            parts = [(p * q).sum(axis=0).tolist() for p, q in ((high, high), (high, low), (low, low))]
            sums = [(a << 2 * _HALF) + (b << (_HALF + 1)) + c for a, b, c in zip(*parts)]
        total = [a + b for a, b in zip(total, sums)]
    return total


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as 64-bit integers where they (and a sum of two of them) fit."""
    if _top(x) * n + max((abs(s) for s in sums), default=0) < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def polarised_sums(v: np.ndarray) -> list[int]:
    """Sums of squares of all v_i, then of v_i + v_j for i < j, pairs in order."""
    total = square_sums(v)
    for i in range(v.shape[1] - 1):
        total += square_sums(v[:, i : i + 1] + v[:, i + 1 :])
    return total


def covariance(sums: list[int], d: int, n: int) -> np.ndarray:
    """The matrix from the sums of squares; each entry is rounded once."""
    out = np.zeros((d, d))
    pairs = iter(sums[d:])
    for i in range(d):
        out[i, i] = sums[i] / n**3
        for j in range(i + 1, d):
            out[i, j] = out[j, i] = (next(pairs) - sums[i] - sums[j]) / (2 * n**3)
    return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    for i in range(0, len(column), BLOCK):
        yield _matrix(column.slice(i, BLOCK), d)


def _digits(sums: list[int]) -> Iterator[tuple[int, int, int]]:
    """(cell, digit, value): a sum in base 2^40, of one sign."""
    for cell, total in enumerate(sums):
        sign, rest, k = (1, total, 0) if total >= 0 else (-1, -total, 0)
        while rest:
            yield cell, k, sign * (rest & ((1 << _DIGIT) - 1))
            rest, k = rest >> _DIGIT, k + 1


def _exact_sums(fit: DataFrame, of: callable, cells: int) -> list[int]:
    """Sums of ``of(block)`` over all rows. The driver gets one number per cell and digit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * cells
        for batch in batches:
            for block in of(batch.column(0)):
                total = [a + b for a, b in zip(total, block)]
        rows = list(zip(*_digits(total)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["cell", "digit", "value"])

    parts = fit.mapInArrow(run, "cell long, digit long, value long")
    # Each value is under 2^40, so a sum over 8 million tasks fits.
    out = [0] * cells
    for r in parts.groupBy("cell", "digit").agg(F.sum("value").alias("value")).collect():
        out[r.cell] += r.value << (_DIGIT * r.digit)
    return out


def integer_vector(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))


def whiten(
    df: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """Per row and component (from 1, by falling eigenvalue): ``key``, component, n, deviation
    (sum over dimensions of v^2, exact), whitened, explained and identity_error.

    ``whitened`` is (x - S/n) on the unit eigenvector, over the root of its eigenvalue;
    ``identity_error`` is measured on all fitted vectors.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n long, deviation decimal(38,0), "
        "whitened double, explained double, identity_error double"
    )
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    rows = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(key).alias("key"), integer_vector(F.col(vector), scale).alias("x")
    )
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    d = length.d
    rows = rows.filter(F.size("x") == d)
    path = shared_path(spark, "fit")
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)

    n = fit.count()
    sums = _exact_sums(fit, lambda c: (column_sums(x) for x in _blocks(c, d)), d)
    squares = _exact_sums(
        fit, lambda c: (polarised_sums(centred(x, n, sums)) for x in _blocks(c, d)), d * (d + 1) // 2
    )
    matrix = covariance(squares, d, n)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > max(values[-1], 0.0) * d * np.finfo(float).eps]
    if not order.size:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    basis = vectors[:, order] / np.sqrt(values[order])
    explained = (values[order] / np.trace(matrix)).tolist()
    error = _identity_error(fit, d, n, sums, basis)
    k = int(order.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                v = centred(_matrix(part.column(1), d), n, sums)
                exact = [Decimal(s) if s < _LARGEST else None for s in square_sums(v.T)]
                again = pa.array(np.repeat(np.arange(part.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(again),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                        pa.array(np.full(part.num_rows * k, n, np.int64)),
                        pa.array(exact, pa.decimal128(38, 0)).take(again),
                        pa.array(_projected(v, n, basis).ravel()),
                        pa.array(explained * part.num_rows, pa.float64()),
                        pa.array(np.full(part.num_rows * k, error)),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def _projected(v: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    # Of Python integers, the quotient is rounded once.
    return (v / n).astype(np.float64) @ basis


def _identity_error(fit: DataFrame, d: int, n: int, sums: list[int], basis: np.ndarray) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for x in _blocks(batch.column(0), d):
                z = _projected(centred(x, n, sums), n, basis)
                first += z.sum(axis=0)
                second += z.T @ z
        cells = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells.size)), pa.array(cells)], ["cell", "value"])

    total = np.zeros(k + k * k)
    for r in fit.mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        total[r.cell] = r.value
    mean = total[:k] / n
    return float(np.abs(total[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
