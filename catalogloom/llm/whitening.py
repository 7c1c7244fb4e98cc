"""Embedding whitening from the singular values of centred rows.

Entries go to an integer grid, so sums are exact and equal vectors are one row
of the fit list. Blocks of centred rows are reduced to triangular factors by QR
in every task, the factors by QR again in groups, up to one matrix of
``d * d`` numbers; no covariance is formed. ``bidiagonal`` finds its singular
values and right vectors: the whitening directions. Tasks hand on a factor or
sums of that size, whatever the number of rows; only the last ones reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogloom.llm.bidiagonal import decompose
from catalogloom.llm.shared import kept

#: Grid of the entries: floor(SCALE * entry) + OFFSET. Entries from LARGEST on have no place on it.
SCALE, OFFSET, LARGEST = 64, 1_000_000, float(1 << 34)
#: Factors merged by one task.
MERGED = 16

_NEW = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def gridded(df: DataFrame, vector: str, carry: Sequence[str]) -> DataFrame:
    """``_x`` (grid vector) and ``_1`` ... (carry) of the rows whose vector has only finite entries."""
    entry = F.transform(df[vector], lambda c: c.cast("double"))
    rows = df.select(entry.alias("_v"), *[df[c].alias(f"_{i + 1}") for i, c in enumerate(carry)])
    fits = F.size("_v") > 0
    fits &= F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    grid = F.transform("_v", lambda c: F.floor(c * SCALE) + OFFSET)
    return rows.where(F.coalesce(fits, F.lit(False))).select(grid.alias("_x"), *[f"_{i + 1}" for i in range(len(carry))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each dimension."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for batch in batches:
            n, total = n + batch.num_rows, total + _matrix(batch.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width)), pa.array(np.append(n, total))], names=["dim", "total"])
    rows = fit.mapInArrow(run, "dim long, total long").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    found = np.zeros(width + 1, np.int64)
    for r in rows:
        found[r.dim + 1] = r.total
    return int(found[0]), found[1:]


def _factor(fit: DataFrame, width: int, n: int, total: np.ndarray) -> np.ndarray:
    """A triangular matrix with the same inner products as the centred rows."""
    def reduced(blocks: Iterable[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, width))
        for block in blocks:
            r = np.linalg.qr(np.concatenate([r, block]), mode="r")
        return r

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = reduced((n * _matrix(b.column(0), width) - total) / n for b in batches if b.num_rows)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([r.tobytes()])],
                                             names=["part", "r"])

    def merge(table: pa.Table) -> pa.Table:
        r = reduced(np.frombuffer(x, float).reshape(-1, width) for x in table["r"].to_pylist())
        return pa.table({"part": table["part"][:1], "r": pa.array([r.tobytes()])})
    parts = kept(fit.mapInArrow(run, "part long, r binary"), "factors")
    groups = int(parts.agg(F.max("part")).first()[0]) + 1
    while groups > 1:
        groups = -(-groups // MERGED)
        parts = parts.withColumn("part", F.pmod("part", F.lit(groups))).groupBy("part").applyInArrow(merge, "part long, r binary")
    whole = np.frombuffer(parts.first().r, float).reshape(-1, width)
    return np.concatenate([whole, np.zeros((width - len(whole), width))])


def _identity_error(fit: DataFrame, width: int, n: int, total: np.ndarray, directions: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance beside the identity."""
    size = directions.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((size + 1, size))
        for b in batches:
            z = (n * _matrix(b.column(0), width) - total) / n @ directions
            products += np.concatenate([z.T @ z, z.sum(axis=0, keepdims=True)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(products.size)), pa.array(products.ravel())], names=["place", "total"])
    found = np.zeros((size + 1) * size)
    for r in fit.mapInArrow(run, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
        found[r.place] = r.total
    products = found.reshape(size + 1, size) / n
    return float(np.abs(products[:-1] - np.outer(products[-1], products[-1]) - np.eye(size)).max())


def whiten(df: DataFrame, vector: str = "embedding", carry: Sequence[str] | None = None, components: int = 16) -> DataFrame:
    """Whitened coordinates of each vector, one row for each of the first ``components``.

    The fit list is each distinct grid vector once. New columns: ``component``
    (from 1, by falling variance), ``n`` (fit list), ``deviation`` (sum of
    ``(n * x - sum) ** 2``; null beyond a long), ``whitened``, ``explained`` (share of
    the total variance) and ``identity_error``. ``carry`` names the columns to
    keep (all but the vector when None); a kept column of a new name is
    replaced. Rows whose vector is null, empty or holds a null, a number that
    is not finite or one from ``LARGEST`` on have no place, and neither have
    rows of another length than the commonest (the longer one on ties).
    Directions without variance are left out, so equal or single vectors give
    no rows, and nor does an empty table. Repeated rows stay separate rows.
    """
    new = T._parse_datatype_string(_NEW)
    stay = [c for c in (df.columns if carry is None else carry) if c not in new.names and (carry is not None or c != vector)]
    rows = gridded(df, vector, stay)
    names = [f"_{i + 1}" for i in range(len(stay))]
    schema = T.StructType([rows.schema[c] for c in names] + list(new.fields))
    lengths = rows.groupBy(F.size("_x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    nothing = df.sparkSession.createDataFrame([], schema)
    if lengths is None:
        return nothing.toDF(*stay, *new.names)
    width = lengths.width
    rows = rows.where(F.size("_x") == width)
    fit = kept(rows.select("_x").distinct(), "fit")
    n, total = _sums(fit, width)
    squared, vectors = decompose(_factor(fit, width, n, total))
    size = min(components, int((squared > 0).sum()))
    if not size:
        return nothing.toDF(*stay, *new.names)
    explained = squared[:size] / squared.sum()
    directions = vectors[:, :size] / np.sqrt(squared[:size] / n)
    error = _identity_error(fit, width, n, total, directions)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = n * _matrix(batch.column(0), width) - total
            m = len(scaled)
            large = np.square(scaled.astype(float)).sum(axis=1) > 9.2e18
            deviation = pa.array(np.square(scaled).sum(axis=1), mask=large)
            every = pa.array(np.repeat(np.arange(m), size))
            yield pa.RecordBatch.from_arrays([
                *[batch.column(i + 1).take(every) for i in range(len(names))],
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)), pa.array(np.full(m * size, n)),
                deviation.take(every), pa.array((scaled / n @ directions).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * size, error))], names=names + new.names)
    return rows.mapInArrow(run, schema).toDF(*stay, *new.names)
