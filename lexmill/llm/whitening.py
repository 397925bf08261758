"""Whitening of embeddings: principal components by pairwise merged moments.

Every entry is put on a grid, x = floor(scale * c) + offset, so that sums and
squared deviations are integers and exact in any order. A task reduces its rows
to count, sums, local mean and centred scatter; two such results merge by Chan's
formula, in a tree over the tasks; one matrix reaches the driver, which takes its
eigenvectors. A second pass projects all rows and merges the moments of the
projections in the same way: their covariance is held against the identity.

Defined cases: null vectors, vectors with a null or non-finite entry, and entries
from 2**40 up, which the grid can't hold, are left out; so are vectors of another
length than the most frequent one (of equally frequent ones the longest). Rows
that repeat count as often as they are there. Components without variance, beyond
rounding, are not returned: constant vectors, a single one, or none give no row.
Of equal eigenvalues any orthogonal directions are taken, the same for all rows.
Ids may be null and of any type; other columns are not looked at. A deviation
beyond 38 digits is null. The driver holds one matrix of length times length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries of this size and more are left out: scaled by up to 4,096 they stay whole numbers of a double.
HUGE = float(1 << 40)
#: Partial results that meet in one task of the tree.
FAN_IN = 8


@dataclass(frozen=True)
class Moments:
    """Count, exact sums (of whole entries), mean and centred scatter of some rows."""

    n: int
    total: tuple[int, ...]
    mean: np.ndarray
    scatter: np.ndarray


def moments(x: np.ndarray) -> Moments:
    """Of the rows of a matrix; sums are exact for whole numbers only."""
    y = x.astype(np.float64)
    # the mean about the first row, so that a common offset costs no digits
    mean = y[0] + (y - y[0]).mean(axis=0)
    centred = y - mean
    total = tuple(int(s) for s in x.sum(axis=0)) if x.dtype.kind == "i" else ()
    return Moments(len(x), total, mean, centred.T @ centred)


def merged(a: Moments | None, b: Moments | None) -> Moments | None:
    """Moments of both sets of rows, by Chan's formula."""
    if a is None or b is None:
        return a or b
    n = a.n + b.n
    apart = b.mean - a.mean
    return Moments(n, tuple(p + q for p, q in zip(a.total, b.total, strict=True)), a.mean + apart * (b.n / n), a.scatter + b.scatter + np.outer(apart, apart) * (a.n * (b.n / n)))


@dataclass(frozen=True)
class Grid:
    """Whole numbers for entries."""

    scale: float = 1024.0
    offset: int = 100_000

    def whole(self, entries: np.ndarray) -> np.ndarray:
        return np.floor(self.scale * entries.astype(np.float64)).astype(np.int64) + self.offset


@dataclass(frozen=True)
class Whitening:
    """Fitted components: what every task needs to project its rows."""

    n: int
    total: tuple[int, ...]
    mean: np.ndarray
    directions: np.ndarray  # a column per component
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over entries of (n * x - total)**2, in whole numbers."""
        widest = max(abs(self.n * int(v) - t) for side in (x.max(axis=0), x.min(axis=0)) for v, t in zip(side, self.total, strict=True))
        kind = np.int64 if widest * widest * x.shape[1] < 1 << 62 and max(map(abs, self.total)) + widest < 1 << 62 else object
        y = self.n * x.astype(kind) - np.array(self.total, dtype=kind)
        return [int(v) for v in (y * y).sum(axis=1)]


def fitted(found: Moments, components: int) -> Whitening | None:
    """The leading components; None if nothing varies."""
    covariance = found.scatter / found.n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    order = np.argsort(-values, kind="stable")[:components]
    kept = order[values[order] > len(values) * np.finfo(float).eps * max(values.max(), 0.0)]
    if not len(kept):
        return None
    directions = directions[:, kept]
    largest = np.abs(directions).argmax(axis=0)
    directions = directions * np.sign(directions[largest, range(len(kept))])
    mean = np.array([s / found.n for s in found.total])  # from exact sums
    return Whitening(found.n, found.total, mean, directions, values[kept], trace)


def usable(vector: Column) -> Column:
    """Whether every entry is there, finite and within the grid."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < HUGE))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


_PARTIAL = "n long, total array<string>, mean array<double>, scatter array<double>"


def reduced(vectors: DataFrame, length: int, prepare) -> Moments | None:
    """Moments of prepare(entries) over all rows of the one column: a partial result per task, merged in a tree; None without rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if len(batch):
                found = merged(found, moments(prepare(_matrix(batch.column(0), length))))
        if found is not None:
            columns = [pa.array([found.n]), pa.array([[str(s) for s in found.total]], pa.list_(pa.string())), pa.array([found.mean.tolist()]), pa.array([found.scatter.ravel().tolist()])]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "total", "mean", "scatter"])

    def read(row) -> Moments:
        return Moments(row["n"], tuple(map(int, row["total"])), np.array(row["mean"]), np.array(row["scatter"]).reshape(len(row["mean"]), -1))

    parts = vectors.mapInArrow(partial, _PARTIAL).rdd.map(read)
    depth = max(2, math.ceil(math.log(max(2, parts.getNumPartitions()), FAN_IN)))
    return parts.treeAggregate(None, merged, merged, depth)


def whiten(vectors: DataFrame, components: int = 8, grid: Grid | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per usable vector and component.

    component counts from 1 by falling variance; n is the number of vectors;
    deviation the exact squared distance from the mean, times n squared, on the
    grid; whitened the coordinate in units of its deviation; explained the
    component's share of the variance; identity_error the largest entry by which
    the covariance of all coordinates differs from the identity.
    """
    grid = grid or Grid()
    fields = [T.StructField(id_col, vectors.schema[id_col].dataType)]
    fields += [T.StructField(name, kind) for name, kind in (("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)))]
    fields += [T.StructField(name, T.DoubleType()) for name in ("whitened", "explained", "identity_error")]
    schema = T.StructType(fields)
    rows = vectors.select(F.col(id_col), F.col(vector_col).alias("vector")).filter(usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    frequent = lengths.filter("length > 0").first()
    found = None
    if frequent is not None:
        length = frequent["length"]
        rows = rows.filter(F.size("vector") == length)
        found = reduced(rows.select("vector"), length, grid.whole)
    model = fitted(found, components) if found is not None else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    spread = reduced(rows.select("vector"), length, lambda entries: model.project(grid.whole(entries)))
    error = float(np.abs(spread.scatter / spread.n - np.eye(len(model.values))).max())
    many = len(model.values)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = grid.whole(_matrix(batch.column(1), length))
            each = np.repeat(np.arange(len(x)), many)
            far = [Decimal(d) if d < 10**38 else None for d in model.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n)),
                    pa.array(far, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(projected, schema)
