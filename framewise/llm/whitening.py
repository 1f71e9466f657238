"""Whitening of embeddings: principal components by Jacobi-Davidson over distributed, centred products.

The covariance is never made. Its product with a block of vectors is one pass over the distinct integer vectors, kept as
a table in the shared folder: each task centres its rows exactly (n * x - S in integers) and sums its part of
X'(X B); parts are added in groups ahead of the driver, which holds only blocks of as many rows as vectors have entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.columns import pack_row, without
from framewise.llm.jacobi_davidson import EPS, Eigenpairs, largest_eigenpairs
from framewise.llm.vectors import integers, matrix, usable
from framewise.settings import write_through

#: n times an integer entry must be smaller than this, to be exact in 64 bits.
LARGEST = 1 << 62
_RESULTS = ("deviation", "whitened")


@dataclass(frozen=True)
class Whitening:
    """``sums`` are those of the ``n`` fitted integer vectors. Columns of ``vectors`` are unit eigenvectors of their covariance,
    ``values`` the eigenvalues, ``explained`` their parts of the trace. ``identity_error`` is the largest absolute
    entry of the whitened vectors' covariance minus the identity."""

    n: int
    scale: int
    offset: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    pairs: Eigenpairs


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n with one rounding: what is divided is exact."""
    return (n * x - sums) / n


def deviation(n: int, sums: np.ndarray, x: str = "x") -> Column:
    """The sum of (n * x - S)^2 over the entries, exact, with as many decimal digits as it needs."""
    apart = F.transform(x, lambda entry, at: (entry * n - F.element_at(F.lit(sums.tolist()), at + 1)).cast("decimal(19,0)"))
    return F.aggregate(apart, F.lit(0).cast("decimal(38,0)"), lambda total, a: (total + a * a).cast("decimal(38,0)"))


def _used(df: DataFrame, vector: str, scale: int, offset: int) -> DataFrame:
    """Rows with a usable vector, all columns as ``_row``, its integers as ``x``."""
    rows = df.select(pack_row(df))
    there = F.col(f"_row.{vector}")
    return rows.where(usable(there) & (F.size(there) > 0)).withColumn("x", integers(there, scale, offset))


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of the matrices in ``parts`` (one row per task, column ``m``), in groups of about the root of their number."""
    groups = max(1, ceil(sqrt(parts.sparkSession.sparkContext.defaultParallelism)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for m in batch.column("m"):
                part = np.frombuffer(m.as_buffer(), np.float64)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.record_batch({"m": pa.array([total.tobytes()], pa.binary())})

    return sum(np.frombuffer(r.m, np.float64) for r in parts.repartition(groups).mapInArrow(add, "m binary").collect())


def _summed(fitted: DataFrame, part, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all fitted vectors of ``part(x)``, a matrix for some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(matrix(batch.column("x")))
        yield pa.record_batch({"m": pa.array([total.tobytes()], pa.binary())})

    return _added(fitted.mapInArrow(run, "m binary")).reshape(shape)


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 16, scale: int = 64, offset: int = 1_000_000) -> Whitening | None:
    """The whitening of the distinct integer vectors floor(``scale`` * c) + ``offset``; None if there is no vector.

    Vectors that are null, empty or hold null, NaN or infinite entries are left out. Copies count once, however many there
    are. Components whose eigenvalue is zero, to rounding, are left out, as nothing can be divided by its root: copies of one
    vector have no component at all. Vectors with different numbers of entries, and entries of 2^62 / n or more, are errors.
    """
    fitted = write_through(_used(df, vector, scale, offset).select("x").dropDuplicates(["x"]), "fit-list")
    size = F.size("x")
    reach = F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x"))))
    n, least, dims, largest = fitted.agg(F.count("*"), F.min(size), F.max(size), reach).first()
    if not n:
        return None
    if least != dims:
        raise ValueError(f"vectors have from {least} to {dims} entries")
    if largest >= LARGEST // n:
        raise ValueError(f"entries up to {largest} are too large for exact sums of {n} vectors")

    entries = fitted.select(F.posexplode("x").alias("at", "entry")).groupBy("at").agg(F.sum("entry").alias("total"))
    sums = np.array([r.total for r in entries.orderBy("at").collect()], np.int64)

    trace = int(fitted.agg(F.sum(deviation(n, sums))).first()[0]) / n**3

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ block)

        return _summed(fitted, part, block.shape) / n

    pairs = largest_eigenpairs(product, dims, components)
    there = pairs.values > dims * EPS * max(pairs.values[0], 0.0) * 64
    values, vectors = pairs.values[there], pairs.vectors[:, there]
    k = len(values)
    if not k:
        return Whitening(n, scale, offset, sums, values, vectors, values, 0.0, pairs)

    def moments(x: np.ndarray) -> np.ndarray:
        w = (centred(x, n, sums) @ vectors) / np.sqrt(values)
        return np.vstack([w.sum(axis=0), w.T @ w])

    found = _summed(fitted, moments, (k + 1, k)) / n
    error = np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max()
    return Whitening(n, scale, offset, sums, values, vectors, values / trace, float(error), pairs)


def whiten(df: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """``df`` with ``deviation`` (decimal, exact: the sum of (n * x - S)^2) and ``whitened`` (array of doubles, one for each component).

    Rows whose vector is null, empty or holds null, NaN or infinite entries are left out; all other rows stay, also
    repeated ones and those with nulls elsewhere. Input columns with the names of the two results are replaced. Without
    a model (no vector to fit), there are no rows either.
    """
    if model is None:
        return without(df, *_RESULTS).limit(0).withColumns({"deviation": F.lit(0).cast("decimal(38,0)"), "whitened": F.array().cast("array<double>")})
    n, sums, vectors, roots = model.n, model.sums, model.vectors, np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x")) if batch.num_rows else np.empty((0, len(sums)), np.int64)
            w = (centred(x, n, sums) @ vectors) / roots
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(roots))
            lists = pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1), pa.float64()))
            columns = [batch.column("_row"), batch.column("deviation"), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", *_RESULTS])

    rows = _used(df, vector, model.scale, model.offset).withColumn("deviation", deviation(n, sums))
    schema = T.StructType([rows.schema["_row"], rows.schema["deviation"], T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    done = rows.mapInArrow(run, schema)
    kept = without(df, *_RESULTS).columns
    return done.select(*[F.col(f"_row.`{c}`") for c in kept], *_RESULTS)
