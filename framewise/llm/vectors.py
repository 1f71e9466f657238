"""Integer vectors from columns of embeddings, and comparing a query set with all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.settings import write_through

#: A block of vectors is at most so many bytes as 64-bit numbers, which bounds a task's memory.
BLOCK_BYTES = 16 << 20
#: Tables are cut into a block for each core, but blocks are not made smaller than this for it.
LEAST_ROWS = 256

#: Integer vectors must be shorter than this, so that products of two fit in 64 bits.
LONGEST = 1 << 31


def usable(vector: Column) -> Column:
    """Whether an array of numbers is there and all of its entries are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(False))


def integers(vector: Column, scale: int, offset: int = 0) -> Column:
    """Each entry x becomes floor(scale * x) + offset, x as double; an error beyond 2^61."""
    too_large = F.raise_error(F.lit("an entry of a vector is too large for a 64-bit integer")).cast("long")

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * F.lit(float(scale))
        return F.when(F.abs(scaled) < float(1 << 61), F.floor(scaled) + F.lit(offset).cast("long")).otherwise(too_large)

    return F.transform(vector, whole)


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int, *more: Column) -> DataFrame:
    """key (long), ``more``, x (integer vector), length. Rows without a key or with unusable vectors are left out.

    A vector that is too long for products in 64 bits stops the query when it is read.
    """
    picked = df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("_v"), *more)
    picked = picked.where(F.col("key").isNotNull() & usable(F.col("_v")))
    length = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    rows = picked.withColumn("_x", integers(F.col("_v"), scale)).withColumn("length", length)
    long = F.raise_error(F.concat(F.lit("the vector of row "), F.col("key"), F.lit(" is too long for exact products")))
    return rows.withColumn("x", F.when(F.col("length") < LONGEST, F.col("_x")).otherwise(long)).drop("_v", "_x")


def in_blocks(df: DataFrame, name: str, count: Callable[[DataFrame, int], DataFrame]) -> tuple[DataFrame, int]:
    """``df`` with ``block``, written to the shared folder, and the number of blocks.

    ``count`` deals the rows to that many partitions, and a partition becomes a block. Since the table is
    written, blocks stay as they are when tasks are repeated.
    """
    rows, dims = df.agg(F.count("*"), F.max(F.size("x"))).first()
    if not rows:
        return write_through(df.withColumn("block", F.lit(0)), name), 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    most = max(1, BLOCK_BYTES // (8 * max(dims, 1)))
    blocks = max(ceil(rows / most), min(2 * cores, ceil(rows / LEAST_ROWS)))
    written = write_through(count(df, blocks).withColumn("block", F.spark_partition_id()), name)
    # A session may deal to other numbers of partitions than it was asked for.
    return written, written.agg(F.max("block")).first()[0] + 1


def cells(
    queries: DataFrame,
    rows: DataFrame,
    query_blocks: int,
    visited: Column,
    compare: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``compare(queries, rows)`` for each block of queries and those blocks of rows that it visits.

    Both tables have ``block``; ``visited`` is an array of blocks of rows, computed from a query's row. A query
    goes once to each block that it visits and a row once to each block of queries, never to each other's rows.
    """
    left = queries.withColumn("query_block", F.col("block")).withColumn("block", F.explode(visited))
    each = F.explode(F.sequence(F.lit(0), F.lit(max(query_blocks, 1) - 1)))
    right = rows.withColumn("query_block", each)
    by = ("query_block", "block")
    # Both sides may come from the same tables: new names for their columns keep them apart.
    sides = [side.select(*[F.col(c).alias(c) for c in side.columns]).groupBy(*by) for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(compare, schema)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(flat), -1)


def by_dimensions(left: pa.Table, right: pa.Table) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The two tables cut into parts whose vectors have the same number of entries."""
    sizes = [np.array(t.column("x").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)) for t in (left, right)]
    for d in np.intersect1d(*sizes):
        yield tuple(t if (s == d).all() else t.filter(pa.array(s == d)) for t, s in zip((left, right), sizes))


def smallest_type(reach: float) -> type:
    """The type in which products are exact: doubles below 2^53, where they are fast, else 64-bit integers."""
    return np.float64 if reach < 2.0**52 else np.int64


def best_columns(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest entries of each row and their columns, of equal ones the first; ``scores`` is used up.

    Entries that are the smallest value of their type stand for nothing: so do what is found beyond the others.
    """
    none = least(scores.dtype)
    found, places = [], []
    at = np.arange(len(scores))
    for _ in range(min(count, scores.shape[1])):
        place = scores.argmax(axis=1)
        found.append(scores[at, place])
        places.append(place)
        scores[at, place] = none
    if not found:
        return np.empty((len(scores), 0), scores.dtype), np.empty((len(scores), 0), np.int64)
    return np.stack(found, axis=1), np.stack(places, axis=1)


def least(kind: np.dtype):
    """What stands for no score."""
    return -np.inf if np.issubdtype(kind, np.floating) else np.iinfo(kind).min
