"""Exact top-k search by inner product: rows in buckets of like length, pruned by local cosine thresholds.

Rows are dealt to blocks by falling length. A bounded number of the longest gives each query a score that its
k-th best row reaches at least. Divided by the query's and a block's largest length, that is the cosine a row
of the block must reach: where it is above 1, the query does not visit the block at all. Inside a block the same
holds for its buckets, whose thresholds rise as better rows are found. In a bucket that is visited, a query looks
for candidates by

* coordinates, if the cosine threshold leaves so narrow an interval of one of the query's strongest coordinates that
  few rows are in it (directions within an angle of the query's lie within that angle of each axis), or else
* length: all rows of the bucket that are long enough.

Products of candidates are then exact, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.vectors import best_columns, by_dimensions, cells, in_blocks, integer_vectors, least, matrix, smallest_type

#: Rows of a bucket, within which lengths are taken to be alike.
BUCKET = 1024
#: Of the longest rows, so many give the first thresholds (a bounded table: this many vectors go to every task).
FIRST_ROWS = 1024
#: Coordinates of a query that are tried, the strongest first.
FOCUS = 3
#: Looking up one row by coordinates takes as long as multiplying so many in a matrix.
LOOKUP_COST = 16
#: Angles and lengths are compared with so much tolerance; products decide.
SLACK = 1e-9

_QUERIES_AT_ONCE = 1024
NOTHING = np.iinfo(np.int64).min


class Bucket:
    """Rows of like length, in order of their keys."""

    def __init__(self, keys: np.ndarray, x: np.ndarray, lengths: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.x, self.lengths = keys[order], x[order], lengths[order]
        self.longest = float(lengths.max())
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinate ``f`` of the rows' directions in rising order, and the rows in that order."""
        if f not in self._sorted:
            values = self.x[:, f] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(values, kind="stable")
            self._sorted[f] = values[order], order
        return self._sorted[f]

    def narrowest(self, directions: np.ndarray, focus: np.ndarray, cosines: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each direction the number of rows that may have this cosine to it, by the best of its ``focus``
        coordinates, with that coordinate and where its interval begins there."""
        angles = np.arccos(np.minimum(cosines, 1.0)) + SLACK**0.5
        count = np.full(len(cosines), len(self.keys) + 1)
        chosen, begin = np.zeros(len(cosines), np.int64), np.zeros(len(cosines), np.int64)
        for column in focus.T:
            for f in np.unique(column):
                at = np.flatnonzero(column == f)
                own = np.arccos(np.clip(directions[at, f], -1, 1))
                low = np.cos(np.minimum(np.pi, own + angles[at])) - SLACK
                high = np.cos(np.maximum(0.0, own - angles[at])) + SLACK
                values, _ = self.coordinate(int(f))
                first, last = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
                better = last - first < count[at]
                count[at[better]] = (last - first)[better]
                chosen[at[better]], begin[at[better]] = f, first[better]
        return count, chosen, begin


class Search:
    """The best ``k`` rows of some queries; ``floors`` are scores that the k-th best is known to reach.

    ``counts`` has the numbers of products that were taken by coordinates and by length.
    """

    def __init__(self, keys: np.ndarray, x: np.ndarray, floors: np.ndarray, k: int):
        self.keys, self.x, self.k = keys, x, k
        self.lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.directions = x / np.maximum(self.lengths, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.directions), axis=1, kind="stable")[:, :FOCUS]
        self.floors = floors.copy()
        self.scores = np.full((len(keys), k), NOTHING)
        self.found = np.zeros((len(keys), k), np.int64)
        self.counts = {"coordinate": 0, "length": 0}

    def _keep(self, at: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Merge further rows of the queries ``at`` into their best; equal scores go by key."""
        scores, keys = np.hstack([self.scores[at], scores]), np.hstack([self.found[at], keys])
        # Not the negative: of the smallest number there is none.
        order = np.lexsort((keys, ~scores), axis=1)[:, : self.k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.found[at] = np.take_along_axis(keys, order, 1)
        self.floors[at] = np.maximum(self.floors[at], self.scores[at][:, -1])

    def visit(self, bucket: Bucket) -> None:
        reach = self.lengths * bucket.longest
        live = np.flatnonzero((self.floors == NOTHING) | (self.floors <= reach * (1 + SLACK)))
        if not len(live):
            return
        rows = bucket.x.astype(smallest_type(float(reach[live].max())))
        # The cosine that a row of this bucket must reach; without a positive floor there is none.
        bound = live[self.floors[live] > 0]
        count, chosen, begin = bucket.narrowest(self.directions[bound], self.focus[bound], self.floors[bound] / reach[bound])
        few = count * LOOKUP_COST <= len(bucket.keys)
        for i, n, f, first in zip(bound[few], count[few], chosen[few], begin[few]):
            self._by_coordinate(bucket, rows, i, np.sort(bucket.coordinate(f)[1][first : first + n]))
        rest = np.setdiff1d(live, bound[few], assume_unique=True)
        for start in range(0, len(rest), _QUERIES_AT_ONCE):
            self._by_length(bucket, rows, rest[start : start + _QUERIES_AT_ONCE])

    def _by_coordinate(self, bucket: Bucket, rows: np.ndarray, i: int, near: np.ndarray) -> None:
        self.counts["coordinate"] += len(near)
        near = near[bucket.keys[near] != self.keys[i]]
        scores = (rows[near] @ self.x[i].astype(rows.dtype)).astype(np.int64)
        enough = scores >= self.floors[i]
        if enough.any():
            self._keep(np.array([i]), scores[enough][None, :], bucket.keys[near][enough][None, :])

    def _by_length(self, bucket: Bucket, rows: np.ndarray, at: np.ndarray) -> None:
        wanted = np.where(self.floors[at] > 0, self.floors[at] / np.maximum(self.lengths[at], 1e-300), 0.0)
        long = bucket.lengths >= wanted.min() * (1 - SLACK)
        keys, rows = (bucket.keys, rows) if long.all() else (bucket.keys[long], rows[long])
        if not len(keys):
            return
        self.counts["length"] += len(at) * len(keys)
        scores = self.x[at].astype(rows.dtype) @ rows.T
        none = least(scores.dtype)
        scores[self.keys[at][:, None] == keys[None, :]] = none
        best, place = best_columns(scores, self.k)
        there = best != none
        kept = np.full(best.shape, NOTHING)
        kept[there] = best[there].astype(np.int64)
        self._keep(at, kept, keys[place])


def search_rows(search: Search, keys: np.ndarray, x: np.ndarray, bucket: int = BUCKET) -> Search:
    """Visits the rows in buckets of falling length."""
    lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((keys, -lengths))
    for start in range(0, len(order), bucket):
        part = order[start : start + bucket]
        search.visit(Bucket(keys[part], x[part], lengths[part]))
    return search


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False)


def top_products(
    df: DataFrame,
    queries: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), ``key``, score: the ``k`` rows with the largest inner product for each query.

    Vectors are taken as integers, floor(``scale`` * x) of each entry as double, and products are exact. Queries
    are the rows of ``df`` for which ``queries`` holds; candidates all other rows. Equal scores go by smaller key.
    A query with fewer than ``k`` candidates gets all of them, one without any no row.

    Rows without a key, and vectors that are null or hold null, NaN or infinite entries take no part. Vectors with
    different numbers of entries are not compared; empty ones have score 0 with each other. Rows with the query's
    key are its own and no candidates; apart from that, a repeated row counts as often as it is there. A query
    that comes with the same key and vector again is asked once, with other vectors once for each of them,
    and their candidates are ranked together. Vectors of 2^31 or longer, as integers, stop the query with an error.
    Other columns, whatever they are called, are not looked at. An empty table gives an empty table.
    """
    asked = F.coalesce(queries, F.lit(False)).alias("asked")
    vectors = integer_vectors(df, key, vector, scale, asked)
    # The last key deals also rows that are alike in everything.
    by_length = lambda d, n: d.repartitionByRange(n, F.col("length").desc(), "key", F.monotonically_increasing_id())
    rows, blocks = in_blocks(vectors, "search-rows", by_length)
    own = rows.where("asked").drop("block").dropDuplicates(["key", "x"])
    questions, question_blocks = in_blocks(own, "search-queries", lambda d, n: d.repartition(n))

    # One number for each block, of which there is one for 16 MB of vectors.
    longest = np.zeros(max(blocks, 1))
    for block, length in rows.groupBy("block").agg(F.max("length")).collect():
        longest[block] = length
    # What is in later blocks is no longer, whatever rounding does to block borders.
    longest = np.maximum.accumulate(longest[::-1])[::-1]
    first = rows.where(F.col("block") < 1).orderBy(F.col("length").desc(), "key").limit(FIRST_ROWS).select("key", "x").toArrow()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds each query's floor and the number of blocks that it visits."""
        for batch in batches:
            floors = np.full(batch.num_rows, NOTHING)
            table = pa.Table.from_batches([batch]).append_column("_row", pa.array(np.arange(batch.num_rows)))
            for mine, theirs in by_dimensions(table, first):
                part = Search(_ints(mine, "key"), matrix(mine.column("x")), np.full(len(mine), NOTHING), k)
                floors[_ints(mine, "_row")] = search_rows(part, _ints(theirs, "key"), matrix(theirs.column("x"))).floors
            reach = table.column("length").to_numpy()[:, None] * longest[None, :]
            visits = ((floors == NOTHING)[:, None] | (floors[:, None] <= reach * (1 + SLACK))).sum(axis=1)
            more = [pa.array(floors, pa.int64()), pa.array(visits.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "floor", "visits"])

    schema = T.StructType([*questions.schema.fields, T.StructField("floor", T.LongType()), T.StructField("visits", T.IntegerType())])
    begun = questions.mapInArrow(begin, schema)

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if not (len(mine) and len(theirs)):
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "key", "score")})
        for left, right in by_dimensions(mine, theirs):
            search = Search(_ints(left, "key"), matrix(left.column("x")), _ints(left, "floor"), k)
            search_rows(search, _ints(right, "key"), matrix(right.column("x")))
            there = (search.scores != NOTHING) & (search.scores >= search.floors[:, None])
            query = np.broadcast_to(search.keys[:, None], there.shape)
            for column, values in zip(out, (query, search.found, search.scores)):
                column.append(values[there])
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        return pa.table(dict(zip(("query_id", "key", "score"), columns)))

    visited = F.sequence(F.lit(0), F.greatest("visits", F.lit(1)) - 1)
    found = cells(begun, rows.drop("asked"), question_blocks, visited, compare, "query_id long, key long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "key")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("key").alias(key), "score")
