"""Hard negatives by Kronecker-packed products: one multiplication gives the products with several rows.

Components of rows are biased so that none is negative, and those of several rows are put into separate fields of one
64-bit integer. An anchor's biased component times such an integer is its product with each field at once, and the
sums over components stay inside their fields, since fields are as wide as the longest vectors of a block need. The
scores are unpacked by shifts and masks, and what the biases added is taken off again.

Anchors meet rows in blocks, twice: for the best rows of the anchor's label, and, once their scores are known, for
the best rows of other labels whose scores lie in each positive's band.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.vectors import best_columns, by_dimensions, cells, in_blocks, integer_vectors, least, matrix
from framewise.settings import write_through

_WORD = 64
#: Scores held at a time, of some anchors with all rows of a block.
_SCORES_AT_ONCE = 1 << 21
_NONE = least(np.dtype(np.int64))


class PackedRows:
    """Integer vectors packed for products with ``anchors``, of as many components."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.n, dims = rows.shape
        # Differences of 64-bit integers are right as unsigned ones.
        self.row_bias = -rows.min(initial=0)
        self.anchor_bias = -anchors.min(initial=0)
        biased = (rows + self.row_bias).astype(np.uint64)
        length = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0)
        # No product of biased vectors, nor any sum on the way to it, is larger.
        largest = length(biased) * length(anchors + self.anchor_bias) * (1 + 1e-9) + 1
        self.width = min(_WORD, int(largest).bit_length())
        self.fields = _WORD // self.width
        words = -(-self.n // self.fields)
        self.packed = np.zeros((dims, words), np.uint64)
        for field in range(self.fields):
            part = biased[field * words : (field + 1) * words]
            self.packed[:, : len(part)] |= part.T << np.uint64(field * self.width)
        self.row_sums = rows.sum(axis=1)

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """The exact inner product of each anchor with each row."""
        dims = anchors.shape[1]
        sums = (anchors + self.anchor_bias).astype(np.uint64) @ self.packed
        mask = np.uint64((1 << self.width) - 1)
        parts = [(sums >> np.uint64(field * self.width)) & mask for field in range(self.fields)]
        scores = np.hstack(parts)[:, : self.n].view(np.int64)
        # (a + p)(c + q) = ac + q a + p c + pq, summed over the components. With one field, sums may
        # pass 64 bits; they and what is taken off then wrap alike, and the score itself fits.
        with np.errstate(over="ignore"):
            added = (self.row_bias * anchors.sum(axis=1))[:, None] + self.anchor_bias * self.row_sums
            return scores - added - dims * self.anchor_bias * self.row_bias


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False)


def _meetings(mine: pa.Table, theirs: pa.Table):
    """For some anchors at a time: their rows, all rows (by key), and their scores."""
    for left, right in by_dimensions(mine, theirs):
        right = right.sort_by("key")
        packed = PackedRows(matrix(left.column("x")), matrix(right.column("x")))
        step = max(1, _SCORES_AT_ONCE // len(right))
        for start in range(0, len(left), step):
            part = left.slice(start, step)
            yield part, right, packed.products(matrix(part.column("x")))


def _best(mine: pa.Table, theirs: pa.Table, k: int) -> pa.Table:
    """The ``k`` best rows of each anchor's label: anchor_id, place, key, score."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    for left, right, scores in _meetings(mine, theirs):
        anchors, keys = _column(left, "key"), _column(right, "key")
        other = _column(left, "label")[:, None] != _column(right, "label")[None, :]
        scores[other | (anchors[:, None] == keys[None, :])] = _NONE
        best, place = best_columns(scores, k)
        there = best != _NONE
        copies = np.broadcast_to(_column(left, "copy")[:, None], there.shape)
        for column, values in zip(out, (np.broadcast_to(anchors[:, None], there.shape), copies, keys[place], best)):
            column.append(values[there])
    return _as_table(out, ("anchor_id", "copy", "key", "score"))


def _in_bands(mine: pa.Table, theirs: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The ``k`` best rows of other labels in the band of each positive: anchor_id, copy, positive, key, score."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for left, right, scores in _meetings(mine, theirs):
        anchors, keys, copies = _column(left, "key"), _column(right, "key"), _column(left, "copy")
        alike = _column(left, "label")[:, None] == _column(right, "label")[None, :]
        scores[alike | (anchors[:, None] == keys[None, :])] = _NONE
        positives = left.column("positives").to_pylist()
        for turn in range(max(map(len, positives), default=0)):
            at = np.array([i for i, p in enumerate(positives) if len(p) > turn])
            bands = [band(positives[i][turn], low, high) for i in at]
            bottom, top = (np.array(b, np.int64)[:, None] for b in zip(*bands))
            part = scores[at]
            part[(part < bottom) | (part > top)] = _NONE
            best, place = best_columns(part, k)
            there = best != _NONE
            wide = lambda values: np.broadcast_to(values[:, None], there.shape)  # noqa: E731, B023
            number = np.full(len(at), turn)
            for column, values in zip(out, (wide(anchors[at]), wide(copies[at]), wide(number), keys[place], best)):
                column.append(values[there])
    return _as_table(out, ("anchor_id", "copy", "positive", "key", "score"))


def band(score: int, low: int, high: int) -> tuple[int, int]:
    """The smallest and largest whole score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def _as_table(columns: list[list[np.ndarray]], names: tuple[str, ...]) -> pa.Table:
    return pa.table({n: np.concatenate(c) if c else np.empty(0, np.int64) for n, c in zip(names, columns)})


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Vectors are taken as integers, floor(``scale`` * x), and scores are exact inner products with the anchor; higher ones
    come first, equal ones by smaller key. Anchors are the rows for which ``anchors`` holds. An anchor's positives are its
    first ``positives`` other rows of the same label (all, if fewer); a positive's negatives the first ``negatives`` rows of
    other labels whose scores are between ``low`` and ``high`` per cent of the positive's (all, if fewer; with a positive
    below zero there are none). A positive without negatives gives no rows.

    Rows without a key or label, and vectors that are null or hold null, NaN or infinite entries take no part. Vectors with
    different numbers of entries are not compared; empty ones have score 0 with each other. Rows with the anchor's key are
    its own, neither positives nor negatives; apart from that, a repeated row counts as often as it is there, and a repeated
    anchor gives its rows as often. Vectors of 2^31 or longer, as integers, stop the query with an error. Other columns,
    whatever they are called, are not looked at. An empty table gives an empty table.
    """
    chosen = F.coalesce(anchors, F.lit(False)).alias("asked")
    labelled = integer_vectors(df, key, vector, scale, label.cast("long").alias("label"), chosen).where(F.col("label").isNotNull())
    rows, blocks = in_blocks(labelled, "negative-rows", lambda d, n: d.repartition(n))
    # Rows of one anchor's key are told apart by ``copy``.
    own = rows.where("asked").drop("block").withColumn("copy", F.monotonically_increasing_id())
    asked, asked_blocks = in_blocks(own, "negative-anchors", lambda d, n: d.repartition(n))
    rows = rows.select("key", "label", "x", "block")
    everywhere = F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "key")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    alike = cells(
        asked, rows, asked_blocks, everywhere,
        lambda mine, theirs: _best(mine, theirs, positives),
        "anchor_id long, copy long, key long, score long",
    )
    alike = write_through(first(alike, ["anchor_id", "copy"], positives), "positives")

    scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"])
    scored = alike.groupBy("copy").agg(scores.alias("positives"))
    banded = cells(
        asked.join(scored, "copy"), rows, asked_blocks, everywhere,
        lambda mine, theirs: _in_bands(mine, theirs, negatives, low, high),
        "anchor_id long, copy long, positive long, key long, score long",
    )
    mined = first(banded, ["anchor_id", "copy", "positive"], negatives).select(
        "copy", (F.col("positive") + 1).alias("_place"), "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = alike.select("anchor_id", "copy", F.col("rank").alias("_place"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(named, ["copy", "_place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
