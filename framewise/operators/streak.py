"""How long conditions have held without a break, per key.

Each condition has its own counter: +1 on a row where it holds, back to 0 elsewhere.
Rows are cut into blocks as in ``scan``. A block's counters only depend on earlier rows
until the condition first fails in it, so a block passes on three small numbers per
condition and the rows need no second shuffle: the join that brings a block's start
values uses the partitioning and the order that the window left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.functions.predicates import full_hand, happy
from framewise.operators.scan import SPAN, block_of, key_columns, restored_key
from framewise.schemas import FRAME_ORDER, STREAK_OVER

KEYS = ("id",)


def wave_conditions() -> dict[str, Column]:
    """The two conditions of a wave on decoded people."""
    return {"happy": happy(F.col("emotion")), "full_hand": full_hand(F.col("fingers"))}


def _flags(conditions: Mapping[str, Column]) -> list[Column]:
    return [F.coalesce(c, F.lit(False)).alias(f"_ok_{name}") for name, c in conditions.items()]


def _in_blocks(df, keys, order, conditions, span) -> DataFrame:
    """Rows with place ``_rn`` in the block and place ``_bad_*`` of the latest failure."""
    block = F.lit(0).cast("long") if span is None else block_of(order[0], span)
    solid, keys = key_columns(df, keys)
    rows = df.select(*solid, *order, block.alias("_block"), *_flags(conditions))
    window = Window.partitionBy(*keys, "_block").orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_rn", F.row_number().over(window))
    return placed.select(
        *keys,
        "_block",
        *order,
        "_rn",
        *[F.max(F.when(~F.col(f"_ok_{c}"), F.col("_rn"))).over(so_far).alias(f"_bad_{c}") for c in conditions],
    )


def _starts(placed: DataFrame, keys, conditions) -> DataFrame:
    """Per block, the counters at its beginning; blocks that start at zero are left out.

    As no key column can be null, nothing is filtered here that ``placed`` itself keeps, so
    Spark finds that both need the same shuffle and does it once.
    """
    ends = placed.groupBy(*keys, "_block").agg(
        F.max("_rn").cast("long").alias("_n"), *[F.max(f"_bad_{c}").alias(f"_bad_{c}") for c in conditions]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = ends.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    carried = {
        c: F.col("_offset") - F.coalesce(F.max(F.col("_offset") + F.col(f"_bad_{c}")).over(before), F.lit(0))
        for c in conditions
    }
    starts = offset.select(*keys, "_block", *[v.alias(f"_start_{c}") for c, v in carried.items()])
    return starts.where(F.greatest(F.lit(0), *[F.col(f"_start_{c}") for c in conditions]) > 0)


def _with_starts(rows: DataFrame, placed: DataFrame, keys, conditions, span) -> DataFrame:
    if span is None:
        return rows.select("*", *[F.lit(0).alias(f"_start_{c}") for c in conditions])
    return rows.join(_starts(placed, keys, conditions), [*keys, "_block"], "left")


def _length(name: str) -> Column:
    bad = F.col(f"_bad_{name}")
    start = F.coalesce(f"_start_{name}", F.lit(0))
    return F.when(bad.isNull(), start + F.col("_rn")).otherwise(F.col("_rn") - bad).cast("long")


def streak_lengths(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = FRAME_ORDER,
    conditions: Mapping[str, Column] | None = None,
    span: int | None = SPAN,
) -> DataFrame:
    """``keys``, ``order`` and one counter column per condition, for every row."""
    conditions = wave_conditions() if conditions is None else conditions
    placed = _in_blocks(df, keys, order, conditions, span)
    solid = key_columns(df, keys)[1]
    rows = _with_starts(placed, placed, solid, conditions, span)
    restored = [restored_key(solid, k) for k in keys]
    return rows.select(*restored, *order, *[_length(c).alias(c) for c in conditions])


def joint_streak(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = FRAME_ORDER,
    conditions: Mapping[str, Column] | None = None,
    over: int = STREAK_OVER,
    span: int | None = SPAN,
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Every row at which all counters are larger than ``over``: ``keys`` and ``order``.

    A run that goes on gives a row each time. On a stream, counters live in keyed state, which
    forgets a key ``ttl_ms`` after its last change, if that is given, and go on from the end of the table ``history``,
    whose rows came before the stream.
    """
    conditions = wave_conditions() if conditions is None else conditions
    if df.isStreaming:
        from framewise.streaming.streak import stream_joint_streak

        return stream_joint_streak(df, keys, order, conditions, over, ttl_ms=ttl_ms, history=history)
    if history is not None:
        raise ValueError("history is for streams: stack tables instead")
    placed = _in_blocks(df, keys, order, conditions, span)
    # Rows that no start value could lift above the threshold need not be joined.
    possible = reduce(
        and_, [F.col(f"_bad_{c}").isNull() | (F.col("_rn") - F.col(f"_bad_{c}") > over) for c in conditions]
    )
    solid = key_columns(df, keys)[1]
    rows = _with_starts(placed.where(possible), placed, solid, conditions, span)
    held = reduce(and_, [_length(c) > over for c in conditions])
    return rows.where(held).select(*[restored_key(solid, k) for k in keys], *order)
