"""How often a key has occurred so far, and the moment it occurs for the n-th time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.scan import SPAN, Running, scan
from framewise.schemas import FRAME_ORDER, NTH_OCCURRENCE

KEYS = ("id", "emotion")


def occurrence_number(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = FRAME_ORDER,
    span: int | None = SPAN,
) -> DataFrame:
    """Adds ``occurrence``: 1 for a key's first row, cumulative and never reset."""
    return scan(df, keys, order, [Running("occurrence", F.lit(1), "sum")], span)


def nth_occurrence(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = FRAME_ORDER,
    n: int = NTH_OCCURRENCE,
    span: int | None = SPAN,
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
    mode: str = "append",
) -> DataFrame:
    """The row at which a key occurs for the n-th time: ``keys`` and ``order`` columns.

    A key that occurs less often gives nothing, one that occurs more often gives one
    row. On a stream, counts live in keyed state, which forgets a key ``ttl_ms`` after its last
    change, if that is given, and go on from those of the table ``history``, whose rows came before the
    stream. ``mode`` is the output mode of a query on the result: ``update`` where it is counted further.

    For a batch and a usual ``n`` the filter on ``row_number`` becomes a group limit
    ahead of the shuffle: a task passes on at most ``n`` rows of a key, so a key that
    fills the table costs ``n`` rows per task. Beyond the optimizer's limit for that,
    rows are counted in blocks. Both ways give the same rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = df.select(*keys, *order)
    if df.isStreaming:
        from framewise.streaming.occurrence import stream_nth_occurrence

        return stream_nth_occurrence(rows, keys, order, n, ttl_ms, history, mode)
    if history is not None:
        raise ValueError("history is for streams: stack tables instead")
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= limit:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        counted = rows.withColumn("occurrence", place)
    else:
        counted = occurrence_number(rows, keys, order, span)
    return counted.where(F.col("occurrence") == n).select(*keys, *order)
