"""Late label results, merged into the rows of the tracks they are about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions.labels import DEFAULT_LABEL, NOT_A_FACE
from framewise.operators.scan import SPAN, Running, scan

TRACK = ("camera_id", "track_id")


def label_asof(
    tracks: DataFrame,
    results: DataFrame,
    keys: Sequence[str] = TRACK,
    span: int | None = SPAN,
) -> DataFrame:
    """``tracks`` with ``label``: the latest result up to the row's frame, else ``neutral``.

    ``results`` has ``keys``, ``frame`` and ``label``; a null label is a failed analysis
    and changes nothing. A result counts from its own frame on. After ``not_face`` the
    track is gone, so its rows from that frame on are left out.

    This is an as-of join without a range join: both sides are stacked and one running
    value is taken over them, so each side is shuffled once.
    """
    rows = tracks.withColumn("_kind", F.lit(1))
    late = results.select(*keys, "frame", F.col("label").alias("_label"), F.lit(0).alias("_kind"))
    both = rows.unionByName(late, allowMissingColumns=True)
    running = [
        Running("_latest", F.col("_label"), "last"),
        Running("_gone", (F.col("_label") == NOT_A_FACE).cast("int"), "max"),
    ]
    # Several results of one frame are taken in label order, to be repeatable.
    merged = scan(both, keys, ["frame", "_kind", "_label"], running, span)
    alive = merged.where((F.col("_kind") == 1) & (F.coalesce("_gone", F.lit(0)) == 0))
    return alive.withColumn("label", F.coalesce("_latest", F.lit(DEFAULT_LABEL))).drop("_kind", "_label", "_latest", "_gone")
