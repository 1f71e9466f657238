"""Grouped counts. Spark combines before the shuffle, so a frequent value costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def emotion_counts(events: DataFrame) -> DataFrame:
    """Events per emotion; null is a group. On a stream, write it in update mode."""
    return events.groupBy("emotion").agg(F.count("*").alias("cnt"))


def people_per_frame(people: DataFrame, frames: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Number of people in each frame; 0 for those that only ``frames`` lists."""
    keys = [*by, "frame"]
    rows = people.select(*keys, F.lit(1).alias("one"))
    if frames is not None:
        rows = rows.unionByName(frames.select(*keys, F.lit(0).alias("one")))
    return rows.groupBy(*keys).agg(F.sum("one").alias("n_people"))
