"""Which detected boxes the tracker gets to see."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions.geometry import box_area, clip_box

BOX = ("x", "y", "w", "h")
DETECTION = ("camera_id", "frame", "det_ord")


def visible_detections(detections: DataFrame, width: int, height: int) -> DataFrame:
    """Drops boxes of which nothing lies inside the frame; the others stay as they are."""
    inside = clip_box(*[F.col(c) for c in BOX], width, height)
    return detections.where(box_area(*inside) > 0)


def verified_detections(
    detections: DataFrame,
    confirmations: DataFrame | None = None,
    on: Sequence[str] = DETECTION,
) -> DataFrame:
    """Detections that a second detector confirms: by their flag or by a table of confirmed ones."""
    if confirmations is None:
        return detections.where("verified")
    return detections.join(confirmations, list(on), "left_semi")
