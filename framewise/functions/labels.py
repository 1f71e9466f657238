"""Column functions on label scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_SCORES = "unknown"
NOT_A_FACE = "not_face"
DEFAULT_LABEL = "neutral"


def dominant_label(scores: Column, failed: Column | None = None) -> Column:
    """Label with the highest score, the first one in map order on ties."""
    ranked = F.transform(
        F.map_entries(scores),
        lambda e, at: F.struct(e["value"].alias("score"), (-at).alias("place"), e["key"].alias("label")),
    )
    best = F.array_max(ranked)
    label = F.coalesce(best["label"], F.lit(NO_SCORES))
    return label if failed is None else F.when(failed, F.lit(NOT_A_FACE)).otherwise(label)


def emotion_name(label: Column) -> Column:
    return F.upper(F.coalesce(label, F.lit(DEFAULT_LABEL)))
