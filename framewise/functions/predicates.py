"""Conditions on decoded people and on tracks. None of them is ever null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewise.schemas import EMOTIONS, FULL_HAND, REANALYZE_FRAMES


def is_emotion(emotion: Column) -> Column:
    return F.coalesce(emotion.isin(*EMOTIONS), F.lit(False))


def max_fingers(fingers: Column) -> Column:
    """Largest entry; 0 for an empty or missing list."""
    return F.coalesce(F.array_max(fingers), F.lit(0))


def happy(emotion: Column) -> Column:
    return emotion.eqNullSafe("HAPPY")


def full_hand(fingers: Column) -> Column:
    return max_fingers(fingers) == FULL_HAND


def reanalysis_due(busy: Column, frame: Column, last_analyzed: Column) -> Column:
    """Not being analyzed, and never analyzed or at least 30 frames ago."""
    waited = frame - last_analyzed >= REANALYZE_FRAMES
    return ~F.coalesce(busy, F.lit(False)) & F.coalesce(waited, F.lit(True))
