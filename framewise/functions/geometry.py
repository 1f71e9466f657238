"""Column functions on landmarks, points and boxes. All are built-in expressions.

Integers are made the way the input's producer makes them: ``cast`` truncates toward
zero and ``bround`` rounds halves to the even neighbour.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewise.schemas import BOX_PADDING, GRID_CELL

# Landmark numbers of (tip, middle joint) for the four long fingers,
# of the thumb's tip and joint, and of the wrist.
LONG_FINGERS = ((8, 6), (12, 10), (16, 14), (20, 18))
THUMB = (4, 3)
WRIST = 0

# The anchor sits 30 px above the wrist, or below it near the top edge.
ANCHOR_OFFSET = 30
ANCHOR_TOP = 20


def finger_count(landmarks: Column, hand_label: Column) -> Column:
    """Raised fingers, 0 to 5, of a 21-point hand with ``x`` and ``y`` in 0..1."""
    raised = [landmarks[tip]["y"] < landmarks[joint]["y"] for tip, joint in LONG_FINGERS]
    tip_x, joint_x = (landmarks[i]["x"] for i in THUMB)
    thumb = F.when(hand_label == "Right", tip_x < joint_x).otherwise(tip_x > joint_x)
    return reduce(add, [c.cast("int") for c in [*raised, thumb]])


def hand_anchor(landmarks: Column, width, height) -> tuple[Column, Column]:
    """Pixel position (x, y) that stands for a hand."""
    wrist = landmarks[WRIST]
    x = (wrist["x"] * width).cast("int")
    y = (wrist["y"] * height).cast("int")
    above = y - ANCHOR_OFFSET
    return x, F.when(above < ANCHOR_TOP, y + ANCHOR_OFFSET).otherwise(above)


def grid_cell(pixel: Column, size: int = GRID_CELL) -> Column:
    return F.bround(pixel / size).cast("int")


def centroid(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column]:
    return (x + w / 2).cast("int"), (y + h / 2).cast("int")


def clip_box(x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> tuple[Column, ...]:
    """(x0, y0, x1, y1) of the part of a box inside the frame; empty parts have no area."""
    zero = F.lit(0)
    return (
        F.greatest(x, zero),
        F.greatest(y, zero),
        F.least(x + w, F.lit(width)),
        F.least(y + h, F.lit(height)),
    )


def box_area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """0 unless both sides are positive."""
    zero = F.lit(0)
    return F.greatest(x1 - x0, zero) * F.greatest(y1 - y0, zero)


def padded_box(x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> tuple[Column, ...]:
    """The box widened by 15 % of its shorter side, inside the frame."""
    pad = (F.least(w, h) * F.lit(BOX_PADDING)).cast("int")
    return clip_box(x - pad, y - pad, w + 2 * pad, h + 2 * pad, width, height)


def squared_distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Integral, hence exact to order and compare by."""
    dx = x0.cast("long") - x1.cast("long")
    dy = y0.cast("long") - y1.cast("long")
    return dx * dx + dy * dy


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.hypot(x0 - x1, y0 - y1)
