from framewise.functions.geometry import (
    box_area,
    centroid,
    clip_box,
    distance,
    finger_count,
    grid_cell,
    hand_anchor,
    padded_box,
    squared_distance,
)
from framewise.functions.labels import dominant_label, emotion_name
from framewise.functions.predicates import full_hand, happy, is_emotion, max_fingers, reanalysis_due

__all__ = [
    "box_area",
    "centroid",
    "clip_box",
    "distance",
    "dominant_label",
    "emotion_name",
    "finger_count",
    "full_hand",
    "grid_cell",
    "hand_anchor",
    "happy",
    "is_emotion",
    "max_fingers",
    "padded_box",
    "reanalysis_due",
    "squared_distance",
]
