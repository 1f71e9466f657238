from framewise.operators.counts import emotion_counts, people_per_frame
from framewise.operators.detections import verified_detections, visible_detections
from framewise.operators.hands import measure_hands, smooth_fingers
from framewise.operators.labels import label_asof
from framewise.operators.matching import faces_with_fingers, fingers_by_face, greedy_match, nearest_face, pair_distance
from framewise.operators.occurrence import nth_occurrence, occurrence_number
from framewise.operators.scan import Running, scan
from framewise.operators.streak import joint_streak, streak_lengths
from framewise.operators.tracking import analysis_requests, follow_faces, number_tracks, track_faces, tracker_input

__all__ = [
    "Running",
    "analysis_requests",
    "emotion_counts",
    "faces_with_fingers",
    "fingers_by_face",
    "follow_faces",
    "greedy_match",
    "joint_streak",
    "label_asof",
    "measure_hands",
    "nearest_face",
    "nth_occurrence",
    "number_tracks",
    "occurrence_number",
    "pair_distance",
    "people_per_frame",
    "scan",
    "smooth_fingers",
    "streak_lengths",
    "track_faces",
    "tracker_input",
    "verified_detections",
    "visible_detections",
]
