from framewise.streaming.occurrence import stream_nth_occurrence
from framewise.streaming.runner import drain, drain_observed, drain_updates, run_until_quiet, start
from framewise.streaming.streak import stream_joint_streak
from framewise.streaming.tracking import stream_track_faces

__all__ = [
    "drain",
    "drain_observed",
    "drain_updates",
    "run_until_quiet",
    "start",
    "stream_joint_streak",
    "stream_nth_occurrence",
    "stream_track_faces",
]
