"""Schemas, topic names and limits shared by all modules."""

# The labels a message may carry.
EMOTIONS = ("HAPPY", "SAD", "NEUTRAL", "FEAR", "SURPRISE", "ANGRY", "ANALYZING")

# Topic names.
RECORDED_TOPIC = "rt.emotions-recorded.v1"
UNIQUE_TOPIC = "rt.emotions-unique.v1"
WAVES_TOPIC = "rt.waves.v1"
TAIL_TOPIC = "rt.smile-events.v1"
COUNTS_TOPIC = "emotions-counts"

# Thresholds of the two history operators.
NTH_OCCURRENCE = 10
STREAK_OVER = 10
FULL_HAND = 5

# Tracker and hand settings, in frames and pixels.
REANALYZE_FRAMES = 30
MAX_MISSED_FRAMES = 60
MATCH_DISTANCE = 100
HANDS_PER_FACE = 2
GRID_CELL = 40
SMOOTH_HISTORY = 5
BOX_PADDING = 0.15
TAIL_WIDTH = 12

# Ids and labels are parsed as text, so that a bad number can be told from a missing one, and
# fingers as a variant, which knows whether it was written as an array, a text or anything else.
RAW_PEOPLE = "array<struct<id:string,emotion:string,fingers:variant>>"

MESSAGE = "key string, value string"
PEOPLE = "frame long, pos int, id int, emotion string, fingers array<int>"
EMOTION_EVENT = "id int, emotion string"
WAVE_EVENT = "id int"

FRAME_ORDER = ("frame", "pos")
