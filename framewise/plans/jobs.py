"""The pipelines, each as a function on DataFrames and as a query between topics.

::

    detections, hands ──> record ──> rt.emotions-recorded.v1 ──> unique emotions ──> rt.emotions-unique.v1 ──> counts
                                                            └──> waves ──> rt.waves.v1

The functions take tables as well as streams, except ``record_messages``, which takes
tables; ``start_recording`` is its form for streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framewise.functions.labels import emotion_name
from framewise.operators.counts import emotion_counts
from framewise.operators.hands import measure_hands, smooth_fingers
from framewise.operators.matching import people_by_frame
from framewise.operators.occurrence import nth_occurrence
from framewise.operators.streak import joint_streak
from framewise.operators.tracking import HAND_ROW, NOBODY, number_tracks, track_faces
from framewise.schemas import (
    COUNTS_TOPIC,
    NTH_OCCURRENCE,
    RECORDED_TOPIC,
    STREAK_OVER,
    TAIL_TOPIC,
    UNIQUE_TOPIC,
    WAVES_TOPIC,
)
from framewise.settings import written
from framewise.sources.codec import (
    decode,
    encode_counts,
    encode_emotion_event,
    encode_wave_event,
    list_messages,
    read_emotion_events,
    source_key,
    with_source,
)
from framewise.sources.topics import FileTopics, KafkaTopics, tail_lines, write_console, writer_of
from framewise.streaming.runner import start
from framewise.streaming.tracking import shown_frames, stream_track_changes

Topics = FileTopics | KafkaTopics
CAMERA_FRAME = ("camera_id", "frame")


def unique_emotions(
    messages: DataFrame,
    n: int = NTH_OCCURRENCE,
    on_error: str = "fail",
    by: Sequence[str] = (),
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
    mode: str = "append",
) -> DataFrame:
    """An event (id, emotion) when a person shows an emotion for the n-th time.

    Ids are those of one source. Where messages of several share a topic, ``by`` names the columns
    that tell sources apart; they are read from the message keys and stand ahead of the id. ``ttl_ms``
    forgets a person on a stream that long after the last change. ``history`` is a table of the messages that
    came before a stream. In ``mode`` update a stream of events can be counted in the same query.
    """
    people = decode(with_source(messages, by), on_error, by)
    before = None if history is None else decode(with_source(history, by), on_error, by)
    keys = (*by, "id", "emotion")
    return nth_occurrence(people, keys, n=n, ttl_ms=ttl_ms, history=before, mode=mode).select(*by, "id", "emotion")


def waves(
    messages: DataFrame,
    over: int = STREAK_OVER,
    on_error: str = "fail",
    by: Sequence[str] = (),
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """An event (id) for each frame that prolongs a wave of more than ``over`` frames. See ``unique_emotions``."""
    people = decode(with_source(messages, by), on_error, by)
    before = None if history is None else decode(with_source(history, by), on_error, by)
    return joint_streak(people, (*by, "id"), over=over, ttl_ms=ttl_ms, history=before).select(*by, "id")


def live_emotion_counts(messages: DataFrame, on_error: str = "fail", by: Sequence[str] = ()) -> DataFrame:
    """(emotion, cnt) over the events of ``unique_emotions``, in one query without a topic between.

    A stream is to be written in update mode.
    """
    return emotion_counts(unique_emotions(messages, on_error=on_error, by=by, mode="update"))


def count_unique_emotions(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(emotion, cnt) over the events that ``unique_emotions`` wrote."""
    return emotion_counts(read_emotion_events(messages, by))


def _messages(tracks: DataFrame, hands: DataFrame, frames: DataFrame) -> DataFrame:
    """A message per frame of ``tracks`` with ``track_id``, and the fingers of their hands."""
    number = F.col("track_id")
    faces = tracks.select(
        *CAMERA_FRAME, number.alias("face_ord"), number.alias("face_id"), "cx", "cy", emotion_name(F.col("label")).alias("emotion")
    )
    return list_messages(people_by_frame(faces, hands, CAMERA_FRAME), frames, by=["camera_id"])


def keyed(messages: DataFrame) -> DataFrame:
    """What ``record_messages`` gives, for a topic: the camera goes into the key."""
    return messages.withColumn("key", source_key(("camera_id",), "key"))


def hands_from_landmarks(landmarks: DataFrame, width: int = 640, height: int = 480) -> DataFrame:
    """Hands for ``record_messages``: camera_id, frame, hand_ord, hand_label, lm to smoothed counts and anchors."""
    smoothed = smooth_fingers(measure_hands(landmarks, width, height), CAMERA_FRAME)
    return smoothed.select(*CAMERA_FRAME, "hand_ord", F.col("smoothed").alias("n_fingers"), "x", "y")


def record_messages(
    frames: DataFrame,
    detections: DataFrame,
    hands: DataFrame,
    results: DataFrame | None = None,
    width: int = 640,
    height: int = 480,
) -> DataFrame:
    """(camera_id, key, value): one message per listed frame with its live tracks.

    ``hands``: camera_id, frame, hand_ord, n_fingers (smoothed), x, y. ``detections``
    should be visible and verified ones. For ``results`` see ``tracker_input``.
    """
    tracks = number_tracks(track_faces(frames, detections, results, width, height))
    return _messages(tracks, hands, frames)


def start_recording(
    rows: DataFrame,
    topics: Topics,
    checkpoint: str,
    topic: str = RECORDED_TOPIC,
    width: int = 640,
    height: int = 480,
    trigger: dict | None = None,
    smooth: bool = False,
    silence_ms: int | None = None,
) -> StreamingQuery:
    """Write a message per frame of ``rows``, a stream of ``tracker_input`` rows with hands.

    A frame is written when a row of a later frame of its camera has come, so its rows may come in
    several micro-batches; with ``silence_ms``, also when nothing has come from its camera for that long, so that
    the last frame is written as well. With ``smooth``, counts of hands are smoothed within their frame; raw ones
    come from ``measure_hands``, which takes streams. Keys are ``camera:frame``. A micro-batch that is repeated after a failure
    adds nothing to a file topic and is sent again to a Kafka one.
    """
    together = stream_track_changes(rows, width, height, empty_frames=True, whole_frames=True, silence_ms=silence_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Used several times below, but tracks should come out of state only once.
        with written(batch, "recorded-batch") as changes:
            rows = shown_frames(changes)
            of_tracks = rows.where(F.col("n") != HAND_ROW)
            of_hands = rows.where(F.col("n") == HAND_ROW).select(
                *CAMERA_FRAME, F.col("session").alias("hand_ord"), F.col("w").alias("n_fingers"), "x", "y"
            )
            if smooth:
                of_hands = smooth_fingers(of_hands, CAMERA_FRAME).withColumn("n_fingers", F.col("smoothed"))
            messages = _messages(of_tracks.where(F.col("n") != NOBODY), of_hands, of_tracks)
            topics.write(keyed(messages), topic, batch_id, writer_of(batch))

    writer = together.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return start(writer.trigger(**trigger) if trigger else writer, together)


def _between(make, encode, source: str, target: str):
    def run(
        spark: SparkSession,
        topics: Topics,
        checkpoint: str,
        starting: str = "latest",
        source: str = source,
        target: str = target,
        trigger: dict | None = None,
        by: Sequence[str] = (),
        **options,
    ) -> StreamingQuery:
        events = make(topics.stream(spark, source, starting, checkpoint=checkpoint), by=by, **options)
        writer = topics.write_stream(encode(events, by), target, checkpoint)
        return start(writer.trigger(**trigger) if trigger else writer, events)

    return run


start_unique_emotions = _between(unique_emotions, encode_emotion_event, RECORDED_TOPIC, UNIQUE_TOPIC)
start_waves = _between(waves, encode_wave_event, RECORDED_TOPIC, WAVES_TOPIC)


def start_emotion_counts(
    spark: SparkSession,
    topics: Topics,
    checkpoint: str,
    starting: str = "earliest",
    to_topic: bool = False,
    trigger: dict | None = None,
    by: Sequence[str] = (),
) -> StreamingQuery:
    """Print each changed count, or send it to the counts topic."""
    counts = count_unique_emotions(topics.stream(spark, UNIQUE_TOPIC, starting, checkpoint=checkpoint), by)
    if to_topic:
        writer = topics.write_stream(encode_counts(counts), COUNTS_TOPIC, checkpoint, "update")
    else:
        writer = write_console(counts, checkpoint)
    return start(writer.trigger(**trigger) if trigger else writer, counts)


def start_tail(
    spark: SparkSession,
    topics: Topics,
    checkpoint: str,
    topic: str = TAIL_TOPIC,
    starting: str = "latest",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Print the values of a topic as they arrive; records that are lost are passed over."""
    lines = tail_lines(topics.stream(spark, topic, starting, skip_lost=True, checkpoint=checkpoint))
    writer = lines.writeStream.format("console").option("truncate", "false").option("checkpointLocation", checkpoint)
    return start(writer.trigger(**trigger) if trigger else writer, lines)
