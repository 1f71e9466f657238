"""

All inputs are derived from ``events``; ``framewise.plans.views`` holds the Spark text of
the derived tables and ``_VIEWS`` below the SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise import functions as fn
from framewise import operators as op
from framewise.plans import jobs
from framewise.plans import views as v
from framewise.schemas import COUNTS_TOPIC, RECORDED_TOPIC, UNIQUE_TOPIC, WAVES_TOPIC
from framewise.settings import run_dir
from framewise.sources import (
    FileTopics,
    decode,
    encode_emotion_event,
    encode_wave_event,
    frame_messages,
    split_messages,
    tail_lines,
)
from framewise.streaming import drain, drain_observed, drain_updates, run_until_quiet, start, stream_track_faces

# The corpus operators and their pipeline are added where they, and the packages they need, are installed.
try:
    from framewise.llm import registry as _corpus
    import corpus_pipeline as _pipeline
except ImportError:
    _corpus = _pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# A span with which even the smallest table has many blocks per key.
_FEW_FRAMES = 64

_SMOKE_DIR = "/root/testdata/sf0.001"


def _text(column: str):
    return F.array_join(column, ",").alias(column)


def _messages(ev: DataFrame) -> DataFrame:
    return frame_messages(v.people(ev))


def _wave_messages(ev: DataFrame) -> DataFrame:
    return frame_messages(v.wave_people(ev))


def _with_bad_fingers(ev: DataFrame) -> DataFrame:
    """Finger lists of people with id 3, 13, 23 and so on replaced by what is no list of integers.

    People with id 4, 14, 24 and so on get further fields that only look like such ones.
    """
    pick = F.regexp_extract("value", r'"id":\d*3,', 0) != ""
    bad = ["5", '"abc"', '{"a":1}', '"[1]"', "[1,1.0]", '["1",{"a":1}]', "[true]"]
    listed = r'("id":\d*3,"emotion":"[A-Z]+",)"fingers":\[[^\]]*\]'
    named = F.when(F.col("key").cast("long") % 3 == 0, '"fing\\\\u0065rs":').otherwise('"fingers":')
    kind = F.element_at(F.lit(bad), (F.col("key").cast("long") % len(bad)).cast("int") + 1)
    value = F.when(pick, F.regexp_replace("value", F.lit(listed), F.concat(F.lit("$1"), named, kind))).otherwise(F.col("value"))
    nested = F.lit(r'$1"meta":{"fingers":"five","note":"\\"fingers\\":\\"x\\""},')
    return _messages(ev).withColumn("value", F.regexp_replace(value, F.lit(r'("id":\d*4,)'), nested))


def _flawed_messages(ev: DataFrame) -> DataFrame:
    """The labels of ANGRY people replaced by one that is not in the known set."""
    label = F.when(F.col("emotion") == "ANGRY", "UNKNOWN").otherwise(F.col("emotion"))
    return frame_messages(v.people(ev).withColumn("emotion", label))


# Decode and encode


def decode_people(spark, sf_dir):
    return decode(_messages(v.events(spark, sf_dir))).select("frame", "pos", "id", "emotion", _text("fingers"))


def accepted_people(spark, sf_dir):
    people, _ = split_messages(_flawed_messages(v.events(spark, sf_dir)))
    return people.select("frame", "pos", "id", "emotion", _text("fingers"))


def rejected_messages(spark, sf_dir):
    _, rejected = split_messages(_flawed_messages(v.events(spark, sf_dir)))
    return rejected.select("key", "value", "error")


def rejected_fingers(spark, sf_dir):
    """Keys of the messages in which somebody's fingers are no array."""
    _, rejected = split_messages(_with_bad_fingers(v.events(spark, sf_dir)))
    return rejected.select("key", "error")


def assemble_messages(spark, sf_dir):
    return _messages(v.events(spark, sf_dir))


def encode_events(spark, sf_dir):
    return encode_emotion_event(op.nth_occurrence(v.people(v.events(spark, sf_dir))))


def encode_waves(spark, sf_dir):
    return encode_wave_event(op.joint_streak(v.wave_people(v.events(spark, sf_dir))))


def padded_lines(spark, sf_dir):
    return tail_lines(v.events(spark, sf_dir).select(F.col("props").alias("value")))


# History of a person


def occurrence_number(spark, sf_dir):
    return op.occurrence_number(v.people(v.events(spark, sf_dir)).drop("fingers"))


def occurrence_number_in_blocks(spark, sf_dir):
    return op.occurrence_number(v.people(v.events(spark, sf_dir)).drop("fingers"), span=_FEW_FRAMES)


def nth_occurrence(spark, sf_dir):
    return op.nth_occurrence(v.people(v.events(spark, sf_dir)))


def unique_emotion_counts(spark, sf_dir):
    return jobs.count_unique_emotions(encode_emotion_event(op.nth_occurrence(v.people(v.events(spark, sf_dir)))))


def unique_emotions_job(spark, sf_dir):
    return jobs.unique_emotions(_messages(v.events(spark, sf_dir)))


def waves_job(spark, sf_dir):
    return jobs.waves(_wave_messages(v.events(spark, sf_dir)))


def streak_lengths(spark, sf_dir):
    return op.streak_lengths(v.wave_people(v.events(spark, sf_dir)))


def streak_lengths_in_blocks(spark, sf_dir):
    return op.streak_lengths(v.wave_people(v.events(spark, sf_dir)), span=_FEW_FRAMES)


def joint_streak(spark, sf_dir):
    return op.joint_streak(v.wave_people(v.events(spark, sf_dir)))


def people_per_frame(spark, sf_dir):
    return op.people_per_frame(v.people(v.events(spark, sf_dir)))


# Hands and boxes


def finger_count(spark, sf_dir):
    n = fn.finger_count(F.col("lm"), F.col("hand_label"))
    return v.landmarks(v.events(spark, sf_dir)).select("hand_key", n.alias("n_fingers"))


def hand_anchor(spark, sf_dir):
    x, y = fn.hand_anchor(F.col("lm"), v.WIDTH, v.HEIGHT)
    return v.landmarks(v.events(spark, sf_dir)).select("hand_key", x.alias("x"), y.alias("y"))


def grid_cell(spark, sf_dir):
    cells = [fn.grid_cell(F.col(c)).alias(f"cell_{c}") for c in ("x", "y")]
    return v.camera_hands(v.events(spark, sf_dir)).select("camera_id", "frame", "hand_ord", *cells)


def smooth_fingers(spark, sf_dir):
    smoothed = op.smooth_fingers(v.camera_hands(v.events(spark, sf_dir)), jobs.CAMERA_FRAME)
    return smoothed.select(*jobs.CAMERA_FRAME, "hand_ord", "smoothed")


def box_geometry(spark, sf_dir):
    box = [F.col(c) for c in ("x", "y", "w", "h")]
    cx, cy = fn.centroid(*box)
    inside = fn.clip_box(*box, v.WIDTH, v.HEIGHT)
    padded = fn.padded_box(*box, v.WIDTH, v.HEIGHT)
    names = ("x0", "y0", "x1", "y1")
    return v.detections(v.events(spark, sf_dir)).select(
        "camera_id",
        "frame",
        "det_ord",
        cx.alias("cx"),
        cy.alias("cy"),
        *[c.alias(n) for c, n in zip(inside, names, strict=True)],
        fn.box_area(*inside).alias("area"),
        *[c.alias(f"pad_{n}") for c, n in zip(padded, names, strict=True)],
    )


def visible_detections(spark, sf_dir):
    return op.visible_detections(v.detections(v.events(spark, sf_dir)).drop("verified"), 400, 300)


def verified_detections(spark, sf_dir):
    found = v.detections(v.events(spark, sf_dir))
    return op.verified_detections(found.drop("verified"), found.where("verified"))


def dominant_label(spark, sf_dir):
    label = fn.dominant_label(F.col("scores"), F.col("failed"))
    return v.scores(v.events(spark, sf_dir)).select(
        "event_id", label.alias("label"), fn.emotion_name(label).alias("emotion")
    )


# Hands to faces


def _hands_faces(spark, sf_dir):
    ev = v.events(spark, sf_dir)
    return v.hands(ev), v.faces(ev)


def pair_distance(spark, sf_dir):
    return op.pair_distance(*_hands_faces(spark, sf_dir)).drop("distance")


def nearest_face(spark, sf_dir):
    return op.nearest_face(*_hands_faces(spark, sf_dir))


def greedy_match(spark, sf_dir):
    return op.greedy_match(*_hands_faces(spark, sf_dir))


def fingers_by_face(spark, sf_dir):
    hands, faces = _hands_faces(spark, sf_dir)
    joined = op.faces_with_fingers(faces, hands)
    return joined.select("frame_id", "face_ord", "face_id", _text("fingers"))


# Tracks


def label_asof(spark, sf_dir):
    ev = v.events(spark, sf_dir)
    return op.label_asof(v.person_tracks(ev), v.label_results(ev))


def label_asof_in_blocks(spark, sf_dir):
    ev = v.events(spark, sf_dir)
    return op.label_asof(v.person_tracks(ev), v.label_results(ev), span=_FEW_FRAMES)


def reanalysis_due(spark, sf_dir):
    due = fn.reanalysis_due(F.col("busy"), F.col("frame"), F.col("last_analyzed"))
    return v.analysis_states(v.events(spark, sf_dir)).withColumn("due", due)


def _tracked(spark, sf_dir, **options):
    ev = v.events(spark, sf_dir)
    return op.track_faces(v.camera_frames(ev), v.detections(ev).where("verified"), width=v.WIDTH, height=v.HEIGHT, **options)


_TRACK_COLUMNS = "camera_id frame session n track_id x y w h cx cy label last_seen_frame ask".split()


def track_faces(spark, sf_dir):
    return op.number_tracks(_tracked(spark, sf_dir)).select(*_TRACK_COLUMNS)


def track_faces_in_blocks(spark, sf_dir):
    return op.number_tracks(_tracked(spark, sf_dir, span=_FEW_FRAMES)).select(*_TRACK_COLUMNS)


def track_faces_crowded(spark, sf_dir):
    """One camera that never pauses, with a dozen places far from each other: a dozen units or more."""
    found = v.crowded_detections(v.events(spark, sf_dir))
    tracks = op.track_faces(found.select("camera_id", "frame"), found, width=v.PLACES * v.PLACE_WIDTH, height=v.HEIGHT)
    return op.number_tracks(tracks).select(*_TRACK_COLUMNS)


def analysis_requests(spark, sf_dir):
    return op.analysis_requests(_tracked(spark, sf_dir))


def _told_tracks(spark, sf_dir):
    """Tracks whose analysis requests are answered. Those without answers are followed once for both."""
    followed = op.follow_faces(v.detections(v.events(spark, sf_dir)).where("verified"), v.WIDTH, v.HEIGHT)
    requests = op.analysis_requests(_tracked(spark, sf_dir, followed=followed))
    return _tracked(spark, sf_dir, results=v.request_results(requests), followed=followed)


def track_labels(spark, sf_dir):
    return op.number_tracks(_told_tracks(spark, sf_dir)).select(*_TRACK_COLUMNS)


def repeated_requests(spark, sf_dir):
    """Requests with the repeated ones: failed analyses at once, others after thirty frames."""
    return op.analysis_requests(_told_tracks(spark, sf_dir))


def recorded_messages(spark, sf_dir):
    ev = v.events(spark, sf_dir)
    detected = v.detections(ev).where("verified")
    return jobs.record_messages(v.camera_frames(ev), detected, v.camera_hands(ev), width=v.WIDTH, height=v.HEIGHT)


def landmarks_to_messages(spark, sf_dir):
    """The whole way from hand landmarks and boxes to messages."""
    ev = v.events(spark, sf_dir)
    hands = jobs.hands_from_landmarks(v.camera_landmarks(ev), v.WIDTH, v.HEIGHT)
    return jobs.record_messages(v.camera_frames(ev), v.detections(ev).where("verified"), hands, width=v.WIDTH, height=v.HEIGHT)


def recorded_unique_emotions(spark, sf_dir):
    """From detections of five cameras, over their messages, to the tenth frames."""
    return jobs.unique_emotions(jobs.keyed(recorded_messages(spark, sf_dir)), by=["camera_id"])


# Streams: run over all input, then read back


def stream_nth(spark, sf_dir):
    return drain(op.nth_occurrence(v.people(v.events_stream(spark, sf_dir))), "nth")


def stream_streak(spark, sf_dir):
    return drain(op.joint_streak(v.wave_people(v.events_stream(spark, sf_dir))), "streak")


def stream_counts(spark, sf_dir):
    counts = op.emotion_counts(v.people(v.events_stream(spark, sf_dir)))
    return drain_updates(counts, "counts", ["emotion"])


def stream_chain(spark, sf_dir):
    """Two queries with a topic between them: events, then their counts."""
    topics = FileTopics(run_dir(spark, "topics"))
    events = op.nth_occurrence(v.people(v.events_stream(spark, sf_dir)))
    writer = topics.write_stream(encode_emotion_event(events), UNIQUE_TOPIC, run_dir(spark, "checkpoint"))
    start(writer.trigger(availableNow=True), events).awaitTermination()
    return drain_updates(jobs.count_unique_emotions(topics.stream(spark, UNIQUE_TOPIC)), "chain", ["emotion"])


def stream_chain_direct(spark, sf_dir):
    """The same in one query: a stateful processor, and the counts of its events."""
    messages = _messages_stream(spark, sf_dir)
    return drain_updates(jobs.live_emotion_counts(messages), "chain", ["emotion"])


def _messages_stream(spark, sf_dir) -> DataFrame:
    keyed = _messages(v.events(spark, sf_dir)).withColumn("_frame", F.col("key").cast("long"))
    return v.in_files(keyed, "_frame").drop("_frame")


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """People of the first frames as a table, those of the others as a stream; frames are cut anywhere."""
    ev = v.events(spark, sf_dir)
    half = ev.agg(F.max("event_id")).first()[0] // 2
    return ev.where(F.col("event_id") <= half), v.in_files(ev.where(F.col("event_id") > half), "event_id")


def stream_nth_after_history(spark, sf_dir):
    """The first half as a table, the rest as a stream whose counts go on from it."""
    before, stream = _halves(spark, sf_dir)
    events = drain(op.nth_occurrence(v.people(stream), history=v.people(before)), "nth")
    return events.unionByName(op.nth_occurrence(v.people(before)))


def stream_streak_after_history(spark, sf_dir):
    before, stream = _halves(spark, sf_dir)
    events = drain(op.joint_streak(v.wave_people(stream), history=v.wave_people(before)), "streak")
    return events.unionByName(op.joint_streak(v.wave_people(before)))


def stream_nth_with_ttl(spark, sf_dir):
    """State that would be forgotten a day after its last change. With a clock in the state, only batches with rows are run."""
    option = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        return drain(op.nth_occurrence(v.people(v.events_stream(spark, sf_dir)), ttl_ms=86_400_000), "nth")
    finally:
        spark.conf.set(option, before)


def stream_skipped_messages(spark, sf_dir):
    """How many messages there are, and how many of them are broken and skipped, as the query reports it."""
    flawed = _flawed_messages(v.events(spark, sf_dir)).withColumn("_frame", F.col("key").cast("long"))
    people = decode(v.in_files(flawed, "_frame").drop("_frame"), "drop", metric="decoded")
    rows, totals = drain_observed(people, "skipped", "decoded")
    counts = [F.lit(totals.get(c, 0)).cast("long").alias(c) for c in ("messages", "broken")]
    return rows.agg(F.count("*").alias("people")).select("people", *counts)


def stream_tail(spark, sf_dir):
    """A topic's values as they arrive, padded; records without a value are skipped."""
    topics, ev = FileTopics(run_dir(spark, "topics")), v.events(spark, sf_dir)
    topics.write(ev.select(F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("value")), RECORDED_TOPIC)
    rows, totals = drain_observed(tail_lines(topics.stream(spark, RECORDED_TOPIC, skip_lost=True), "tail"), "tail", "tail")
    return rows.withColumn("skipped", F.lit(totals.get("skipped", 0)).cast("long"))


def stream_restarted(spark, sf_dir):
    """The job between topics, stopped and started again with its checkpoint, at a limited rate."""
    topics, ev = FileTopics(run_dir(spark, "topics"), max_files=64), v.events(spark, sf_dir)
    checkpoint, frame = run_dir(spark, "checkpoint"), F.col("key").cast("long")
    messages = _messages(ev)
    middle = messages.agg(F.max(frame)).first()[0] // 2
    for part in (frame <= middle, frame > middle):
        topics.write(messages.where(part), RECORDED_TOPIC)
        jobs.start_unique_emotions(spark, topics, checkpoint, "earliest", trigger={"availableNow": True}).awaitTermination()
    return topics.read(spark, UNIQUE_TOPIC).select("value")


def stream_latest(spark, sf_dir):
    """Events of those messages only that came to the topic after the job was started for the first time."""
    topics, ev = FileTopics(run_dir(spark, "topics")), v.events(spark, sf_dir)
    checkpoint, frame = run_dir(spark, "checkpoint"), F.col("key").cast("long")
    for part in (frame % 2 == 0, frame % 2 == 1):
        topics.write(_messages(ev).where(part), RECORDED_TOPIC)
        jobs.start_waves(spark, topics, checkpoint, "latest", trigger={"availableNow": True}, over=0).awaitTermination()
    return topics.read(spark, WAVES_TOPIC).select("value")


def stream_counts_topic(spark, sf_dir):
    """Changed counts as messages of a topic, and the newest of each label in it.

    A file is a micro-batch, so the events are written to as many files however many there are.
    """
    topics, ev = FileTopics(run_dir(spark, "topics"), max_files=1), v.events(spark, sf_dir)
    events = op.nth_occurrence(v.people(ev))
    for i in range(3):
        topics.write(encode_emotion_event(events.where(F.col("id") % 3 == i)).repartition(4), UNIQUE_TOPIC)
    jobs.start_emotion_counts(spark, topics, run_dir(spark, "checkpoint"), to_topic=True, trigger={"availableNow": True}).awaitTermination()
    counts = topics.read(spark, COUNTS_TOPIC).select(F.from_json("value", "emotion string, cnt long").alias("c")).select("c.*")
    return counts.groupBy("emotion").agg(F.max("cnt").alias("cnt"))


def people_per_listed_frame(spark, sf_dir):
    """Also the frames in which nobody is: every third one here."""
    ev = v.events(spark, sf_dir)
    people = v.people(ev)
    return op.people_per_frame(people.where(F.col("frame") % 3 != 0), people.select("frame").distinct())


def stream_waves_without_keys(spark, sf_dir):
    """A topic that only holds values: nobody's frames have a number. All show a wave all the time."""
    waving = v.people(v.events(spark, sf_dir)).withColumns({"emotion": F.lit("HAPPY"), "fingers": F.array(F.lit(5))})
    messages = frame_messages(waving)
    topics = FileTopics(run_dir(spark, "topics"), max_files=4)
    for i in range(3):
        topics.write(messages.where(F.col("key").cast("long") % 3 == i).select("value").repartition(4), RECORDED_TOPIC)
    return drain(jobs.waves(topics.stream(spark, RECORDED_TOPIC)), "waves")


def _camera_steps(ev: DataFrame, hands: bool = False) -> DataFrame:
    """What a camera's stream brings: its boxes and hands, and a frame row with each box."""
    found = v.detections(ev)
    ticks = found.select("camera_id", "frame")
    return op.tracker_input(ticks, found.where("verified"), hands=v.camera_hands(ev) if hands else None)


def stream_tracks(spark, sf_dir):
    """Frames are cut by micro-batches; the last one of each camera stays open."""
    rows = _camera_steps(v.events_stream(spark, sf_dir))
    return drain(stream_track_faces(rows, v.WIDTH, v.HEIGHT, whole_frames=True), "tracks").select(*_TRACK_COLUMNS)


def stream_track_labels(spark, sf_dir):
    """The same with results, everything in four micro-batches."""
    ev = v.events(spark, sf_dir)
    results = v.request_results(op.analysis_requests(_tracked(spark, sf_dir)))
    steps = op.tracker_input(v.camera_frames(ev), v.detections(ev).where("verified"), results)
    stream = stream_track_faces(v.in_files(steps, "frame"), v.WIDTH, v.HEIGHT, whole_frames=True)
    # The last frame is open or not, according to whether a result names a later one.
    last = v.camera_frames(ev).agg(F.max("frame").alias("last"))
    return drain(stream, "tracks").join(F.broadcast(last), F.col("frame") < F.col("last")).select(*_TRACK_COLUMNS)


def stream_landmarks_to_messages(spark, sf_dir):
    topics, ev = FileTopics(run_dir(spark, "topics")), v.events(spark, sf_dir)
    hands = op.measure_hands(v.camera_landmarks(ev), v.WIDTH, v.HEIGHT)
    steps = v.in_files(op.tracker_input(v.camera_frames(ev), v.detections(ev).where("verified"), hands=hands), "frame")
    size = {"width": v.WIDTH, "height": v.HEIGHT}
    query = jobs.start_recording(steps, topics, run_dir(spark, "checkpoint"), smooth=True, trigger={"availableNow": True}, **size)
    query.awaitTermination()
    return topics.read(spark, RECORDED_TOPIC)


def stream_recording(spark, sf_dir):
    """Two recordings, of three and of two cameras, into one topic at the same time; its messages."""
    topics, ev = FileTopics(run_dir(spark, "topics")), v.events_stream(spark, sf_dir)
    recordings = []
    try:
        for cameras in ("camera_id < 3", "camera_id >= 3"):
            recordings.append(
                jobs.start_recording(
                    _camera_steps(ev, hands=True).where(cameras),
                    topics,
                    run_dir(spark, "checkpoint"),
                    width=v.WIDTH,
                    height=v.HEIGHT,
                    trigger={"availableNow": True},
                )
            )
        for recording in recordings:
            recording.awaitTermination()
    finally:
        # None goes on by itself when another has failed.
        for recording in recordings:
            recording.stop()
    return topics.read(spark, RECORDED_TOPIC)


def stream_recording_to_the_end(spark, sf_dir):
    """A recording whose last frames are closed by silence: as the table has it, no frame left out."""
    topics, ev = FileTopics(run_dir(spark, "topics")), v.events(spark, sf_dir)
    frames = v.camera_frames(ev)
    steps = op.tracker_input(frames, v.detections(ev).where("verified"), hands=v.camera_hands(ev))
    silence_ms = 8_000
    query = jobs.start_recording(
        v.in_files(steps, "frame"),
        topics,
        run_dir(spark, "checkpoint"),
        width=v.WIDTH,
        height=v.HEIGHT,
        trigger={"processingTime": "1 second"},
        silence_ms=silence_ms,
    )
    run_until_quiet(query, silence_ms)
    # As the tracker names them: a frame is shown once, however often it is listed.
    wanted, written = op.tracker_input(frames).distinct().count(), topics.read(spark, RECORDED_TOPIC).count()
    if written != wanted:
        raise RuntimeError(f"{written} of {wanted} frames were recorded")
    return topics.read(spark, RECORDED_TOPIC)


_QUERIES: tuple[Query, ...] = (
    decode_people,
    accepted_people,
    rejected_messages,
    rejected_fingers,
    assemble_messages,
    encode_events,
    encode_waves,
    padded_lines,
    occurrence_number,
    occurrence_number_in_blocks,
    nth_occurrence,
    unique_emotion_counts,
    unique_emotions_job,
    waves_job,
    streak_lengths,
    streak_lengths_in_blocks,
    joint_streak,
    people_per_frame,
    people_per_listed_frame,
    finger_count,
    hand_anchor,
    grid_cell,
    smooth_fingers,
    box_geometry,
    visible_detections,
    verified_detections,
    dominant_label,
    pair_distance,
    nearest_face,
    greedy_match,
    fingers_by_face,
    label_asof,
    label_asof_in_blocks,
    reanalysis_due,
    track_faces,
    track_faces_in_blocks,
    track_faces_crowded,
    analysis_requests,
    track_labels,
    repeated_requests,
    recorded_messages,
    landmarks_to_messages,
    recorded_unique_emotions,
    stream_nth,
    stream_streak,
    stream_counts,
    stream_chain,
    stream_chain_direct,
    stream_nth_after_history,
    stream_streak_after_history,
    stream_nth_with_ttl,
    stream_skipped_messages,
    stream_tail,
    stream_restarted,
    stream_latest,
    stream_counts_topic,
    stream_waves_without_keys,
    stream_tracks,
    stream_track_labels,
    stream_recording,
    stream_landmarks_to_messages,
    stream_recording_to_the_end,
)


def entry(spark: SparkSession) -> DataFrame:
    """How many people reached their tenth frame of each emotion, from messages on."""
    messages = _messages(v.events(spark, _SMOKE_DIR))
    return op.emotion_counts(jobs.unique_emotions(messages))


def queries() -> dict[str, Query]:
    found = {q.__name__: q for q in _QUERIES}
    if _corpus:
        found |= {**_corpus.queries(), "pipeline": _pipeline.run}
    return found


_FINGERS = """CAST(lm[9].y < lm[7].y AS INT) + CAST(lm[13].y < lm[11].y AS INT)
    + CAST(lm[17].y < lm[15].y AS INT) + CAST(lm[21].y < lm[19].y AS INT)
    + CAST(CASE WHEN hand_label = 'Right' THEN lm[5].x < lm[4].x ELSE lm[5].x > lm[4].x END AS INT)"""
_ANCHOR_X = "CAST(trunc(lm[1].x * 640) AS INT)"
_ANCHOR_Y = """CASE WHEN CAST(trunc(lm[1].y * 480) AS INT) - 30 < 20 THEN CAST(trunc(lm[1].y * 480) AS INT) + 30
    ELSE CAST(trunc(lm[1].y * 480) AS INT) - 30 END"""

# A label for a result, by a number.
_TOLD = """CASE ({}) % 6 WHEN 0 THEN 'not_face' WHEN 2 THEN 'happy' WHEN 3 THEN 'sad'
                         WHEN 4 THEN 'unknown' WHEN 5 THEN 'fear' END AS label"""

# The derived tables in SQL, named as in framewise.plans.views.
_VIEWS = {
    "people": """
        SELECT event_id // 4 AS frame, CAST(event_id % 4 AS INT) AS pos, CAST(user_id AS INT) AS id,
          CASE event_type WHEN 'click' THEN 'HAPPY' WHEN 'view' THEN 'NEUTRAL' WHEN 'purchase' THEN 'SURPRISE'
                          WHEN 'signup' THEN 'SAD' ELSE 'ANGRY' END AS emotion,
          CASE WHEN k % 7 = 0 THEN CAST([] AS INT[]) ELSE [CAST(k % 6 AS INT), CAST(k // 6 % 6 AS INT)] END AS fingers
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "wave_people": """
        SELECT event_id // 4 AS frame, CAST(event_id % 4 AS INT) AS pos, CAST(user_id AS INT) AS id,
          CASE WHEN event_type <> 'error' THEN 'HAPPY' ELSE 'ANGRY' END AS emotion,
          [CASE WHEN value < 100 THEN 5 ELSE 0 END] AS fingers
        FROM events""",
    "messages": """
        SELECT CAST(frame AS VARCHAR) AS key,
          '[' || string_agg('{"id":' || id || ',"emotion":"' || emotion || '","fingers":['
                            || array_to_string(fingers, ',') || ']}', ',' ORDER BY pos) || ']' AS value
        FROM people GROUP BY frame""",
    "hands": """
        SELECT event_id // 12 AS frame_id, CAST(event_id % 12 AS INT) AS hand_ord, CAST(event_id % 6 AS INT) AS n_fingers,
          CAST((event_id * 37) % 640 AS INT) AS x, CAST((event_id * 91) % 480 AS INT) AS y
        FROM events WHERE event_id % 12 < 5""",
    "faces": """
        SELECT event_id // 12 AS frame_id, CAST(event_id % 12 AS INT) AS face_ord, user_id AS face_id,
          CAST((event_id * 53) % 640 AS INT) AS cx, CAST((event_id * 29) % 480 AS INT) AS cy
        FROM events WHERE event_id % 12 >= 5""",
    "landmarks": """
        SELECT event_id AS hand_key, CASE WHEN event_id % 2 = 0 THEN 'Right' ELSE 'Left' END AS hand_label,
          list_transform(range(0, 21), lambda i: {
            'x': CAST((event_id + 1) * (i + 3) * 7 % 101 AS DOUBLE) / 100,
            'y': CAST((event_id + 2) * (i + 5) * 11 % 103 AS DOUBLE) / 100}) AS lm
        FROM events""",
    "detections": """
        SELECT user_id % 5 AS camera_id, event_id // 8 + event_id // 500 * 100 AS frame,
          CAST(event_id % 8 AS INT) AS det_ord,
          CAST((user_id * 97 + event_id // 16) % 660 AS INT) - 20 AS x,
          CAST((user_id * 61 + event_id // 32) % 500 AS INT) - 20 AS y,
          CAST(60 + event_id % 41 AS INT) AS w, CAST(60 + event_id % 37 AS INT) AS h,
          event_type <> 'error' AS verified
        FROM events""",
    "crowded": """
        SELECT CAST(0 AS BIGINT) AS camera_id, event_id // 8 AS frame, CAST(event_id % 8 AS INT) AS det_ord,
          CAST(user_id % 12 * 600 + (user_id * 17 + event_id // 16) % 200 AS INT) AS x,
          CAST((user_id * 61 + event_id // 32) % 150 AS INT) AS y,
          CAST(60 + event_id % 41 AS INT) AS w, CAST(60 + event_id % 37 AS INT) AS h, true AS verified
        FROM events""",
    "camera_frames": """
        SELECT DISTINCT camera_id, event_id // 8 + event_id // 500 * 100 AS frame
        FROM events, (SELECT unnest(range(0, 5)) AS camera_id)""",
    "occurrences": """
        SELECT frame, pos, id, emotion,
          CAST(row_number() OVER (PARTITION BY id, emotion ORDER BY frame, pos) AS BIGINT) AS occurrence
        FROM people""",
    "tenth": "SELECT id, emotion, frame, pos FROM occurrences WHERE occurrence = 10",
    "flags": """
        SELECT *, emotion = 'HAPPY' AS h, coalesce(list_max(fingers), 0) = 5 AS f,
          row_number() OVER (PARTITION BY id ORDER BY frame, pos) AS rn
        FROM wave_people""",
    "lengths": """
        SELECT id, frame, pos,
          CAST(rn - coalesce(max(CASE WHEN NOT h THEN rn END) OVER so_far, 0) AS BIGINT) AS happy,
          CAST(rn - coalesce(max(CASE WHEN NOT f THEN rn END) OVER so_far, 0) AS BIGINT) AS full_hand
        FROM flags
        WINDOW so_far AS (PARTITION BY id ORDER BY frame, pos ROWS UNBOUNDED PRECEDING)""",
    "wave_events": "SELECT id, frame, pos FROM lengths WHERE happy > 10 AND full_hand > 10",
    "pairs": """
        SELECT frame_id, hand_ord, n_fingers, face_ord, face_id,
          CAST((x - cx) * (x - cx) + (y - cy) * (y - cy) AS BIGINT) AS d2
        FROM hands JOIN faces USING (frame_id)""",
    "ranked_pairs": """
        SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY d2, hand_ord, face_ord) AS place FROM pairs""",
    # Pairs of a frame one by one, with the hands and faces chosen so far.
    "choices": """
        SELECT frame_id, CAST(0 AS BIGINT) AS place, false AS chosen,
          CAST([] AS INT[]) AS hs, CAST([] AS INT[]) AS fs
        FROM (SELECT DISTINCT frame_id FROM pairs)
        UNION ALL
        SELECT frame_id, place, chosen,
          CASE WHEN chosen THEN list_append(hs, hand_ord) ELSE hs END,
          CASE WHEN chosen THEN list_append(fs, face_ord) ELSE fs END
        FROM (
          SELECT p.frame_id, p.place, p.hand_ord, p.face_ord, c.hs, c.fs,
            NOT list_contains(c.hs, p.hand_ord)
              AND len(list_filter(c.fs, lambda f: f = p.face_ord)) < 2 AS chosen
          FROM choices c JOIN ranked_pairs p ON p.frame_id = c.frame_id AND p.place = c.place + 1)""",
    "matches": """
        SELECT frame_id, CAST(len(hs) - 1 AS INT) AS pick, hand_ord, face_ord, face_id, n_fingers, d2
        FROM choices JOIN ranked_pairs USING (frame_id, place) WHERE chosen""",
    "boxes": """
        SELECT *, CAST(trunc(x + w / 2) AS INT) AS cx, CAST(trunc(y + h / 2) AS INT) AS cy,
          CAST(trunc(least(w, h) * 0.15) AS INT) AS pad,
          row_number() OVER (PARTITION BY camera_id ORDER BY frame, det_ord) AS step
        FROM detections WHERE verified""",
    # Detections of a camera one by one, with the tracks that live after each.
    "steps": """
        SELECT DISTINCT camera_id, CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS opened, CAST(-1 AS BIGINT) AS track_id,
          CAST([] AS STRUCT(n BIGINT, cx INT, cy INT, seen BIGINT)[]) AS live
        FROM boxes
        UNION ALL
        SELECT camera_id, step, opened + CAST(near IS NULL AS BIGINT), coalesce(near.n, opened),
          list_append(list_filter(left_over, lambda t: t.n <> coalesce(near.n, opened)),
                      {'n': coalesce(near.n, opened), 'cx': cx, 'cy': cy, 'seen': frame})
        FROM (
          SELECT *, list_sort(list_filter(
                   list_transform(left_over, lambda t: {'d2': (t.cx - cx) * (t.cx - cx) + (t.cy - cy) * (t.cy - cy), 'n': t.n}),
                   lambda c: c.d2 < 10000))[1] AS near
          FROM (
            SELECT b.camera_id, b.step, b.frame, b.cx, b.cy, s.opened,
              list_filter(s.live, lambda t: b.frame - 1 - t.seen <= 60) AS left_over
            FROM steps s JOIN boxes b ON b.camera_id = s.camera_id AND b.step = s.step + 1))""",
    "starts": """
        SELECT *, CASE WHEN lag(frame) OVER w IS NULL OR frame - lag(frame) OVER w > 61 THEN frame END AS start
        FROM steps JOIN boxes USING (camera_id, step)
        WINDOW w AS (PARTITION BY camera_id ORDER BY step)""",
    "assigned": """
        SELECT *, max(start) OVER (PARTITION BY camera_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS session
        FROM starts""",
    "numbered": """
        SELECT *, track_id - min(track_id) OVER (PARTITION BY camera_id, session) AS n,
          row_number() OVER (PARTITION BY camera_id, track_id ORDER BY step) = 1 AS opening,
          row_number() OVER (PARTITION BY camera_id, track_id, frame ORDER BY step DESC) = 1 AS latest
        FROM assigned""",
    # A box stands for its track until the next one, at most for 60 more frames.
    "shown": """
        SELECT *, coalesce(lead(frame) OVER (PARTITION BY camera_id, track_id ORDER BY frame) - 1, frame + 60) AS until
        FROM numbered WHERE latest""",
    "tracks": """
        SELECT s.camera_id, f.frame, s.session, s.n, s.track_id, s.x, s.y, s.w, s.h, s.cx, s.cy,
          'neutral' AS label, s.frame AS last_seen_frame,
          f.frame = min(s.frame) OVER (PARTITION BY s.camera_id, s.track_id) AS ask
        FROM shown s JOIN camera_frames f
          ON f.camera_id = s.camera_id AND f.frame BETWEEN s.frame AND least(s.until, s.frame + 60)""",
    "person_tracks": "SELECT DISTINCT id % 5 AS camera_id, id AS track_id, frame FROM people",
    "label_results": """
        SELECT CAST(user_id AS INT) % 5 AS camera_id, CAST(user_id AS INT) AS track_id, event_id // 4 AS frame,
          CASE WHEN k = 98 AND event_type = 'error' THEN 'not_face' WHEN k % 7 = 0 THEN event_type END AS label
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "analysis_states": """
        SELECT event_id, event_id // 4 AS frame, k % 2 = 0 AS busy,
          CASE WHEN k >= 5 THEN event_id // 4 - k END AS last_analyzed
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "camera_hands": """
        SELECT user_id % 5 AS camera_id, event_id // 8 + event_id // 500 * 100 AS frame, CAST(event_id % 8 AS INT) AS hand_ord,
          CAST(event_id % 6 AS INT) AS n_fingers, CAST((event_id * 37) % 640 AS INT) AS x, CAST((event_id * 91) % 480 AS INT) AS y
        FROM events""",
    "camera_pairs": """
        SELECT t.camera_id, t.frame, hand_ord, n_fingers, track_id,
          row_number() OVER (PARTITION BY t.camera_id, t.frame
            ORDER BY (h.x - cx) * (h.x - cx) + (h.y - cy) * (h.y - cy), hand_ord, track_id) AS place
        FROM tracks t JOIN camera_hands h ON h.camera_id = t.camera_id AND h.frame = t.frame""",
    "camera_choices": """
        SELECT DISTINCT camera_id, frame, CAST(0 AS BIGINT) AS place, false AS chosen,
          CAST([] AS INT[]) AS hs, CAST([] AS BIGINT[]) AS fs
        FROM camera_pairs
        UNION ALL
        SELECT camera_id, frame, place, chosen,
          CASE WHEN chosen THEN list_append(hs, hand_ord) ELSE hs END,
          CASE WHEN chosen THEN list_append(fs, track_id) ELSE fs END
        FROM (
          SELECT p.*, c.hs, c.fs,
            NOT list_contains(c.hs, p.hand_ord) AND len(list_filter(c.fs, lambda f: f = p.track_id)) < 2 AS chosen
          FROM camera_choices c JOIN camera_pairs p
            ON p.camera_id = c.camera_id AND p.frame = c.frame AND p.place = c.place + 1)""",
    "camera_fingers": """
        SELECT camera_id, frame, track_id, string_agg(CAST(n_fingers AS VARCHAR), ',' ORDER BY place) AS fingers
        FROM camera_choices JOIN camera_pairs USING (camera_id, frame, place) WHERE chosen
        GROUP BY camera_id, frame, track_id""",
    # Results of the requests of tracks without results, and a second one for each.
    "told": f"""
        SELECT camera_id, session, n, frame + 3 + (frame + n) % 40 AS frame, {_TOLD.format('session + n')} FROM numbered WHERE opening
        UNION ALL
        SELECT camera_id, session, n, frame + 50 + (frame + n) % 20, {_TOLD.format('session + n + 3')} FROM numbered WHERE opening""",
    "actions": """
        SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY frame, kind, ord, session, n, label NULLS FIRST) AS step
        FROM (
          SELECT camera_id, frame, 0 AS kind, 0 AS ord, session, n, label, 0 AS x, 0 AS y, 0 AS w, 0 AS h, 0 AS cx, 0 AS cy, 0 AS pad FROM told
          UNION ALL
          SELECT camera_id, frame, 1, det_ord, session, 0, NULL, x, y, w, h, cx, cy, pad FROM assigned)""",
    # Results and detections of a camera one by one, with the tracks that live after each.
    "labelled": """
        SELECT DISTINCT camera_id, CAST(0 AS BIGINT) AS step, CAST(-1 AS BIGINT) AS frame, CAST(-1 AS BIGINT) AS session,
          CAST(0 AS BIGINT) AS opened,
          CAST([] AS STRUCT(session BIGINT, n BIGINT, x INT, y INT, w INT, h INT, cx INT, cy INT, pad INT, seen BIGINT,
                            label VARCHAR, busy BOOLEAN, asked BIGINT, analyzed BIGINT)[]) AS live
        FROM actions
        UNION ALL
        SELECT camera_id, step, frame, CASE WHEN kind = 1 THEN a_session ELSE session END,
          CASE WHEN kind = 1 AND near IS NULL THEN next_n + 1 WHEN kind = 1 THEN next_n ELSE opened END,
          CASE WHEN kind = 0 THEN list_transform(
                 list_filter(left_over, lambda t: NOT (t.session = a_session AND t.n = a_n AND coalesce(a_label, '') = 'not_face')),
                 lambda t: {'session': t.session, 'n': t.n, 'x': t.x, 'y': t.y, 'w': t.w, 'h': t.h, 'cx': t.cx, 'cy': t.cy, 'pad': t.pad,
                   'seen': t.seen,
                   'label': CASE WHEN t.session = a_session AND t.n = a_n THEN coalesce(a_label, t.label) ELSE t.label END,
                   'busy': t.busy AND NOT (t.session = a_session AND t.n = a_n), 'asked': t.asked,
                   'analyzed': CASE WHEN t.session = a_session AND t.n = a_n AND a_label IS NOT NULL THEN t.asked ELSE t.analyzed END})
               WHEN near IS NULL THEN list_append(left_over,
                 {'session': a_session, 'n': next_n, 'x': x, 'y': y, 'w': w, 'h': h, 'cx': cx, 'cy': cy, 'pad': pad, 'seen': frame,
                  'label': 'neutral', 'busy': true, 'asked': frame, 'analyzed': CAST(NULL AS BIGINT)})
               ELSE list_transform(left_over, lambda t: CASE WHEN t.n <> near.n THEN t ELSE
                 {'session': t.session, 'n': t.n, 'x': x, 'y': y, 'w': w, 'h': h, 'cx': cx, 'cy': cy, 'pad': pad, 'seen': frame,
                  'label': t.label, 'busy': t.busy OR t.analyzed IS NULL OR frame - t.analyzed >= 30,
                  'asked': CASE WHEN NOT t.busy AND (t.analyzed IS NULL OR frame - t.analyzed >= 30) THEN frame ELSE t.asked END,
                  'analyzed': t.analyzed} END) END
        FROM (
          SELECT *, CASE WHEN a_session = session THEN opened ELSE 0 END AS next_n,
            CASE WHEN kind = 1 THEN list_sort(list_filter(
                   list_transform(left_over, lambda t: {'d2': (t.cx - cx) * (t.cx - cx) + (t.cy - cy) * (t.cy - cy), 'n': t.n}),
                   lambda c: c.d2 < 10000))[1] END AS near
          FROM (
            SELECT a.camera_id, a.step, a.frame, a.kind, a.session AS a_session, a.n AS a_n, a.label AS a_label,
              a.x, a.y, a.w, a.h, a.cx, a.cy, a.pad, s.session, s.opened,
              list_filter(s.live, lambda t: a.frame - 1 - t.seen <= 60) AS left_over
            FROM labelled s JOIN actions a ON a.camera_id = s.camera_id AND a.step = s.step + 1))""",
    "after_frames": """
        SELECT camera_id, frame, live, coalesce(lead(frame) OVER (PARTITION BY camera_id ORDER BY frame) - 1, frame + 60) AS until
        FROM (SELECT * FROM labelled WHERE step > 0
              QUALIFY row_number() OVER (PARTITION BY camera_id, frame ORDER BY step DESC) = 1)""",
    "told_rows": """
        SELECT f.camera_id, f.frame, unnest(a.live) AS t
        FROM camera_frames f JOIN after_frames a ON a.camera_id = f.camera_id AND f.frame BETWEEN a.frame AND a.until""",
    "told_tracks": """
        SELECT r.camera_id, r.frame, t.session, t.n, before.opened + t.n AS track_id, t.x, t.y, t.w, t.h, t.cx, t.cy, t.label,
          t.seen AS last_seen_frame, t.asked = r.frame AS ask, t.pad
        FROM told_rows r JOIN (
          SELECT camera_id, session, CAST(coalesce(sum(opened) OVER (
            PARTITION BY camera_id ORDER BY session ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS opened
          FROM (SELECT camera_id, t.session AS session, max(t.n) + 1 AS opened FROM told_rows GROUP BY camera_id, t.session)
        ) before ON before.camera_id = r.camera_id AND before.session = t.session
        WHERE r.frame - t.seen <= 60""",
    "measured_hands": f"""
        SELECT user_id % 5 AS camera_id, event_id // 8 + event_id // 500 * 100 AS frame, CAST(event_id % 8 AS INT) AS hand_ord,
          {_FINGERS} AS n_fingers, {_ANCHOR_X} AS x, {_ANCHOR_Y} AS y
        FROM landmarks JOIN events ON hand_key = event_id""",
    "smoothed_hands": """
        SELECT camera_id, frame, hand_ord, x, y, CAST(round_even(avg(n_fingers) OVER (
          PARTITION BY camera_id, frame, round_even(x / 40, 0), round_even(y / 40, 0)
          ORDER BY hand_ord ROWS 4 PRECEDING), 0) AS INT) AS n_fingers FROM measured_hands""",
    # Frames that a camera's stream lists, except the last one, which stays open.
    "closed_frames": """
        SELECT DISTINCT camera_id, frame FROM detections
        QUALIFY frame < max(frame) OVER (PARTITION BY camera_id)""",
    "camera_messages": """
        SELECT camera_id, frame,
          string_agg('{"id":' || track_id || ',"emotion":"' || upper(label) || '","fingers":['
                     || coalesce(fingers, '') || ']}', ',' ORDER BY track_id) AS people
        FROM tracks LEFT JOIN camera_fingers USING (camera_id, frame, track_id) GROUP BY camera_id, frame""",
}


def _sql(select: str, *names: str, **other: str) -> str:
    """``select`` over the named views; ``other`` gives the text of a view instead."""
    views = ", ".join(f"{name} AS ({other.get(name, _VIEWS.get(name, '')).strip()})" for name in names)
    return f"WITH RECURSIVE {views} {select}" if names else select


_WAVES = ("wave_people", "flags", "lengths", "wave_events")
_TENTH = ("people", "occurrences", "tenth")
_MATCH = ("hands", "faces", "pairs", "ranked_pairs", "choices", "matches")
_TRACKS = ("detections", "camera_frames", "boxes", "steps", "starts", "assigned", "numbered", "shown", "tracks")

_TOLD_TRACKS = (*_TRACKS[:-2], "told", "actions", "labelled", "after_frames", "told_rows", "told_tracks")
_MESSAGES = ("camera_pairs", "camera_choices", "camera_fingers", "camera_messages")
_LANDMARKS = {"camera_hands": "SELECT * FROM smoothed_hands"}

_PEOPLE_TEXT = "frame, pos, id, emotion, array_to_string(fingers, ',') AS fingers"


def oracle_sql() -> dict[str, str]:
    corpus = _corpus.oracle_sql() if _corpus else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        corpus["pipeline"] = _pipeline.ORACLE_SQL
    return _observation_sql() | corpus


def _observation_sql() -> dict[str, str]:
    nth = _sql("SELECT * FROM tenth", *_TENTH)
    wave = _sql("SELECT * FROM wave_events", *_WAVES)
    flawed = """(SELECT frame FROM people WHERE emotion = 'ANGRY')"""
    found = {
        "decode_people": _sql(f"SELECT {_PEOPLE_TEXT} FROM people", "people"),
        "accepted_people": _sql(f"SELECT {_PEOPLE_TEXT} FROM people WHERE frame NOT IN {flawed}", "people"),
        "rejected_messages": _sql(
            f"""SELECT key, replace(value, 'ANGRY', 'UNKNOWN') AS value, 'malformed person' AS error
                FROM messages WHERE CAST(key AS BIGINT) IN {flawed}""",
            "people",
            "messages",
        ),
        "rejected_fingers": _sql(
            "SELECT DISTINCT CAST(frame AS VARCHAR) AS key, 'malformed person' AS error FROM people WHERE id % 10 = 3", "people"
        ),
        "assemble_messages": _sql("SELECT * FROM messages", "people", "messages"),
        "encode_events": _sql("""SELECT '{"id":' || id || ',"emotion":"' || emotion || '"}' AS value FROM tenth""", *_TENTH),
        "encode_waves": _sql("""SELECT '{"id":' || id || '}' AS value FROM wave_events""", *_WAVES),
        "padded_lines": "SELECT CASE WHEN length(props) < 12 THEN rpad(props, 12, ' ') ELSE props END AS line FROM events",
        "occurrence_number": _sql("SELECT * FROM occurrences", "people", "occurrences"),
        "nth_occurrence": nth,
        "unique_emotion_counts": _sql("SELECT emotion, count(*) AS cnt FROM tenth GROUP BY emotion", *_TENTH),
        "unique_emotions_job": _sql("SELECT id, emotion FROM tenth", *_TENTH),
        "waves_job": _sql("SELECT id FROM wave_events", *_WAVES),
        "streak_lengths": _sql("SELECT * FROM lengths", *_WAVES[:3]),
        "joint_streak": wave,
        "people_per_frame": _sql("SELECT frame, count(*) AS n_people FROM people GROUP BY frame", "people"),
        "finger_count": _sql(
            f"SELECT hand_key, {_FINGERS} AS n_fingers FROM landmarks",
            "landmarks",
        ),
        "hand_anchor": _sql(
            f"SELECT hand_key, {_ANCHOR_X} AS x, {_ANCHOR_Y} AS y FROM landmarks",
            "landmarks",
        ),
        "grid_cell": _sql(
            """SELECT camera_id, frame, hand_ord, CAST(round_even(x / 40, 0) AS INT) AS cell_x,
                 CAST(round_even(y / 40, 0) AS INT) AS cell_y FROM camera_hands""",
            "camera_hands",
        ),
        "smooth_fingers": _sql(
            """SELECT camera_id, frame, hand_ord, CAST(round_even(avg(n_fingers) OVER (
                 PARTITION BY camera_id, frame, round_even(x / 40, 0), round_even(y / 40, 0)
                 ORDER BY hand_ord ROWS 4 PRECEDING), 0) AS INT) AS smoothed FROM camera_hands""",
            "camera_hands",
        ),
        "box_geometry": _sql(
            """SELECT camera_id, frame, det_ord, cx, cy, x0, y0, x1, y1,
                 greatest(x1 - x0, 0) * greatest(y1 - y0, 0) AS area,
                 greatest(x - pad, 0) AS pad_x0, greatest(y - pad, 0) AS pad_y0,
                 least(x + w + pad, 640) AS pad_x1, least(y + h + pad, 480) AS pad_y1
               FROM (SELECT *, CAST(trunc(x + w / 2) AS INT) AS cx, CAST(trunc(y + h / 2) AS INT) AS cy,
                       greatest(x, 0) AS x0, greatest(y, 0) AS y0, least(x + w, 640) AS x1, least(y + h, 480) AS y1,
                       CAST(trunc(least(w, h) * 0.15) AS INT) AS pad FROM detections)""",
            "detections",
        ),
        "visible_detections": _sql(
            """SELECT camera_id, frame, det_ord, x, y, w, h FROM detections
               WHERE least(x + w, 400) > greatest(x, 0) AND least(y + h, 300) > greatest(y, 0)""",
            "detections",
        ),
        "verified_detections": _sql("SELECT * EXCLUDE (verified) FROM detections WHERE verified", "detections"),
        "dominant_label": """
            SELECT event_id, label, upper(label) AS emotion FROM (
              SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'not_face' WHEN a >= h AND a >= s THEN 'angry'
                                    WHEN h >= s THEN 'happy' ELSE 'sad' END AS label
              FROM (SELECT event_id, event_id * 7 % 50 AS a, event_id * 11 % 50 AS h, event_id * 13 % 50 AS s FROM events))""",
        "pair_distance": _sql("SELECT * FROM pairs", "hands", "faces", "pairs"),
        "nearest_face": _sql(
            """SELECT frame_id, hand_ord, n_fingers, face_ord, face_id, d2 FROM (
                 SELECT *, row_number() OVER (PARTITION BY frame_id, hand_ord ORDER BY d2, face_ord) AS place FROM pairs)
               WHERE place = 1""",
            "hands",
            "faces",
            "pairs",
        ),
        "greedy_match": _sql(
            "SELECT frame_id, pick, hand_ord, CAST(face_ord AS BIGINT) AS face_ord, face_id, n_fingers, d2 FROM matches", *_MATCH
        ),
        "fingers_by_face": _sql(
            """SELECT frame_id, face_ord, f.face_id,
                 coalesce(string_agg(CAST(n_fingers AS VARCHAR), ',' ORDER BY pick), '') AS fingers
               FROM faces f LEFT JOIN matches m USING (frame_id, face_ord) GROUP BY frame_id, face_ord, f.face_id""",
            *_MATCH,
        ),
        "label_asof": _sql(
            """SELECT camera_id, track_id, frame, coalesce(
                 (SELECT r.label FROM label_results r
                  WHERE r.camera_id = t.camera_id AND r.track_id = t.track_id AND r.frame <= t.frame AND r.label IS NOT NULL
                  ORDER BY r.frame DESC, r.label DESC LIMIT 1), 'neutral') AS label
               FROM person_tracks t
               WHERE NOT EXISTS (SELECT 1 FROM label_results r
                  WHERE r.camera_id = t.camera_id AND r.track_id = t.track_id AND r.frame <= t.frame AND r.label = 'not_face')""",
            "people",
            "person_tracks",
            "label_results",
        ),
        "reanalysis_due": _sql(
            """SELECT *, NOT busy AND (last_analyzed IS NULL OR frame - last_analyzed >= 30) AS due
               FROM analysis_states""",
            "analysis_states",
        ),
        "track_faces": _sql(f"SELECT {', '.join(_TRACK_COLUMNS)} FROM tracks", *_TRACKS),
        "track_faces_crowded": _sql(
            f"SELECT {', '.join(_TRACK_COLUMNS)} FROM tracks",
            "crowded",
            *_TRACKS,
            detections="SELECT * FROM crowded",
            camera_frames="SELECT DISTINCT camera_id, frame FROM crowded",
        ),
        "analysis_requests": _sql(
            """SELECT camera_id, frame, session, n, greatest(x - pad, 0) AS x0, greatest(y - pad, 0) AS y0,
                 least(x + w + pad, 640) AS x1, least(y + h + pad, 480) AS y1
               FROM numbered WHERE opening""",
            *_TRACKS[:-2],
        ),
        "track_labels": _sql(f"SELECT {', '.join(_TRACK_COLUMNS)} FROM told_tracks", *_TOLD_TRACKS),
        "repeated_requests": _sql(
            """SELECT camera_id, frame, t.session, t.n, greatest(t.x - t.pad, 0) AS x0, greatest(t.y - t.pad, 0) AS y0,
                 least(t.x + t.w + t.pad, 640) AS x1, least(t.y + t.h + t.pad, 480) AS y1
               FROM (SELECT camera_id, step, frame, unnest(live) AS t FROM labelled WHERE step > 0) WHERE t.asked = frame
               QUALIFY row_number() OVER (PARTITION BY camera_id, frame, t.session, t.n ORDER BY step) = 1""",
            *_TOLD_TRACKS[:-3],
        ),
        "stream_track_labels": _sql(
            f"SELECT {', '.join(_TRACK_COLUMNS)} FROM told_tracks WHERE frame < (SELECT max(frame) FROM camera_frames)", *_TOLD_TRACKS
        ),
        "landmarks_to_messages": _sql(
            """SELECT camera_id, CAST(frame AS VARCHAR) AS key, '[' || coalesce(people, '') || ']' AS value
               FROM camera_frames LEFT JOIN camera_messages USING (camera_id, frame)""",
            *_TRACKS, "landmarks", "measured_hands", "smoothed_hands", "camera_hands", *_MESSAGES, **_LANDMARKS,
        ),
        "stream_landmarks_to_messages": _sql(
            """SELECT camera_id || ':' || frame AS key, '[' || coalesce(people, '') || ']' AS value
               FROM camera_frames LEFT JOIN camera_messages USING (camera_id, frame)
               WHERE frame < (SELECT max(frame) FROM camera_frames)""",
            *_TRACKS, "landmarks", "measured_hands", "smoothed_hands", "camera_hands", *_MESSAGES, **_LANDMARKS,
        ),
        "recorded_unique_emotions": _sql(
            """SELECT camera_id, CAST(track_id AS INT) AS id, upper(label) AS emotion FROM tracks
               GROUP BY camera_id, track_id, label HAVING count(*) >= 10""",
            *_TRACKS,
        ),
        "stream_recording": _sql(
            """SELECT camera_id || ':' || frame AS key, '[' || coalesce(people, '') || ']' AS value
               FROM closed_frames LEFT JOIN camera_messages USING (camera_id, frame)""",
            *_TRACKS,
            "camera_hands",
            "camera_pairs",
            "camera_choices",
            "camera_fingers",
            "camera_messages",
            "closed_frames",
        ),
        "stream_recording_to_the_end": _sql(
            """SELECT camera_id || ':' || frame AS key, '[' || coalesce(people, '') || ']' AS value
               FROM camera_frames LEFT JOIN camera_messages USING (camera_id, frame)""",
            *_TRACKS,
            "camera_hands",
            *_MESSAGES,
        ),
        "recorded_messages": _sql(
            """SELECT camera_id, CAST(frame AS VARCHAR) AS key, '[' || coalesce(people, '') || ']' AS value
               FROM camera_frames LEFT JOIN camera_messages USING (camera_id, frame)""",
            *_TRACKS,
            "camera_hands",
            "camera_pairs",
            "camera_choices",
            "camera_fingers",
            "camera_messages",
        ),
        "stream_nth": nth,
        "stream_streak": wave,
        "stream_counts": _sql("SELECT emotion, count(*) AS cnt FROM people GROUP BY emotion", "people"),
        "stream_chain": _sql("SELECT emotion, count(*) AS cnt FROM tenth GROUP BY emotion", *_TENTH),
        "stream_chain_direct": _sql("SELECT emotion, count(*) AS cnt FROM tenth GROUP BY emotion", *_TENTH),
        "stream_counts_topic": _sql("SELECT emotion, count(*) AS cnt FROM tenth GROUP BY emotion", *_TENTH),
        "stream_nth_after_history": nth,
        "stream_streak_after_history": wave,
        "stream_nth_with_ttl": nth,
        "stream_restarted": _sql("""SELECT '{"id":' || id || ',"emotion":"' || emotion || '"}' AS value FROM tenth""", *_TENTH),
        "stream_latest": _sql(
            """SELECT '{"id":' || id || '}' AS value FROM people WHERE frame % 2 = 1 AND emotion = 'HAPPY' AND list_max(fingers) = 5""",
            "people",
        ),
        "stream_skipped_messages": _sql(
            """SELECT count(*) FILTER (NOT broken) AS people, count(DISTINCT frame) AS messages, count(DISTINCT frame) FILTER (broken) AS broken
               FROM (SELECT frame, bool_or(emotion = 'ANGRY') OVER (PARTITION BY frame) AS broken FROM people)""",
            "people",
        ),
        "stream_tail": """
            SELECT CASE WHEN length(props) < 12 THEN rpad(props, 12, ' ') ELSE props END AS line,
              count(*) FILTER (event_id % 5 = 0) OVER () AS skipped
            FROM events QUALIFY event_id % 5 <> 0""",
        "people_per_listed_frame": _sql(
            "SELECT frame, count(*) FILTER (frame % 3 <> 0) AS n_people FROM people GROUP BY frame", "people"
        ),
        "stream_waves_without_keys": _sql(
            "SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY frame, pos) AS n FROM people) WHERE n > 10", "people"
        ),
        "stream_tracks": _sql(
            f"""SELECT {', '.join(_TRACK_COLUMNS)} FROM tracks JOIN closed_frames USING (camera_id, frame)""",
            *_TRACKS,
            "closed_frames",
        ),
    }
    return found | {f"{name}_in_blocks": found[name] for name in ("occurrence_number", "streak_lengths", "label_asof", "track_faces")}
