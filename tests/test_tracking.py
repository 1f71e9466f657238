import random
import time

import pytest
from pyspark.sql import functions as F

from framewise.operators import analysis_requests, label_asof, number_tracks, track_faces, tracker_input
from framewise.operators import units
from framewise.operators.tracking import FRAME, INPUT, with_boxes
from framewise.streaming import drain, start, stream_track_faces
from tests import tracker_sql

DETECTIONS = "camera_id long, frame long, det_ord int, x int, y int, w int, h int"
FRAMES = "camera_id long, frame long"
RESULTS = "camera_id long, session long, n long, frame long, label string"
SHOWN = ["frame", "track_id", "x", "y", "label", "last_seen_frame"]


def _scene(seed, cameras=3, frames=600, pause=0.02):
    """Slowly moving faces, with pauses of every length and frames without detections."""
    rng = random.Random(seed)
    detections = []
    for camera in range(cameras):
        frame = rng.randrange(5)
        while frame < frames:
            for at in range(rng.randrange(4)):
                x = (at * 130 + frame // 3 + rng.randrange(40)) % 600 - 20
                detections.append((camera, frame, at, x, rng.randrange(120), 60 + rng.randrange(30), 60 + rng.randrange(30)))
            frame += rng.choice([58, 60, 61, 62, 63, 90]) if rng.random() < pause else 1
    return detections


def _make(spark, detections, ticks):
    return spark.createDataFrame(ticks, FRAMES), spark.createDataFrame(detections, DETECTIONS)


@pytest.mark.parametrize("span", [None, 10, 1 << 16])
def test_tracks(spark, rows, span):
    detections = _scene(1)
    ticks = [(c, f) for c in range(3) for f in range(700) if f % 5]
    tracks = number_tracks(track_faces(*_make(spark, detections, ticks), span=span))
    sessions = tracks.select("camera_id", "session").distinct().count()
    assert sessions > 6
    columns = ["camera_id", "frame", "session", "n", "track_id", "x", "y", "w", "h", "cx", "cy", "last_seen_frame", "ask"]
    assert sorted(rows(tracks, *columns)) == tracker_sql.tracks(detections, ticks, columns)


def test_kept_for_sixty_frames_and_then_dropped(spark, rows):
    for gap, same in ((60, True), (61, True), (62, False)):
        detections = [(1, 10, 0, 0, 0, 60, 60), (1, 10 + gap, 0, 0, 0, 60, 60)]
        ticks = [(1, f) for f in range(1, 200)]
        tracks = number_tracks(track_faces(*_make(spark, detections, ticks)))
        assert tracks.where(f"frame = {10 + gap}").count() == 1
        assert (tracks.select("track_id").distinct().count() == 1) == same
        assert rows(tracks.where("frame >= 70 and track_id = 0").select(F.max("frame"))) == [((10 + gap + 60) if same else 70,)]


def test_match_distance_and_two_boxes_on_one_track(spark, rows):
    # 99 px away is the same face, 100 px is not; of two boxes on one face the last one stays.
    detections = [(1, 1, 0, 0, 0, 60, 60), (1, 2, 0, 99, 0, 60, 60), (2, 1, 0, 0, 0, 60, 60), (2, 2, 0, 100, 0, 60, 60)]
    detections += [(3, 1, 0, 0, 0, 60, 60), (3, 2, 0, 10, 0, 60, 60), (3, 2, 1, 20, 0, 60, 60)]
    tracks = track_faces(*_make(spark, detections, [(9, 1)]))
    assert rows(tracks.where("frame = 2"), "camera_id", "n", "x") == [(1, 0, 99), (2, 0, 0), (2, 1, 100), (3, 0, 20)]


def test_nearest_first_created_wins_ties(spark, rows):
    detections = [(1, 1, 0, 0, 0, 60, 60), (1, 1, 1, 180, 0, 60, 60), (1, 2, 0, 90, 0, 60, 60)]
    tracks = track_faces(*_make(spark, detections, [(1, 1)]))
    assert rows(tracks.where("frame = 2"), "n", "x", "last_seen_frame") == [(0, 90, 2), (1, 180, 1)]


def test_requests_carry_the_padded_box(spark, rows):
    detections = [(1, 1, 0, 5, 100, 70, 60), (1, 2, 0, 7, 100, 70, 60)]
    tracks = track_faces(*_make(spark, detections, [(1, 1)]))
    assert rows(analysis_requests(tracks)) == [(1, 1, 1, 0, 0, 91, 84, 169)]


def _results(spark, tracks, seed):
    """For each request of a first run without results, and some that are about nothing."""
    rng = random.Random(seed)
    out = []
    for r in analysis_requests(tracks).orderBy("camera_id", "session", "n").collect():
        label = rng.choice(["happy", "sad", "unknown", None, "not_face"])
        out.append((r.camera_id, r.session, r.n, r.frame + rng.randrange(1, 40), label))
    return out


def _one_face(spark, results, frames=80):
    """A face that stands still, in every frame of camera 1, with label results."""
    detections = [(1, f, 0, 0, 0, 60, 60) for f in range(1, frames + 1)]
    boxes, told = spark.createDataFrame(detections, DETECTIONS), spark.createDataFrame(results, RESULTS)
    return track_faces(boxes.select("camera_id", "frame"), boxes, told).cache()


def _spans(tracks):
    """(n, label, first frame, last frame), and the frames with a request."""
    spans = tracks.groupBy("n", "label").agg(F.min("frame"), F.max("frame")).collect()
    asked = tracks.where("ask").select("frame", "n").collect()
    return sorted(tuple(r) for r in spans), sorted(tuple(r) for r in asked)


def test_label_counts_from_its_frame_and_is_asked_for_again(spark):
    # Asked for at 1; the answer comes at 5, the next question 30 frames after the first, and it is not answered.
    spans, asked = _spans(_one_face(spark, [(1, 1, 0, 5, "happy")]))
    assert spans == [(0, "happy", 5, 80), (0, "neutral", 1, 4)]
    assert asked == [(1, 0), (31, 0)]
    spans, asked = _spans(_one_face(spark, [(1, 1, 0, 5, "happy"), (1, 1, 0, 33, "sad")]))
    assert spans == [(0, "happy", 5, 32), (0, "neutral", 1, 4), (0, "sad", 33, 80)]
    assert asked == [(1, 0), (31, 0), (61, 0)]
    # An answer that comes late puts off nothing: the question was 40 frames ago.
    assert _spans(_one_face(spark, [(1, 1, 0, 41, "happy")]))[1] == [(1, 0), (41, 0)]


def test_failed_analysis_is_asked_for_at_once(spark):
    spans, asked = _spans(_one_face(spark, [(1, 1, 0, 5, None), (1, 1, 0, 9, "sad")]))
    assert spans == [(0, "neutral", 1, 8), (0, "sad", 9, 80)]
    assert asked == [(1, 0), (5, 0), (35, 0)]


def test_what_is_no_face_is_dropped_and_found_anew(spark):
    spans, asked = _spans(_one_face(spark, [(1, 1, 0, 5, "not_face")]))
    assert spans == [(0, "neutral", 1, 4), (1, "neutral", 5, 80)]
    assert asked == [(1, 0), (5, 1)]


def test_results_about_nothing_change_nothing(spark):
    spans, asked = _spans(_one_face(spark, [(1, 1, 7, 5, "happy"), (1, 9, 0, 5, "happy"), (2, 1, 0, 5, "happy")]))
    assert spans == [(0, "neutral", 1, 80)] and asked == [(1, 0)]


@pytest.mark.parametrize("cuts", [1, 3])
def test_stream_equals_table(spark, rows, feed, cuts):
    detections = _scene(4, cameras=3, frames=300)
    ticks = [(c, f) for c in range(3) for f in range(400)]
    frames, boxes = _make(spark, detections, ticks)
    results = spark.createDataFrame(_results(spark, track_faces(frames, boxes), 5), RESULTS)
    table = number_tracks(track_faces(frames, boxes, results))
    source = feed(INPUT)
    steps = [tuple(r) for r in tracker_input(frames, boxes, results).collect()]
    random.Random(6).shuffle(steps)
    for part in range(cuts):
        source.add([s for s in steps if 400 * part // cuts <= s[1] < 400 * (part + 1) // cuts or (part == cuts - 1 and s[1] >= 400)])
    stream = drain(stream_track_faces(source.stream()), "tracks")
    assert rows(stream, *table.columns) == rows(table)


def test_stream_shows_a_repeated_frame_once(spark, rows, feed):
    frames, boxes = _make(spark, [(1, 3, 0, 0, 0, 60, 60)], [(1, 3), (1, 3), (1, 4)])
    steps = [tuple(r) for r in tracker_input(frames, boxes).collect()]
    source = feed(INPUT)
    source.add(steps)
    source.add([s for s in steps if s[2] == FRAME])
    assert rows(drain(stream_track_faces(source.stream()), "tracks"), "frame", "n") == [(3, 0), (4, 0)]


def test_stream_holds_a_frame_until_the_next_one(spark, rows, feed):
    """A frame's rows in three micro-batches, the frame's own row first."""
    detections = [(1, 3, 0, 0, 0, 60, 60), (1, 3, 1, 300, 0, 60, 60), (1, 4, 0, 5, 0, 60, 60)]
    frames, boxes = _make(spark, detections, [(1, 3), (1, 4), (1, 5)])
    hands = spark.createDataFrame([(1, 3, 0, 4, 10, 20), (1, 5, 0, 1, 0, 0)], "camera_id long, frame long, hand_ord int, n_fingers int, x int, y int")
    steps = sorted((tuple(r) for r in tracker_input(frames, boxes, hands=hands).collect()), key=lambda s: (s[1], -s[2]))
    source = feed(INPUT)
    for part in ([*steps[:2]], [steps[2]], steps[3:]):
        source.add(part)
    tracks = drain(stream_track_faces(source.stream(), whole_frames=True), "tracks")
    # Frame 5 is still open. Hands have their place in ``session`` and their fingers in ``w``.
    assert rows(tracks, "frame", "n", "x") == [(3, -2, 10), (3, 0, 0), (3, 1, 300), (4, 0, 5), (4, 1, 300)]
    assert rows(tracks.where("n = -2"), "session", "w", "y") == [(0, 4, 20)]


def test_stream_marks_empty_frames(spark, rows, feed):
    frames, boxes = _make(spark, [(1, 3, 0, 0, 0, 60, 60)], [(1, f) for f in (1, 2, 3, 63, 64)])
    source = feed(INPUT)
    source.add([tuple(r) for r in tracker_input(frames, boxes).collect()])
    stream = drain(stream_track_faces(source.stream(), empty_frames=True), "tracks")
    assert rows(stream, "frame", "n") == [(1, -1), (2, -1), (3, 0), (63, 0), (64, -1)]


@pytest.mark.parametrize("span", [None, 4, 1 << 16])
def test_label_asof(spark, rows, span):
    rng = random.Random(7)
    tracks = [(c, t, f) for c in range(2) for t in range(3) for f in range(80)]
    results = [
        (c, t, rng.randrange(90), rng.choice(["happy", "sad", "fear", None, *(["not_face"] if t == 2 else [])]))
        for c in range(2)
        for t in range(3)
        for _ in range(9)
    ]
    expected = []
    for c, t, f in tracks:
        label, gone = "neutral", False
        for _, _, _, late in sorted((r for r in results if r[:2] == (c, t) and r[2] <= f), key=lambda r: (r[2], r[3] or "")):
            label = late or label
            gone |= late == "not_face"
        if not gone:
            expected.append((c, t, f, label))
    got = label_asof(
        spark.createDataFrame(tracks, "camera_id long, track_id long, frame long"),
        spark.createDataFrame(results, "camera_id long, track_id long, frame long, label string"),
        span=span,
    )
    assert sorted(rows(got)) == sorted(expected)
    assert len(expected) < len(tracks)


def test_units_of_one_camera_are_tracked_side_by_side(spark, rows):
    """Four places of one camera that never pauses: units that meet nowhere, and the rows of one long step by step run."""
    rng = random.Random(3)
    detections = [
        (1, f, at, 400 * place + rng.randrange(90) - 20, rng.randrange(90), 60, 60)
        for f in range(500)
        for at, place in enumerate(rng.sample(range(4), rng.randrange(1, 4)))
    ]
    frames, boxes = _make(spark, detections, [(1, f) for f in range(560)])
    steps = with_boxes(tracker_input(detections=boxes), 2000, 480).withColumn("at", F.col("frame"))
    for blocks in (units.BLOCK_SLABS, 2):
        before, units.BLOCK_SLABS = units.BLOCK_SLABS, blocks
        try:
            parted = units.with_units(steps)
            busy = parted.groupBy("unit").agg(F.count("*"), F.count_distinct(F.floor((F.col("x") + 50) / 400))).collect()
            assert len(busy) == 4 and {r[2] for r in busy} == {1}
            tracks = number_tracks(track_faces(frames, boxes, width=2000))
            columns = ["camera_id", "frame", "session", "n", "track_id", "x", "y", "w", "h", "cx", "cy", "last_seen_frame"]
            assert sorted(rows(tracks, *columns)) == tracker_sql.tracks(detections, [(1, f) for f in range(560)], columns)
        finally:
            units.BLOCK_SLABS = before


def test_results_reach_units_and_whole_sessions(spark, rows):
    """Places of one camera with a ``not_face`` in some sessions only, against the one-group form on a stream."""
    detections = [
        (1, f + 80 * (f // 60), at, 400 * at + (f % 7) * 5, 0, 60, 60) for f in range(240) for at in range(3) if (f + at) % 5
    ]
    frames, boxes = _make(spark, detections, [(1, f) for f in range(640)])
    first = track_faces(frames, boxes, width=2000)
    told = []
    for i, r in enumerate(analysis_requests(first).orderBy("session", "n").collect()):
        told.append((1, r.session, r.n, r.frame + 4 + i, ["happy", "not_face", "sad"][i % 3] if r.session % 3 else "fear"))
        # About tracks that only exist since another one was taken out.
        told.append((1, r.session, r.n + 3, r.frame + 30 + i, "angry"))
    results = spark.createDataFrame(told, RESULTS)
    table = number_tracks(track_faces(frames, boxes, results, width=2000))
    steps = tracker_input(frames, boxes, results)
    folder = spark.conf.get("spark.checkpoint.dir") + f"/steps-{id(table)}"
    steps.coalesce(1).write.parquet(folder)
    stream = drain(stream_track_faces(spark.readStream.schema(steps.schema).parquet(folder), 2000), "tracks")
    assert rows(table) == rows(stream, *table.columns)
    labels = {r.label for r in table.select("label").distinct().collect()}
    assert {"happy", "fear", "angry", "neutral"} <= labels


def test_open_frame_closes_after_a_silence(spark, rows, feed, tmp_path):
    frames, boxes = _make(spark, [(c, f, 0, 0, 0, 60, 60) for c in (1, 2) for f in (3, 4)], [(c, f) for c in (1, 2) for f in (3, 4)])
    source = feed(INPUT)
    source.add([tuple(r) for r in tracker_input(frames, boxes).collect()])
    stream = stream_track_faces(source.stream(), whole_frames=True, silence_ms=1500)
    writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "c"))
    query = start(writer.trigger(processingTime="200 milliseconds"), stream)
    try:
        until = time.time() + 60
        read = lambda: spark.read.schema(stream.schema).parquet(str(tmp_path / "rows"))
        while time.time() < until and not ((tmp_path / "rows").exists() and read().count() >= 4):
            assert query.isActive, query.exception()
            time.sleep(0.3)
    finally:
        query.stop()
    assert rows(read(), "camera_id", "frame") == [(c, f) for c in (1, 2) for f in (3, 4)]
