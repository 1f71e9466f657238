"""What a micro-batch takes in, and what its tasks hold, does not grow with the table."""

import __spark_entry__ as driver
from framewise.operators import analysis_requests, follow_faces, track_faces
from framewise.operators.tracking import HAND, HAND_ROW
from framewise.plans import views as v
from framewise.settings import clear_run_dirs
from framewise.sources import FileTopics
from framewise.streaming import tracking
from framewise.streaming.tracking import _ROW, FaceTracker
from tests.test_properties import Handle

import pandas as pd
from pyspark.sql import functions as F


def _batches(stream, folder):
    sizes = []

    def look(batch, number):
        sizes.append(batch.agg(F.count("*"), F.min("at"), F.max("at")).first())

    query = stream.writeStream.foreachBatch(look).trigger(availableNow=True).option("checkpointLocation", str(folder))
    query.start().awaitTermination()
    return [tuple(s) for s in sizes if s[0]]


def test_a_larger_table_has_more_batches(spark, tmp_path):
    df = spark.range(1200).select((F.col("id") * 7 % 1200).alias("at"))
    few = _batches(v.in_files(df, "at"), tmp_path / "few")
    many = _batches(v.in_files(df, "at", most=200), tmp_path / "many")
    assert len(few) == 4 and len(many) == 6
    for found in (few, many):
        assert sum(s[0] for s in found) == 1200
        # One after the other, in order.
        assert all(a[2] < b[1] for a, b in zip(found, found[1:]))
    assert max(s[0] for s in many) < 300


def test_hands_come_out_in_parts(monkeypatch):
    monkeypatch.setattr(tracking, "_PART", 10)
    hands = pd.DataFrame([{c: 0 for c in _ROW} | {"frame": f, "kind": HAND, "ord": 1, "label": None} for f in range(95)])
    tracker = FaceTracker(False, None, False, None)
    tracker.init(Handle())
    found = list(tracker.handleInputRows((1,), iter([hands]), None))
    assert [len(pdf) for pdf in found] == [10] * 9 + [5]
    assert sorted(f for pdf in found for (f,) in pdf["frames"]) == list(range(95))
    assert all((pdf["n"] == HAND_ROW).all() for pdf in found)


def test_counts_topic_has_as_many_files_for_any_table(spark, tmp_path, monkeypatch):
    made = []

    class Kept(FileTopics):
        def write(self, messages, topic, batch=None, writer=""):
            made.append(messages.rdd.getNumPartitions())
            super().write(messages, topic, batch, writer)

    monkeypatch.setattr(driver, "FileTopics", Kept)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert driver.stream_counts_topic(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        clear_run_dirs(spark)
    assert made[:3] == [4, 4, 4]


def test_tracks_are_followed_once_for_requests_and_answers(spark, rows):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    frames, found = v.camera_frames(ev), v.detections(ev).where("verified")
    followed = follow_faces(found)
    shown = track_faces(frames, found, followed=followed)
    assert rows(shown) == rows(track_faces(frames, found))
    results = v.request_results(analysis_requests(shown))
    assert rows(track_faces(frames, found, results, followed=followed)) == rows(track_faces(frames, found, results))
