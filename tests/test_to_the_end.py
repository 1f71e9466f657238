"""A recording to the end gives all frames or fails."""

from types import SimpleNamespace

import __spark_entry__ as driver
from framewise.plans import jobs
from framewise.settings import clear_run_dirs
from framewise.streaming import run_until_quiet

import pytest
from pyspark.sql import functions as F


class Query:
    """Reports one micro-batch after the other: (seconds, rows); then it has ended, or never says more."""

    def __init__(self, batches, ends=False):
        self.batches, self.ends, self.at, self.stopped = batches, ends, -1, False

    def awaitTermination(self, timeout):
        self.at += 1
        return self.ends and self.at >= len(self.batches)

    @property
    def lastProgress(self):
        at = min(self.at, len(self.batches) - 1)
        second, n = self.batches[at]
        source = SimpleNamespace(startOffset=f"{at - 1 if n else at}", endOffset=f"{at}")
        return SimpleNamespace(batchId=at, numInputRows=n, sources=[source], timestamp=f"2024-01-01T00:00:{second:02d}.000Z")

    def stop(self):
        self.stopped = True


def test_it_waits_for_silence_after_the_last_rows():
    query = Query([(0, 5), (1, 0), (20, 5), (21, 0), (28, 0), (29, 0), (30, 0)])
    run_until_quiet(query, 8_000)
    assert query.stopped and query.at == 5


def test_a_query_that_ends_or_hangs_is_an_error():
    ended, hanging = Query([(0, 5)], ends=True), Query([(0, 5)])
    with pytest.raises(RuntimeError, match="ended"):
        run_until_quiet(ended, 8_000)
    with pytest.raises(TimeoutError, match="batch 0"):
        run_until_quiet(hanging, 8_000, stall_s=0)
    assert ended.stopped and hanging.stopped


def _events(spark, folder):
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("view", "click", "error", "signup")]), (F.col("id") % 4 + 1).cast("int"))
    rows = spark.range(160).select(
        F.col("id").alias("event_id"),
        (F.col("id") * 7 % 11).alias("user_id"),
        kinds.alias("event_type"),
        (F.col("id") % 120).cast("double").alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_frames_that_are_missing_are_an_error(spark, tmp_path, monkeypatch):
    folder, real = _events(spark, tmp_path), jobs.start_recording

    def losing(rows, *args, **kwargs):
        return real(rows.where("camera_id <> 4 OR frame <> 7"), *args, **kwargs)

    try:
        assert driver.stream_recording_to_the_end(spark, folder).count() == 100
        monkeypatch.setattr(jobs, "start_recording", losing)
        with pytest.raises(RuntimeError, match="99 of 100 frames"):
            driver.stream_recording_to_the_end(spark, folder)
    finally:
        clear_run_dirs(spark)
