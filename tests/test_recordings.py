"""The two recordings of a query run side by side."""

import __spark_entry__ as driver
from framewise.plans import jobs
from framewise.settings import clear_run_dirs
from tests.test_to_the_end import _events

import pytest


def test_both_recordings_are_started_first(spark, tmp_path, monkeypatch):
    done, ids = [], iter("ab")

    class Recording:
        def __init__(self):
            self.name = next(ids)
            done.append(f"start {self.name}")

        def awaitTermination(self):
            done.append(f"await {self.name}")
            if self.name == "a":
                raise ValueError("failed")

        def stop(self):
            done.append(f"stop {self.name}")

    monkeypatch.setattr(jobs, "start_recording", lambda *args, **kwargs: Recording())
    try:
        with pytest.raises(ValueError, match="failed"):
            driver.stream_recording(spark, _events(spark, tmp_path))
    finally:
        clear_run_dirs(spark)
    assert done == ["start a", "start b", "await a", "stop a", "stop b"]
