"""Occurrence numbers and streaks: tables, streams, and both against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from framewise.operators import Running, joint_streak, nth_occurrence, occurrence_number, scan, streak_lengths
from framewise.schemas import PEOPLE
from framewise.streaming import drain, start
from framewise.streaming.streak import stream_joint_streak
from tests import brute

ORDERED = "frame long, pos int, id int, emotion string"
def _conditions():
    return {"first": F.col("a"), "second": F.col("b")}


FLAGGED = "frame long, pos int, id int, a boolean, b boolean"


def _people(seed, frames=120, ids=5, hot=0.4, nulls=False):
    """Random people; a share of ``hot`` of all rows is person 0."""
    rng = random.Random(seed)
    labels = ["HAPPY", "SAD", "NEUTRAL", *([None] if nulls else [])]
    people = []
    for frame in range(frames):
        for pos in range(rng.randrange(4)):
            person = 0 if rng.random() < hot else rng.randrange(ids)
            people.append((frame, pos, person, rng.choice(labels)))
    rng.shuffle(people)
    return people


def _flags(seed, frames=300, ids=4, p=0.93):
    rng = random.Random(seed)
    data = []
    for frame in range(frames):
        for pos in range(rng.randrange(4)):
            person = 0 if rng.random() < 0.4 else rng.randrange(ids)
            data.append((frame, pos, person, rng.random() < p, rng.random() < p))
    rng.shuffle(data)
    return data


def _waves(data, over=10):
    return sorted(r[:3] for r in brute.lengths(data) if r[3] > over and r[4] > over)


def _same(rows, df, expected):
    assert sorted(rows(df), key=str) == sorted(expected, key=str)


def test_tenth_frame_is_cumulative_and_emitted_once(spark, rows):
    frames = ["HAPPY", "SAD"] * 9 + ["SAD", "HAPPY", "HAPPY", "SAD"]
    df = spark.createDataFrame([(i, 0, 1, e) for i, e in enumerate(frames)], ORDERED)
    assert rows(nth_occurrence(df)) == [(1, "HAPPY", 19, 0), (1, "SAD", 18, 0)]
    assert rows(nth_occurrence(df, n=12)) == []


@pytest.mark.parametrize("span", [None, 1, 7, 1 << 16])
def test_occurrence_number(spark, rows, span):
    people = _people(3, nulls=True)
    df = spark.createDataFrame(people, ORDERED)
    numbered = occurrence_number(df, span=span)
    expected = [r for n in range(1, 90) for r in brute.nth(people, n)]
    assert numbered.count() == len(people)
    for n in (1, 5, 10, 40):
        _same(rows, numbered.where(F.col("occurrence") == n).select("id", "emotion", "frame", "pos"), brute.nth(people, n))
    assert len(expected) == len(people)


def test_nth_beyond_the_group_limit(spark, rows):
    people = _people(4, nulls=True)
    df = spark.createDataFrame(people, ORDERED)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        _same(rows, nth_occurrence(df, n=4, span=9), brute.nth(people, 4))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    _same(rows, nth_occurrence(df, n=4), brute.nth(people, 4))
    with pytest.raises(ValueError):
        nth_occurrence(df, n=0)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_key_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(_people(5), ORDERED)
    plan = _plan(nth_occurrence(df))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_rows_are_partitioned_by_block(spark):
    df = spark.createDataFrame(_flags(5), FLAGGED)
    streaks = joint_streak(df, conditions=_conditions(), span=16)
    streaks.collect()
    plan = _plan(streaks)
    final = plan[: plan.index("== Initial Plan ==")]
    # Rows and block ends share one shuffle of the rows.
    assert "ReusedExchange" in final
    counted = occurrence_number(spark.createDataFrame(_people(5), ORDERED), span=16)
    counted.collect()
    plan = _plan(counted)
    assert "hashpartitioning(_key_id" in plan and "_block" in plan and "ReusedExchange" in plan[: plan.index("== Initial Plan ==")]


def test_scan_kinds(spark, rows):
    rng = random.Random(6)
    data = [(i, rng.choice([1, None]), rng.choice([None, rng.randrange(50)])) for i in range(80)]
    df = spark.createDataFrame(data, "t long, k int, v int")
    running = [
        Running("total", F.col("v"), "sum"),
        Running("top", F.col("v"), "max", inclusive=False),
        Running("latest", F.col("v"), "last"),
        Running("earlier", F.col("v"), "last", inclusive=False),
    ]
    expected, seen = [], {1: [], None: []}
    for t, k, v in data:
        before = list(seen[k])
        if v is not None:
            seen[k].append(v)
        now = seen[k]
        expected.append(
            (t, k, v, sum(now) if now else None, max(before, default=None), now[-1] if now else None, before[-1] if before else None)
        )
    for span in (None, 1, 6, 1000):
        _same(rows, scan(df, ["k"], ["t"], running, span), expected)


def test_wave_starts_at_the_eleventh_frame_and_goes_on(spark, rows):
    people = [(i, 0, 1, "HAPPY", [5]) for i in range(1, 14)]
    # Fingers fail in the sixth of fifteen frames.
    people += [(i, 1, 2, "HAPPY", [5] if i != 6 else [4]) for i in range(1, 16)]
    # Two hands, of which the larger one counts; then a person without any list.
    people += [(i, 2, 3, "HAPPY", [0, 5]) for i in range(1, 12)]
    people += [(i, 3, 4, "HAPPY", None) for i in range(1, 15)]
    people += [(i, 4, 5, None if i == 3 else "HAPPY", [5]) for i in range(1, 14)]
    df = spark.createDataFrame(people, PEOPLE)
    assert rows(joint_streak(df)) == [(1, 11, 0), (1, 12, 0), (1, 13, 0), (3, 11, 2)]
    assert rows(joint_streak(df, over=9)) == [(1, i, 0) for i in (10, 11, 12, 13)] + [(3, 10, 2), (3, 11, 2), (5, 13, 4)]


@pytest.mark.parametrize("span", [None, 1, 3, 16, 1 << 16])
def test_streaks(spark, rows, span):
    data = _flags(7)
    df = spark.createDataFrame(data, FLAGGED)
    _same(rows, streak_lengths(df, conditions=_conditions(), span=span), brute.lengths(data))
    waves = _waves(data)
    assert len(waves) > 50
    _same(rows, joint_streak(df, conditions=_conditions(), span=span), waves)


def test_streak_equals_joint_run_of_eleven(spark, rows):
    from pyspark.sql import Window

    df = spark.createDataFrame(_flags(8), FLAGGED)
    last = Window.partitionBy("id").orderBy("frame", "pos").rowsBetween(-10, 0)
    ok = (F.col("a") & F.col("b")).cast("int")
    runs = df.withColumn("all", F.min(ok).over(last)).withColumn("n", F.count("*").over(last))
    _same(rows, joint_streak(df, conditions=_conditions(), span=20), rows(runs.where("all = 1 and n = 11"), "id", "frame", "pos"))


def test_streak_of_null_keys(spark, rows):
    data = [(i, 0, None if i % 2 else 1, True, True) for i in range(30)]
    df = spark.createDataFrame(data, FLAGGED)
    got = rows(joint_streak(df, conditions=_conditions(), span=4))
    assert got == rows(spark.createDataFrame([(None if i % 2 else 1, i, 0) for i in range(20, 30)], "id int, frame long, pos int"))


def _batches(data, cuts):
    """Cut by frame, as arrival order is what counts between micro-batches."""
    frames = sorted({r[0] for r in data})
    edges = [frames[len(frames) * i // cuts] for i in range(cuts)] + [frames[-1] + 1]
    return [[r for r in data if lo <= r[0] < hi] for lo, hi in zip(edges, edges[1:], strict=False)]


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_stream_nth_equals_table(spark, rows, feed, cuts):
    people = _people(9, nulls=True)
    source = feed(ORDERED)
    for batch in _batches(people, cuts):
        source.add(batch)
    _same(rows, drain(nth_occurrence(source.stream()), "nth"), brute.nth(people, 10))


def test_stream_nth_over_many_arrow_batches(spark, rows, feed):
    people = _people(10, frames=400, hot=0.8)
    source = feed(ORDERED)
    source.add(people)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        _same(rows, drain(nth_occurrence(source.stream(), n=33), "nth"), brute.nth(people, 33))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("cuts,span", [(1, 1 << 16), (2, 16), (6, 5)])
def test_stream_streak_equals_table(spark, rows, feed, cuts, span):
    data = _flags(11)
    source = feed(FLAGGED)
    for batch in _batches(data, cuts):
        source.add(batch)
    stream = stream_joint_streak(source.stream(), ["id"], ["frame", "pos"], _conditions(), 10, span)
    _same(rows, drain(stream, "streak"), _waves(data))


@pytest.mark.parametrize("kind", ["nth", "streak"])
def test_stream_goes_on_after_a_restart(spark, rows, feed, tmp_path, kind):
    if kind == "nth":
        data, schema = _people(12), ORDERED
        make, expected = nth_occurrence, brute.nth(data, 10)
    else:
        data, schema = _flags(12), FLAGGED
        make, expected = lambda df: joint_streak(df, conditions=_conditions()), _waves(data)
    source = feed(schema)
    batches = _batches(data, 4)

    def run():
        df = make(source.stream())
        writer = df.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        writer = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        start(writer, df).awaitTermination()

    for batch in batches[:2]:
        source.add(batch)
    run()
    for batch in batches[2:]:
        source.add(batch)
    run()
    _same(rows, spark.read.parquet(str(tmp_path / "out")), expected)


def test_late_rows_count_when_they_arrive(spark, rows, feed):
    source = feed(ORDERED)
    source.add([(100 + i, 0, 1, "SAD") for i in range(9)])
    source.add([(5, 0, 1, "SAD")])
    assert rows(drain(nth_occurrence(source.stream()), "nth")) == [(1, "SAD", 5, 0)]


def test_state_may_expire(spark, rows, feed):
    from framewise.streaming import stream_nth_occurrence

    source = feed(ORDERED)
    people = _people(13)
    source.add(people)
    stream = stream_nth_occurrence(source.stream(), ["id", "emotion"], ["frame", "pos"], 10, ttl_ms=3_600_000)
    # Otherwise the clock alone would cause new micro-batches without end.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        _same(rows, drain(stream, "ttl"), brute.nth(people, 10))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
