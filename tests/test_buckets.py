"""Keyed state by buckets: many keys at once give what each gives by itself."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.operators import joint_streak, nth_occurrence
from framewise.streaming import drain
from framewise.streaming.buckets import BUCKETS, InBuckets
from framewise.streaming.occurrence import NthOccurrence
from framewise.streaming.streak import _block_summary
from tests.test_properties import Handle

BIG = 1 << 60
SCHEMA = "frame long, pos int, id long, emotion string, a boolean, b boolean"


def _people(seed, *more, frames=150):
    rng = random.Random(seed)
    ids = [None, 0, *range(40), *more]
    return [
        (f, p, rng.choice(ids), rng.choice(["SAD", "HAPPY", None]), rng.random() < 0.9, rng.random() < 0.9)
        for f in range(frames)
        for p in range(8)
    ]


def test_a_block_takes_many_keys_at_once():
    rng = random.Random(1)
    data = [(rng.randrange(9), f, 0, 3, rng.random() < 0.8, rng.random() < 0.8) for f in range(200)]
    rng.shuffle(data)
    pdf = pd.DataFrame(data, columns=["id", "frame", "pos", "_block", "_ok_a", "_ok_b"])
    run = _block_summary(["id"], ["frame", "pos"], ["a", "b"], 3)
    found = run(pdf)
    alone = pd.concat([run(one) for _, one in pdf.groupby("id")])
    assert sorted(map(tuple, found.values.tolist())) == sorted(map(tuple, alone[found.columns].values.tolist()))
    assert (found["_seq"] == 0).sum() == 9


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_time_to_live_counts_for_each_key():
    one = InBuckets(NthOccurrence(["id"], ["frame"], 3, 100), ["id"], 100)
    one.init(Handle())

    def run(now, *ids):
        rows = [{"id": i, "frame": now, "_more": 0} for i in ids]
        return [tuple(r) for r in one.handleInputRows((7,), iter(rows), Clock(now))]

    assert run(0, "a", "a", "b") == []
    assert run(60, "b") == []
    # What was known of a is forgotten, of b it is not.
    assert run(120, "a", "b") == [("b", 120)]
    assert run(150, "a") == [] and run(160, "a") == [("a", 160)]


@pytest.mark.parametrize("kind", ["nth", "streak"])
@pytest.mark.parametrize("after_history", [False, True])
def test_many_keys_and_nulls(spark, rows, feed, kind, after_history):
    people = _people(4) if kind == "nth" else _people(4, BIG, BIG + 1)
    table, source = spark.createDataFrame(people, SCHEMA), feed(SCHEMA)
    if kind == "nth":
        make = lambda df, **options: nth_occurrence(df, n=5, **options)
    else:
        make = lambda df, **options: joint_streak(df, conditions={"a": F.col("a"), "b": F.col("b")}, over=2, **options)
    first = 500 if after_history else 0
    for begin in range(first, len(people), 350):
        source.add(people[begin : begin + 350])
    history = spark.createDataFrame(people[:first], SCHEMA) if after_history else None
    stream = make(source.stream(), history=history)
    # A group is a bucket, not a key: as many groups as there are keys took most of the time.
    plan = stream._jdf.queryExecution().analyzed().toString()
    state = next(line for line in plan.splitlines() if "TransformWithState" in line)
    assert "_bucket" in state and BUCKETS >= 256
    got = drain(stream, "buckets")
    if after_history:
        got = got.unionByName(make(history))
    assert rows(got) == rows(make(table))
