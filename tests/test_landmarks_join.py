"""Landmarks meet their hands by number alone, and hands are only compared with the faces that they may go to."""

import random

from framewise.operators import greedy_match, matching
from framewise.plans import views as v

import pytest
from pyspark.sql import functions as F

HANDS = "frame_id long, hand_ord int, n_fingers int, x int, y int"
FACES = "frame_id long, face_ord long, face_id long, cx int, cy int"


def test_points_are_not_shuffled(spark, rows):
    ids = [0, 1, 1, 2, 9, 17, None]
    ev = spark.createDataFrame([(i, 3 * (i or 0)) for i in ids], "event_id long, user_id long")
    found = v.camera_landmarks(ev)
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    join = tree[tree.index("Join") :]
    assert "transform" in tree[: tree.index("Join")] and "transform" not in join
    own = ev.selectExpr("event_id as hand_key", "user_id % 5 as camera_id", f"{v.CAMERA_FRAME} as frame", "cast(event_id % 8 as int) as hand_ord")
    assert rows(found) == rows(v.landmarks(ev).join(own, "hand_key").drop("hand_key"))
    assert found.count() == 8


def _greedy(hands, faces, capacity):
    """Closest pairs first, over all pairs."""
    pairs = sorted(((x - cx) ** 2 + (y - cy) ** 2, h, f, i, n) for _, h, n, x, y in hands for _, f, i, cx, cy in faces)
    chosen = []
    for pair in pairs:
        if all(c[1] != pair[1] for c in chosen) and sum(c[2] == pair[2] for c in chosen) < capacity:
            chosen.append(pair)
    return [(at, p[1], p[2], p[3], p[4], p[0]) for at, p in enumerate(chosen)]


@pytest.mark.parametrize("capacity", [1, 2, 3])
def test_choice_among_fewer_pairs(spark, rows, capacity):
    rng, hands, faces, want = random.Random(capacity), [], [], []
    for frame in range(150):
        # Few places, so that there are ties; numbers that come twice in every third frame.
        odd = frame % 3 == 0
        mine = [(frame, rng.randrange(4) if odd else at, rng.randrange(6), rng.randrange(9), 1) for at in range(rng.randrange(8))]
        theirs = [(frame, rng.randrange(4) if odd else at, at, rng.randrange(9), 2) for at in range(rng.randrange(1, 7))]
        hands, faces = hands + mine, faces + theirs
        want += [(frame, *c) for c in _greedy(mine, theirs, capacity)]
    got = greedy_match(spark.createDataFrame(hands, HANDS), spark.createDataFrame(faces, FACES), capacity=capacity)
    assert rows(got) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_pairs_that_may_be_chosen(spark):
    hands = [(0, h, 1, h, 0) for h in range(3)]
    faces = [(0, f, f, 10 * f, 0) for f in range(20)]
    lists = matching._listed(spark.createDataFrame(hands, HANDS), matching._HAND, ["frame_id"], "_hands")
    lists = lists.join(matching._listed(spark.createDataFrame(faces, FACES), matching._FACE, ["frame_id"], "_faces"), "frame_id")
    sizes = lists.select(*[F.size(matching._pairs(c)) for c in (1, 2, 3)]).first()
    assert tuple(sizes) == (9, 6, 3)
