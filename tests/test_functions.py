import math
import random

from pyspark.sql import functions as F

from framewise import functions as fn


def test_finger_count_and_anchor(spark, rows):
    rng = random.Random(1)
    hands = []
    for key in range(200):
        points = [(rng.randrange(100) / 100, rng.randrange(100) / 100) for _ in range(21)]
        hands.append((key, rng.choice(["Right", "Left"]), points))
    df = spark.createDataFrame(hands, "key int, label string, lm array<struct<x:double,y:double>>")
    x, y = fn.hand_anchor(F.col("lm"), 640, 480)
    found = rows(df.select("key", fn.finger_count(F.col("lm"), F.col("label")), x, y).orderBy("key"))
    expected = []
    for key, label, points in hands:
        count = sum(points[tip][1] < points[tip - 2][1] for tip in (8, 12, 16, 20))
        count += points[4][0] < points[3][0] if label == "Right" else points[4][0] > points[3][0]
        py = int(points[0][1] * 480) - 30
        py = int(points[0][1] * 480) + 30 if py < 20 else py
        expected.append((key, int(count), int(points[0][0] * 640), py))
    assert sorted(found) == sorted(expected)
    assert {count for _, count, _, _ in expected} >= {0, 1, 2, 3, 4}


def test_grid_cell_rounds_halves_to_even(spark):
    values = list(range(-200, 700))
    df = spark.createDataFrame([(v,) for v in values], "v int").select("v", fn.grid_cell(F.col("v")).alias("c"))
    assert {r.v: r.c for r in df.collect()} == {v: round(v / 40) for v in values}
    assert round(20 / 40) == 0 and round(60 / 40) == 2


def test_box_functions(spark):
    rng = random.Random(2)
    boxes = [(rng.randrange(-150, 700), rng.randrange(-150, 600), rng.randrange(1, 99), rng.randrange(1, 99)) for _ in range(400)]
    df = spark.createDataFrame(boxes, "x int, y int, w int, h int")
    box = [F.col(c) for c in "xywh"]
    inside = fn.clip_box(*box, 640, 480)
    got = df.select(
        *box,
        F.struct(*fn.centroid(*box)).alias("c"),
        F.struct(*inside).alias("i"),
        fn.box_area(*inside).alias("a"),
        F.struct(*fn.padded_box(*box, 640, 480)).alias("p"),
    ).collect()
    for r in got:
        x, y, w, h = r[:4]
        assert tuple(r.c) == (int(x + w / 2), int(y + h / 2))
        x0, y0, x1, y1 = max(x, 0), max(y, 0), min(x + w, 640), min(y + h, 480)
        assert tuple(r.i) == (x0, y0, x1, y1)
        assert (r.a > 0) == (x1 > x0 and y1 > y0)
        pad = int(min(w, h) * 0.15)
        assert tuple(r.p) == (max(x - pad, 0), max(y - pad, 0), min(x + w + pad, 640), min(y + h + pad, 480))


def test_distances(spark):
    df = spark.createDataFrame([(3, 4, 0, 0), (10, 2, 10, 9)], "a int, b int, c int, d int")
    points = [F.col(c) for c in "abcd"]
    got = df.select(fn.squared_distance(*points).alias("d2"), fn.distance(*points).alias("d")).collect()
    assert [(r.d2, r.d) for r in got] == [(25, 5.0), (49, math.hypot(0, 7))]


def test_dominant_label(spark):
    cases = [
        (1, {"sad": 2.0, "happy": 9.0, "fear": 9.0}, False, "happy"),
        (2, {}, False, "unknown"),
        (3, None, False, "unknown"),
        (4, {"sad": 2.0}, True, "not_face"),
        (5, {"sad": 0.0, "fear": 0.0}, False, "sad"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "k int, scores map<string,double>, failed boolean")
    got = df.select("k", fn.dominant_label(F.col("scores"), F.col("failed")).alias("l")).collect()
    assert {r.k: r.l for r in got} == {c[0]: c[3] for c in cases}
    names = spark.createDataFrame([("unknown",), (None,)], "l string").select(fn.emotion_name(F.col("l")))
    assert sorted(r[0] for r in names.collect()) == ["NEUTRAL", "UNKNOWN"]


def test_predicates(spark):
    data = [("HAPPY", []), ("HAPPY", [0, 5]), (None, [4]), ("SAD", None), ("happy", [6])]
    df = spark.createDataFrame(data, "e string, f array<int>")
    got = df.select(
        fn.happy(F.col("e")).alias("happy"),
        fn.is_emotion(F.col("e")).alias("known"),
        fn.max_fingers(F.col("f")).alias("max"),
        fn.full_hand(F.col("f")).alias("full"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, True, 0, False),
        (True, True, 5, True),
        (False, False, 4, False),
        (False, True, 0, False),
        (False, False, 6, False),
    ]


def test_reanalysis_due(spark):
    data = [(False, 50, None), (False, 50, 20), (False, 50, 21), (True, 50, None), (None, 50, 0)]
    df = spark.createDataFrame(data, "b boolean, f int, l int")
    got = df.select(fn.reanalysis_due(F.col("b"), F.col("f"), F.col("l"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, True]
