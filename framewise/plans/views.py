"""Observation tables derived from the ``events`` table of the test data.

Each function takes that table, or a stream of it, and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.settings import run_dir, write_through

WIDTH, HEIGHT = 640, 480

CAMERA_FRAME = "event_id div 8 + event_id div 500 * 100"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


#: About as many rows a micro-batch of a feed takes in at most.
BATCH_ROWS = 1_000_000


def in_files(df: DataFrame, order: str, batches: int = 4, files: int = 4, most: int = BATCH_ROWS) -> DataFrame:
    """``df`` as a stream of several micro-batches of about as many rows, by the integer ``order``.

    There are ``batches`` of them, or as many more as it takes for none to have many more rows than ``most``: what a
    micro-batch takes in must not grow with the table. Each is written by ``files`` tasks, one batch after the other, to a new
    folder. A micro-batch is as many files, so it takes that many rows at least for batches to stay what they are.
    """
    folder, spark = run_dir(df.sparkSession, "feed"), df.sparkSession
    df = write_through(df, "fed")  # used for each batch
    needed = -(-df.count() // most)
    if needed > batches:
        batches = needed
        # In ranges, so that a batch reads its own part of the table only.
        df = write_through(df.repartitionByRange(batches * files, order), "fed-by-range")
    ends = df.approxQuantile(order, [(i + 1) / batches for i in range(batches - 1)], min(0.001, 0.1 / batches))
    for begin, end in zip([None, *ends], [*ends, None]):
        part = df if begin is None else df.where(F.col(order) > int(begin))
        part = part if end is None else part.where(F.col(order) <= int(end))
        part.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in several micro-batches, which cut frames."""
    return in_files(events(spark, sf_dir), "event_id")


def people(ev: DataFrame) -> DataFrame:
    """Four people per frame with a mix of labels."""
    k = "cast(get_json_object(props, '$.k') as int)"
    return ev.selectExpr("*", f"{k} as k").selectExpr(
        "event_id div 4 as frame",
        "cast(event_id % 4 as int) as pos",
        "cast(user_id as int) as id",
        """case event_type when 'click' then 'HAPPY' when 'view' then 'NEUTRAL'
           when 'purchase' then 'SURPRISE' when 'signup' then 'SAD' else 'ANGRY' end as emotion""",
        """case when k % 7 = 0 then cast(array() as array<int>)
           else array(cast(k % 6 as int), cast(k div 6 % 6 as int)) end as fingers""",
    )


def wave_people(ev: DataFrame) -> DataFrame:
    """Mostly HAPPY and five fingers, so that long runs occur."""
    return ev.selectExpr(
        "event_id div 4 as frame",
        "cast(event_id % 4 as int) as pos",
        "cast(user_id as int) as id",
        "case when event_type <> 'error' then 'HAPPY' else 'ANGRY' end as emotion",
        "array(case when value < 100 then 5 else 0 end) as fingers",
    )


def hands(ev: DataFrame) -> DataFrame:
    """Up to five per frame."""
    return ev.where("event_id % 12 < 5").selectExpr(
        "event_id div 12 as frame_id",
        "cast(event_id % 12 as int) as hand_ord",
        "cast(event_id % 6 as int) as n_fingers",
        "cast((event_id * 37) % 640 as int) as x",
        "cast((event_id * 91) % 480 as int) as y",
    )


def faces(ev: DataFrame) -> DataFrame:
    """Up to seven per frame; together with ``hands`` this takes in all events."""
    return ev.where("event_id % 12 >= 5").selectExpr(
        "event_id div 12 as frame_id",
        "cast(event_id % 12 as int) as face_ord",
        "user_id as face_id",
        "cast((event_id * 53) % 640 as int) as cx",
        "cast((event_id * 29) % 480 as int) as cy",
    )


def landmarks(ev: DataFrame, *others: str) -> DataFrame:
    """One hand of 21 points per event, and the columns ``others`` behind."""
    return ev.selectExpr(
        "event_id as hand_key",
        "case when event_id % 2 = 0 then 'Right' else 'Left' end as hand_label",
        """transform(sequence(0, 20), i -> named_struct(
             'x', ((event_id + 1) * (i + 3) * 7 % 101) / 100D,
             'y', ((event_id + 2) * (i + 5) * 11 % 103) / 100D)) as lm""",
        *others,
    )


def scores(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_id",
        "map('angry', event_id * 7 % 50, 'happy', event_id * 11 % 50, 'sad', event_id * 13 % 50) as scores",
        "event_id % 17 = 0 as failed",
    )


def detections(ev: DataFrame) -> DataFrame:
    """Five cameras; boxes drift slowly, may leave the frame and come up to eight per frame.

    Frame numbers leap by 100 every now and then: pauses in which all tracks expire.
    """
    return ev.selectExpr(
        "user_id % 5 as camera_id",
        f"{CAMERA_FRAME} as frame",
        "cast(event_id % 8 as int) as det_ord",
        "cast((user_id * 97 + event_id div 16) % 660 as int) - 20 as x",
        "cast((user_id * 61 + event_id div 32) % 500 as int) - 20 as y",
        "cast(60 + event_id % 41 as int) as w",
        "cast(60 + event_id % 37 as int) as h",
        "event_type <> 'error' as verified",
    )


#: Places that the wide camera sees, each far from the next.
PLACES, PLACE_WIDTH = 12, 600


def crowded_detections(ev: DataFrame) -> DataFrame:
    """One wide camera without pauses, before which boxes come and go at a dozen places."""
    return ev.selectExpr(
        "0L as camera_id",
        "event_id div 8 as frame",
        "cast(event_id % 8 as int) as det_ord",
        f"cast(user_id % {PLACES} * {PLACE_WIDTH} + (user_id * 17 + event_id div 16) % 200 as int) as x",
        "cast((user_id * 61 + event_id div 32) % 150 as int) as y",
        "cast(60 + event_id % 41 as int) as w",
        "cast(60 + event_id % 37 as int) as h",
    )


def camera_frames(ev: DataFrame) -> DataFrame:
    """Every frame of every camera, with or without a detection."""
    numbers = ev.selectExpr(f"{CAMERA_FRAME} as frame").distinct()
    return numbers.select(F.explode(F.expr("sequence(0L, 4L)")).alias("camera_id"), "frame")


def camera_hands(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "user_id % 5 as camera_id",
        f"{CAMERA_FRAME} as frame",
        "cast(event_id % 8 as int) as hand_ord",
        "cast(event_id % 6 as int) as n_fingers",
        "cast((event_id * 37) % 640 as int) as x",
        "cast((event_id * 91) % 480 as int) as y",
    )


def camera_landmarks(ev: DataFrame) -> DataFrame:
    """The points of each of ``camera_hands``' hands, in place of its count and anchor.

    Events meet their hands by number, and points are made of what has met: they would be most of what is shuffled.
    """
    own = ev.selectExpr("event_id as hand_key", "user_id % 5 as camera_id", f"{CAMERA_FRAME} as frame", "cast(event_id % 8 as int) as hand_ord")
    met = ev.select("event_id", F.col("event_id").alias("hand_key")).join(own, "hand_key")
    return landmarks(met, "camera_id", "frame", "hand_ord").drop("hand_key")


def request_results(requests: DataFrame) -> DataFrame:
    """Two results for each request: some failed, some ``not_face``, some with a label."""
    label = """case ({0}) % 6 when 0 then 'not_face' when 2 then 'happy' when 3 then 'sad'
                               when 4 then 'unknown' when 5 then 'fear' end as label"""
    named = ["camera_id", "session", "n"]
    first = requests.selectExpr(*named, "frame + 3 + (frame + n) % 40 as frame", label.format("session + n"))
    return first.unionByName(requests.selectExpr(*named, "frame + 50 + (frame + n) % 20 as frame", label.format("session + n + 3")))


def person_tracks(ev: DataFrame) -> DataFrame:
    """Each person as a track that is there in the person's frames."""
    return people(ev).selectExpr("id % 5 as camera_id", "id as track_id", "frame").distinct()


def label_results(ev: DataFrame) -> DataFrame:
    """A result per event: most failed, about one in seven with a label, a few ``not_face``."""
    return ev.selectExpr("*", "cast(get_json_object(props, '$.k') as int) as k").selectExpr(
        "cast(user_id as int) % 5 as camera_id",
        "cast(user_id as int) as track_id",
        "event_id div 4 as frame",
        """case when k = 98 and event_type = 'error' then 'not_face'
                when k % 7 = 0 then event_type end as label""",
    )


def analysis_states(ev: DataFrame) -> DataFrame:
    return ev.selectExpr("*", "cast(get_json_object(props, '$.k') as bigint) as k").selectExpr(
        "event_id",
        "event_id div 4 as frame",
        "k % 2 = 0 as busy",
        "case when k >= 5 then event_id div 4 - k end as last_analyzed",
    )
