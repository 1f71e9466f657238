"""Messages (``key``, ``value``) to people and events, and back.

A message's value is a JSON array of people. What counts as broken: text that is not
a JSON array, an entry that is not an object, an id or finger that is present but not
an integer, fingers that are no array, and a label outside the known set. A missing id or finger is 0, a missing
label or finger list stays null. Unknown fields are ignored, and ``1.0`` is not
accepted as an id. A message without a value holds nobody.

Keys are frame numbers. Where messages of several sources share a topic, their keys are
``source:frame``: ``by`` names the columns that the part ahead of the frame is read into, or
was written from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.functions.predicates import is_emotion
from framewise.schemas import EMOTION_EVENT, RAW_PEOPLE

ON_ERROR = ("fail", "drop", "quarantine")

# What an array of integers, numbers in quotes or nulls is called, and what entries of a mixed one may be.
_PLAIN_LISTS = ("ARRAY<BIGINT>", "ARRAY<STRING>", "ARRAY<VOID>")
_MIXED_LIST = "ARRAY<VARIANT>"
_ENTRIES = ("BIGINT", "STRING", "VOID")


def _bad_int(text: Column) -> Column:
    return text.isNotNull() & text.try_cast("int").isNull()


def _int_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def _bad_person(p: Column) -> Column:
    return (
        p.isNull()
        | _bad_int(p["id"])
        | (p["emotion"].isNotNull() & ~is_emotion(p["emotion"]))
        | (p["given"] & (p["list"].isNull() | F.coalesce(F.exists(p["list"], _bad_int), F.lit(False))))
    )


def _finger_text(entry: Column) -> Column:
    """An entry of a list as text; what is neither an integer nor a text is none that can be cast."""
    return F.when(F.schema_of_variant(entry).isin(*_ENTRIES), F.try_variant_get(entry, "$", "string")).otherwise("")


def _with_fingers(p: Column) -> Column:
    """The person with ``given`` (fingers are there) and ``list``, the fingers as texts; null if they are no array."""
    fingers, kind = p["fingers"], F.schema_of_variant(p["fingers"])
    listed = F.when(kind.isin(*_PLAIN_LISTS), F.try_variant_get(fingers, "$", "array<string>")).when(
        kind == _MIXED_LIST, F.transform(F.try_variant_get(fingers, "$", "array<variant>"), _finger_text)
    )
    given = fingers.isNotNull() & ~F.is_variant_null(fingers)
    whole = F.struct(p["id"].alias("id"), p["emotion"].alias("emotion"), given.alias("given"), listed.alias("list"))
    return F.when(p.isNotNull(), whole)


def _parse(messages: DataFrame, metric: str | None = None) -> DataFrame:
    """Adds ``raw`` (the parsed array) and ``error`` (null for a sound message).

    Both come out of a generator of one row each: a condition on a plain column would be
    pushed below the parser call together with a copy of it, so texts would be parsed
    several times.
    """
    present = messages.where(F.col("value").isNotNull())
    raw = F.from_json("value", RAW_PEOPLE)
    listed = F.transform(raw, _with_fingers)
    parsed = present.withColumn("_raw", listed)
    # A lone object would be wrapped into an array by the parser, so look at the text.
    array = F.col("value").rlike(r"^\s*\[")
    error = (
        F.when(~array, "not a JSON array")
        .when(F.col("_raw").isNull(), "malformed JSON")
        .when(F.exists("_raw", _bad_person), "malformed person")
    )
    checked = F.array(F.struct(F.col("_raw").alias("raw"), error.alias("error")))
    found = parsed.select(*messages.columns, F.inline_outer(checked))
    if metric is None:
        return found
    return found.observe(metric, F.count(F.lit(1)).alias("messages"), F.count("error").alias("broken"))


def _people(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    frame = F.substring_index("key", ":", -1).try_cast("long").alias("frame")
    flat = parsed.select(*keep, frame, F.posexplode_outer("raw").alias("pos", "p")).where(F.col("pos").isNotNull())
    return flat.select(
        *keep,
        "frame",
        "pos",
        _int_or_zero(F.col("p.id")).alias("id"),
        F.col("p.emotion").alias("emotion"),
        F.transform("p.list", _int_or_zero).alias("fingers"),
    )


def split_messages(messages: DataFrame, keep: Sequence[str] = (), metric: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(people of sound messages, broken messages with their ``error``).

    ``metric`` names an observed metric with the numbers of ``messages`` and of ``broken`` ones, which a stream
    reports in its progress for each micro-batch.
    """
    parsed = _parse(messages, metric)
    people = _people(parsed.where(F.col("error").isNull()), keep)
    return people, parsed.where(F.col("error").isNotNull()).drop("raw")


def with_source(messages: DataFrame, by: Sequence[str]) -> DataFrame:
    """``messages`` with the long columns ``by``, read from keys like ``source:frame``."""
    parts = F.split("key", ":")
    return messages.withColumns({c: F.try_element_at(parts, F.lit(i + 1)).try_cast("long") for i, c in enumerate(by)})


def source_key(by: Sequence[str], frame: str = "frame") -> Column:
    """The key of a frame's message: the frame alone, or with its source ahead."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in (*by, frame)])


def decode(messages: DataFrame, on_error: str = "fail", keep: Sequence[str] = (), metric: str | None = None) -> DataFrame:
    """One row per person: ``frame``, ``pos`` (index in the array), id, emotion, fingers.

    ``fail`` stops the job at the first broken message, ``drop`` skips broken ones.
    For ``quarantine`` use ``split_messages``, which also returns the rejects.
    ``keep`` names further input columns to carry along. With ``metric``, what is skipped is counted:
    see ``split_messages``.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    if on_error != "fail":
        return split_messages(messages, keep, metric)[0]
    parsed = _parse(messages, metric)
    complaint = F.concat(F.col("error"), F.lit(" in message "), F.coalesce("key", F.lit("without key")))
    sound = F.when(F.col("error").isNull(), True).otherwise(F.raise_error(complaint).cast("boolean"))
    return _people(parsed.where(sound), keep)


def _json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")


def encode_emotion_event(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.select(_json(*by, "id", "emotion"))


def encode_wave_event(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.select(_json(*by, "id"))


def encode_counts(counts: DataFrame) -> DataFrame:
    return counts.select(_json("emotion", "cnt"))


def read_emotion_events(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events back from the values that ``encode_emotion_event`` wrote."""
    row = F.from_json("value", ", ".join([*[f"{c} long" for c in by], EMOTION_EVENT]), {"mode": "FAILFAST"})
    return messages.where(F.col("value").isNotNull()).select(row.alias("e")).select("e.*")


def frame_messages(people: DataFrame, frames: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One message per frame: the people in ``pos`` order as a JSON array.

    Frames listed in ``frames`` but without people give ``[]``. ``by`` names columns
    that tell frames of different cameras apart; they are kept in front.
    """
    person = F.struct("pos", "id", "emotion", "fingers")
    grouped = people.groupBy(*by, "frame").agg(F.sort_array(F.collect_list(person)).alias("people"))
    return list_messages(grouped, frames, by)


def list_messages(lists: DataFrame, frames: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The same from one row per frame, with its people as the array ``people``."""
    keys = [*by, "frame"]
    if frames is not None:
        lists = frames.select(*keys).distinct().join(lists, keys, "left")
    names = ("id", "emotion", "fingers")
    listed = F.transform("people", lambda p: F.struct(*[p[c].alias(c) for c in names]))
    value = F.to_json(listed, {"ignoreNullFields": "false"})
    return lists.select(*by, F.col("frame").cast("string").alias("key"), F.coalesce(value, F.lit("[]")).alias("value"))
