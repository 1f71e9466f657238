import json

import pytest
from pyspark.sql import functions as F

from framewise.sources import (
    decode,
    encode_counts,
    encode_emotion_event,
    encode_wave_event,
    frame_messages,
    read_emotion_events,
    source_key,
    split_messages,
    with_source,
)

SOUND = [
    ("1", '[{"id": 0, "emotion": "HAPPY", "fingers": [5]}, {"id": 1, "emotion": "NEUTRAL", "fingers": []}]'),
    ("2", "[]"),
    ("3", '[{"id":"7","emotion":"SAD","fingers":[1,2]}]'),
    ("4", '[{"emotion":"SAD","fingers":[1]}]'),
    ("5", '[{"id":null,"emotion":"FEAR","fingers":null}]'),
    ("6", ' \n[{"id":3,"emotion":null,"fingers":[null,4],"extra":{"a":[1]}}]'),
    ("7", None),
    # Only the field of that name counts, however its name is written and whatever else is in the message.
    ("8", '[{"id":1,"emotion":"HAPPY","fingers":[5],"meta":{"fingers":"five"}},{"id":2,"note":"\\"fingers\\":\\"x\\""}]'),
    ("9", '[{"id":1,"fing\\u0065rs":["3",2,null,"4"]},{"id":2,"fingers":[[1]],"fingers":[]}]'),
]
PEOPLE = [
    (1, 0, 0, "HAPPY", [5]),
    (1, 1, 1, "NEUTRAL", []),
    (3, 0, 7, "SAD", [1, 2]),
    (4, 0, 0, "SAD", [1]),
    (5, 0, 0, "FEAR", None),
    (6, 0, 3, None, [0, 4]),
    (8, 0, 1, "HAPPY", [5]),
    (8, 1, 2, None, None),
    (9, 0, 1, None, [3, 2, 0, 4]),
    (9, 1, 2, None, []),
]
BROKEN = [
    ("a", '{"id":1,"emotion":"SAD","fingers":[]}', "not a JSON array"),
    ("b", "no json", "not a JSON array"),
    ("c", '[{"id":1,', "malformed JSON"),
    ("d", '[{"id":"abc","emotion":"SAD","fingers":[]}]', "malformed person"),
    ("e", '[{"id":1.0,"emotion":"SAD","fingers":[]}]', "malformed person"),
    ("f", '[{"id":1,"emotion":"UNKNOWN","fingers":[]}]', "malformed person"),
    ("g", '[{"id":1,"emotion":"SAD","fingers":["x"]}]', "malformed person"),
    ("h", '[{"id":1,"emotion":"SAD","fingers":[]},{"id":2,"emotion":"happy","fingers":[]}]', "malformed person"),
    ("i", "[null]", "malformed person"),
    ("j", "", "not a JSON array"),
    ("k", '[{"id":1,"emotion":"SAD","fingers":5}]', "malformed person"),
    ("l", '[{"id":1,"emotion":"SAD","fingers":"abc"}]', "malformed person"),
    ("m", '[{"id":1,"emotion":"SAD","fingers":{"a":1}}]', "malformed person"),
    ("n", '[{"id":1,"emotion":"SAD","fingers" : "[1]"}]', "malformed person"),
    ("o", '[{"id":1,"emotion":"SAD","fingers":[[1]]}]', "malformed person"),
    ("p", '[{"id":1,"emotion":"SAD","fing\\u0065rs":"[1]"}]', "malformed person"),
    ("q", '[{"id":1,"emotion":"SAD","fingers":[1,1.0]}]', "malformed person"),
    ("r", '[{"id":1,"emotion":"SAD","fingers":[1,3000000000]}]', "malformed person"),
    ("s", '[{"id":1,"emotion":"SAD","fingers":[true]}]', "malformed person"),
    ("t", '[{"id":1,"emotion":"SAD","fingers":["1",{"a":1}]}]', "malformed person"),
    ("u", '[{"id":1,"emotion":"SAD","fingers":["1",""]}]', "malformed person"),
]


def _messages(spark, data):
    return spark.createDataFrame(data, "key string, value string")


def test_sound_messages(spark, rows):
    for mode in ("fail", "drop"):
        people = decode(_messages(spark, SOUND), mode)
        assert people.columns == ["frame", "pos", "id", "emotion", "fingers"]
        assert rows(people) == rows(spark.createDataFrame(PEOPLE, people.schema))


def test_keys_with_a_source(spark, rows):
    person = '[{"id":4,"emotion":"SAD","fingers":[2]}]'
    messages = _messages(spark, [("7:12", person), ("8:12", person), (None, person), ("x:3", person), ("9", person)])
    people = decode(with_source(messages, ["camera_id"]), keep=["camera_id"])
    assert rows(people, "camera_id", "frame", "id") == [(7, 12, 4), (8, 12, 4), (9, 9, 4), (None, 3, 4), (None, None, 4)]
    keyed = spark.createDataFrame([(7, 12)], "camera_id long, frame long").select(source_key(["camera_id"]).alias("key"))
    assert rows(keyed) == [("7:12",)]


@pytest.mark.parametrize("key,value,error", BROKEN)
def test_fail_stops_at_a_broken_message(spark, key, value, error):
    people = decode(_messages(spark, [*SOUND, (key, value)]))
    with pytest.raises(Exception, match=error):
        # Also when the broken column is not asked for.
        people.select("pos").collect()


def test_quarantine_and_drop(spark, rows):
    messages = _messages(spark, [*SOUND, *[b[:2] for b in BROKEN]])
    people, rejected = split_messages(messages)
    assert rows(people) == rows(spark.createDataFrame(PEOPLE, people.schema))
    assert rows(rejected, "key", "value", "error") == sorted(BROKEN)
    assert rows(decode(messages, "drop")) == rows(people)
    with pytest.raises(ValueError):
        decode(messages, "ignore")


def test_keep_carries_columns(spark, rows):
    messages = _messages(spark, SOUND[:1]).withColumn("camera_id", F.lit(4))
    assert rows(decode(messages, keep=["camera_id"]), "camera_id", "id") == [(4, 0), (4, 1)]


def test_round_trip_and_empty_frames(spark, rows):
    people = spark.createDataFrame(PEOPLE, "frame long, pos int, id int, emotion string, fingers array<int>")
    frames = spark.createDataFrame([(f,) for f in range(1, 10)], "frame long")
    messages = frame_messages(people, frames)
    assert rows(decode(messages)) == rows(people)
    values = {r.key: r.value for r in messages.collect()}
    assert values["2"] == values["7"] == "[]"
    assert json.loads(values["1"]) == json.loads(SOUND[0][1])


def test_events(spark, rows):
    events = spark.createDataFrame([(1, "HAPPY"), (2, None)], "id int, emotion string")
    values = encode_emotion_event(events)
    assert rows(values) == [('{"id":1,"emotion":"HAPPY"}',), ('{"id":2,"emotion":null}',)]
    assert rows(read_emotion_events(values)) == rows(events)
    assert rows(encode_wave_event(events)) == [('{"id":1}',), ('{"id":2}',)]
    counts = spark.createDataFrame([("SAD", 3)], "emotion string, cnt long")
    assert rows(encode_counts(counts)) == [('{"emotion":"SAD","cnt":3}',)]
    with pytest.raises(Exception):
        read_emotion_events(spark.createDataFrame([("{",)], "value string")).collect()
