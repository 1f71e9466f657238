import json
import random

import pytest
from pyspark.sql import functions as F

from framewise.llm.chat import argument_errors, canonical, link_tools

SCHEMAS = {"find": {"query": ("string", True), "limit": ("integer", False), "near": ("object", False)}, "ping": {}}
CALLS = "conv_id long, call_id string, turn long, tool string, arguments string, after string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def linked(spark, calls, results):
    rows = link_tools(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    assert rows.columns == ["conv_id", "call_id", "kind", "turn", "depth", "status", "valid", "errors", "message"]
    return rows.collect()


def test_status_of_each_kind(spark):
    ok = '{"query":"x"}'
    calls = [
        (1, "a", 0, "find", ok, None), (1, "b", 2, "find", ok, "a"), (1, "c", 4, "find", ok, "zz"), (1, "d", 6, "find", ok, None),
        (1, "e", 8, "find", ok, "f"), (1, "f", 9, "find", ok, "e"), (1, "g", 10, "find", ok, "e"), (1, "a", 11, "ping", "{}", None),
        (None, "a", 0, "ping", "{}", None), (2, "a", 5, "ping", "{}", "b"), (2, "b", 1, "ping", "{}", None),
    ]
    results = [
        (1, "a", 1, "one"), (1, "a", 12, "late"), (1, "b", 1, None), (1, "c", 5, ""), (1, "x", 3, "?"), (1, "e", 9, "?"),
        (1, None, 3, "?"), (2, "a", 6, "r"), (2, "b", 2, "r"),
    ]
    rows = {(r["conv_id"], r["call_id"], r["kind"], r["turn"]): (r["status"], r["depth"]) for r in linked(spark, calls, results)}
    assert len(rows) == len(calls) + len(results)
    assert rows[1, "a", "call", 0] == ("linked", 0) and rows[1, "a", "result", 1] == ("linked", 0)
    assert rows[1, "a", "call", 11] == ("repeated", 0) and rows[1, "a", "result", 12] == ("repeated", 0)
    assert rows[1, "b", "call", 2] == ("linked", 1) and rows[1, "b", "result", 1] == ("early", 1)
    assert rows[1, "c", "call", 4] == ("lost", 0) and rows[1, "d", "call", 6] == ("unanswered", 0)
    assert rows[1, "x", "result", 3] == ("orphan", None)
    for name, turn in (("e", 8), ("f", 9), ("g", 10)):
        assert rows[1, name, "call", turn] == ("cycle", None)
    assert rows[1, "e", "result", 9] == ("cycle", None)
    assert rows[None, "a", "call", 0][0] == "no id" and rows[1, None, "result", 3][0] == "no id"
    # Named before the call that it uses, but ordered after it.
    assert rows[2, "a", "call", 5] == ("linked", 1) and rows[2, "b", "call", 1] == ("linked", 0)


def test_order_is_topological(spark):
    rnd = random.Random(1)
    calls, results = [], []
    for conv in range(20):
        ids = [f"c{i}" for i in range(rnd.choice([1, 3, 40]))]
        rnd.shuffle(ids)
        for i, name in enumerate(ids):
            calls.append((conv, name, rnd.randrange(100), "ping", "{}", rnd.choice(ids[:i]) if i and rnd.random() < 0.8 else None))
            results.append((conv, name, rnd.randrange(100), "r"))
    rows = linked(spark, calls, results)
    place = {}
    for n, r in enumerate(sorted(rows, key=lambda r: (r["conv_id"], r["depth"], r["kind"], r["call_id"]))):
        place[r["conv_id"], r["call_id"], r["kind"]] = n
    for conv, name, _, _, _, after in calls:
        assert place[conv, name, "call"] < place[conv, name, "result"]
        if after:
            assert place[conv, after, "result"] < place[conv, name, "call"]


def test_one_long_chain_in_one_conversation(spark):
    calls = [(7, f"c{i}", i, "ping", "{}", f"c{i - 1}" if i else None) for i in range(700)]
    rows = linked(spark, calls, [])
    assert sorted((r["depth"], r["call_id"]) for r in rows) == [(i, f"c{i}") for i in range(700)]


def test_arguments(spark):
    cases = {
        '{"query":"x","limit":3}': [], '{"limit":1.5,"query":"x"}': ["limit is no integer"], '{"limit":"3"}': ["limit is no integer", "missing query"],
        '{"query":null}': ["missing query"], '{"query":"x","limit":null}': [], '{"query":"x","b":1,"a":[2]}': ["unknown a", "unknown b"],
        '{"query":"x","near":{"lat":1}}': [], '{"query":"x","near":[1]}': ["near is no object"], "[1]": ["not an object"], "{broken": ["not an object"],
        "": ["not an object"], None: ["not an object"], "3": ["not an object"], "null": ["not an object"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string").withColumn("t", F.lit("find"))
    for r in df.select("a", argument_errors("t", "a", SCHEMAS).alias("e")).collect():
        assert r["e"] == cases[r["a"]], r
    other = spark.createDataFrame([("ping", "{}"), ("ping", '{"x":1}'), ("gone", "{}"), (None, "{}")], "t string, a string")
    assert [r["e"] for r in other.select(argument_errors("t", "a", SCHEMAS).alias("e")).collect()] == [[], ["unknown x"], ["unknown tool"], ["unknown tool"]]


def test_canonical_json(spark):
    texts = ['{ "b" : {"z":1, "a":[3, 1]}, "a": "é\\n\\"", "c": null, "d": true}', "[ ]", "broken", None, '{"n": 12345678901234}']
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    for r in df.select("a", canonical("a").alias("c")).collect():
        try:
            want = json.dumps(json.loads(r["a"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        except (TypeError, ValueError):
            want = None
        assert r["c"] == want


def test_messages(spark):
    rows = linked(spark, [(1, "a", 0, "find", '{"query": "x", "limit": 2}', None), (1, "b", 1, "find", "{broken", None), (1, "c", 1, None, None, None)], [(1, "a", 1, 'say "hi"\n'), (1, "b", 2, None)])
    by = {(r["call_id"], r["kind"]): json.loads(r["message"]) for r in rows}
    assert by["a", "call"] == {"role": "assistant", "tool_calls": [{"id": "a", "type": "function", "function": {"name": "find", "arguments": {"limit": 2, "query": "x"}}}]}
    assert by["b", "call"]["tool_calls"][0]["function"]["arguments"] == {"text": "{broken"}
    assert by["a", "result"] == {"role": "tool", "tool_call_id": "a", "content": 'say "hi"\n'} and by["b", "result"]["content"] is None
    assert all(r["message"] == json.dumps(json.loads(r["message"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in rows)


def test_repeated_rows_and_empty_tables(spark):
    twice = linked(spark, [(1, "a", 0, "ping", "{}", None)] * 2, [(1, "a", 1, "r")] * 3)
    assert [r["status"] for r in twice] == ["linked"] * 5
    assert linked(spark, [], []) == []
    assert [r["status"] for r in linked(spark, [], [(1, "a", 1, "r")])] == ["orphan"]


def test_extra_columns_do_not_matter(spark):
    calls = spark.createDataFrame([(1, "a", 0, "ping", "{}", None)], CALLS).withColumns({"content": F.lit("x"), "depth": F.lit(3), "node": F.lit(1)})
    results = spark.createDataFrame([(1, "a", 1, "r")], RESULTS).withColumns({"tool": F.lit("x"), "status": F.lit(3)})
    assert {r["status"] for r in link_tools(calls, results, SCHEMAS).collect()} == {"linked"}


NESTED = {
    "book": {
        "type": "object",
        "description": "A trip.",
        "properties": {
            "who": {
                "type": "object",
                "properties": {"name": {"type": "string", "minLength": 2, "pattern": "^[A-Z]"}, "age": {"type": "integer", "minimum": 0, "maximum": 150}},
                "required": ["name"],
                "additionalProperties": False,
            },
            "stops": {
                "type": "array", "minItems": 1, "maxItems": 3,
                "items": {"type": "object", "properties": {"at": {"type": ["string", "integer"]}, "days": {"type": "number", "exclusiveMinimum": 0}}, "required": ["at"]},
            },
            "class": {"enum": ["first", "second", 3, None, {"a": [1]}]},
            "grid": {"type": "array", "items": {"type": "array", "items": {"type": "boolean"}}},
        },
        "required": ["who", "stops"],
    }
}


def test_nested_schemas(spark):
    who, stops = '"who":{"name":"Ann"}', '"stops":[{"at":"x"}]'
    cases = [
        (f"{{{who},{stops}}}", []),
        (f'{{{who},{stops},"more":1}}', []),
        ("{}", ["missing stops", "missing who"]),
        (f'{{{stops},"who":{{"age":1.0,"nick":"x"}}}}', ["missing who.name", "unknown who.nick"]),
        (f'{{{stops},"who":{{"name":"a","age":1.5}}}}', ["who.age is no integer", "who.name has a length below 2", "who.name does not match ^[A-Z]"]),
        (f'{{{stops},"who":{{"name":"Bob","age":151}}}}', ["who.age has a value above 150"]),
        (f'{{{stops},"who":{{"name":"Bob","age":-1e2}}}}', ["who.age has a value below 0"]),
        (f'{{{stops},"who":{{"name":"Bob","age":null}}}}', []),
        (f'{{{stops},"who":7}}', ["who is no object"]),
        (f'{{{stops},"who":null}}', ["missing who"]),
        (f'{{{who},"stops":[]}}', ["stops has a size below 1"]),
        (f'{{{who},"stops":[{{"at":1}},{{"at":true}},{{}},{{"at":"x","days":0}}]}}',
         ["stops has a size above 3", "stops[1].at is no string or integer", "missing stops[2].at", "stops[3].days is not above 0"]),
        (f'{{{who},"stops":["x",null]}}', ["stops[0] is no object", "stops[1] is no object"]),
        (f'{{{who},{stops},"class":"third"}}', ['class is none of "first", "second", 3, null, {"a":[1]}']),
        (f'{{{who},{stops},"class":{{"a": [1]}}}}', []),
        (f'{{{who},{stops},"class":3}}', []),
        (f'{{{who},{stops},"grid":[[true],[],[false,0]]}}', ["grid[2][1] is no boolean"]),
        ("[1]", ["not an object"]),
    ]
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, arguments string")
    found = {r[0]: r[1] for r in rows.select("i", argument_errors(F.lit("book"), "arguments", NESTED)).collect()}
    order = lambda errors: sorted(errors)
    assert {i: order(f) for i, f in found.items()} == {i: order(w) for i, (_, w) in enumerate(cases)}


def test_schemas_that_say_what_is_not_known_are_refused(spark):
    with pytest.raises(ValueError, match="oneOf"):
        argument_errors(F.lit("x"), F.lit("{}"), {"x": {"type": "object", "oneOf": []}})


def test_very_long_arguments_and_contents(spark):
    long = "word " * 400_000
    calls = [(1, "a", 0, "find", json.dumps({"query": long}), None), (1, "b", 2, "find", '{"query": "' + "x" * 21_000_000 + '"}', None)]
    rows = {(r["call_id"], r["kind"]): r for r in linked(spark, calls, [(1, "a", 1, long), (1, "b", 3, None)])}
    assert rows["a", "call"]["valid"] and json.loads(rows["a", "call"]["message"])["tool_calls"][0]["function"]["arguments"]["query"] == long
    assert json.loads(rows["a", "result"]["message"])["content"] == long
    # Beyond what the parser takes: kept as text, whole.
    assert rows["b", "call"]["errors"] == "not an object" and len(rows["b", "call"]["message"]) > 21_000_000
