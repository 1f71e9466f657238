"""Tool calls and results of conversations: linked, ordered, checked, written as canonical JSON.

DataFrame operations only.
"""

from __future__ import annotations

import json
import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.settings import write_through

CALL, RESULT = 0, 1

#: For each tool a JSON schema of its arguments, or for short a kind and whether it must be given for each argument,
#: which stands for an object with these and no others.
Schema = dict
Schemas = dict[str, dict[str, tuple[str, bool]] | Schema]

# How Spark names the types of parsed JSON values.
_KINDS = {
    "string": "^STRING$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*",
    "object": "^OBJECT<.*",
    "null": "^VOID$",
}
_WHOLE = r"^(BIGINT|DECIMAL\(\d+,0\))$"
_NO_TEXTS = "array<string>"
# What a schema may say beside descriptions; anything else would pass unchecked, so it is refused.
_KNOWN = {
    "type", "enum", "const", "properties", "required", "additionalProperties", "items", "minItems", "maxItems",
    "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern",
}
_REMARKS = {"title", "description", "default", "examples", "$schema", "$id"}


def as_schema(fields: dict) -> Schema:
    """The JSON schema that a short form stands for; a JSON schema as it is."""
    if all(isinstance(v, tuple) for v in fields.values()):
        return {
            "type": "object",
            "properties": {name: {"type": kind} for name, (kind, _) in fields.items()},
            "required": [name for name, (_, required) in fields.items() if required],
            "additionalProperties": False,
        }
    return fields


def _is_kind(value: Column, kind: Column, wanted: str) -> Column:
    if wanted == "integer":
        # As in JSON schemas, a number without a fraction is one, however it is written.
        number = F.try_variant_get(value, "$", "double")
        return kind.rlike(_WHOLE) | (kind.rlike(_KINDS["number"]) & (number == F.floor(number)))
    return kind.rlike(_KINDS[wanted])


def _member(value: Column, name: str) -> Column:
    if "'" in name and '"' in name:
        raise ValueError(f"a name with both kinds of quotes cannot be looked up: {name}")
    return F.try_variant_get(value, f'$["{name}"]' if "'" in name else f"$['{name}']", "variant")


def _complaints(value: Column, schema: Schema, path: Column) -> Column:
    """What is wrong with a variant that is there, as an array of texts. ``path`` names it in them."""
    if odd := set(schema) - _KNOWN - _REMARKS:
        raise ValueError(f"not known in a schema: {sorted(odd)}")
    kind = F.schema_of_variant(value)
    says = lambda *words: F.concat(path, *map(F.lit, words))
    given = lambda own: own.isNotNull() & (F.schema_of_variant(own) != "VOID")
    found: list[Column] = []  # texts, or null where all is well
    lists: list[Column] = []

    def unless(good: Column, *words: str) -> None:
        found.append(F.when(~F.coalesce(good, F.lit(False)), says(*words)))

    def limited(amount: Column, low: str, high: str, what: str) -> None:
        if low in schema:
            found.append(F.when(amount < schema[low], says(f" has {what} below {schema[low]}")))
        if high in schema:
            found.append(F.when(amount > schema[high], says(f" has {what} above {schema[high]}")))

    wanted = schema.get("type", [])
    wanted = [wanted] if isinstance(wanted, str) else list(wanted)
    if wanted:
        unless(reduce(or_, [_is_kind(value, kind, w) for w in wanted]), " is no ", " or ".join(wanted))
    allowed = [schema["const"]] if "const" in schema else schema.get("enum")
    if allowed is not None:
        unless(F.to_json(value).isin(*[canonical_text(v) for v in allowed]), " is none of ", ", ".join(map(canonical_text, allowed)))

    number = F.when(kind.rlike(_KINDS["number"]), F.try_variant_get(value, "$", "double"))
    limited(number, "minimum", "maximum", "a value")
    if "exclusiveMinimum" in schema:
        found.append(F.when(number <= schema["exclusiveMinimum"], says(f" is not above {schema['exclusiveMinimum']}")))
    if "exclusiveMaximum" in schema:
        found.append(F.when(number >= schema["exclusiveMaximum"], says(f" is not below {schema['exclusiveMaximum']}")))
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    limited(F.length(text), "minLength", "maxLength", "a length")
    if "pattern" in schema:
        found.append(F.when(~text.rlike(schema["pattern"]), says(f" does not match {schema['pattern']}")))

    is_array, is_object = kind.startswith("ARRAY"), kind.startswith("OBJECT")
    entries = F.when(is_array, F.try_variant_get(value, "$", "array<variant>"))
    limited(F.size(entries), "minItems", "maxItems", "a size")
    if "items" in schema:
        each = F.transform(entries, lambda x, at: _complaints(x, schema["items"], F.concat(path, F.lit("["), at.cast("string"), F.lit("]"))))
        lists.append(F.coalesce(F.flatten(each), F.array().cast(_NO_TEXTS)))

    inside = lambda name: F.when(path == "", F.lit(name)).otherwise(F.concat(path, F.lit("."), F.lit(name)))
    none, required = F.array().cast(_NO_TEXTS), set(schema.get("required", ()))
    fields = schema.get("properties", {})
    for name in sorted({*fields, *required}):
        own = _member(value, name)
        checked = _complaints(own, fields[name], inside(name)) if name in fields else none
        missing = F.array(F.concat(F.lit("missing "), inside(name))) if name in required else none
        lists.append(F.when(~F.coalesce(is_object, F.lit(False)), none).when(given(own), checked).otherwise(missing))
    if schema.get("additionalProperties", True) is False:
        names = F.when(is_object, F.json_object_keys(F.to_json(value)))
        unknown = F.array_sort(F.array_except(names, F.array(*map(F.lit, sorted(fields))).cast(_NO_TEXTS)))
        before = F.when(path == "", "unknown ").otherwise(F.concat(F.lit("unknown "), path, F.lit(".")))
        lists.append(F.coalesce(F.transform(unknown, lambda x: F.concat(before, x)), none))
    return F.concat(F.array_compact(F.array(*found).cast(_NO_TEXTS)), *lists)


def canonical_text(value) -> str:
    """A Python value as canonical JSON."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def argument_errors(tool: str | Column, arguments: str | Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as a list of texts; empty if nothing is.

    Arguments are JSON text. ``not an object``, ``unknown tool``, and for each argument in
    alphabetical order ``missing x``, ``x is no integer`` and so on, then ``unknown x``. Arguments inside others are named
    ``x.y`` and ``x[0]``. Schemas may be nested and say: types, enumerations, fields, which of them must be given and
    whether there may be others, items of arrays and their number, ranges of numbers, lengths and patterns of
    texts. A null where an argument need not be given counts as not given.

    Text that Spark's parser refuses for its size, as with one string of over 20 million characters, is ``not an object``.
    """
    tool, arguments = (F.col(c) if isinstance(c, str) else c for c in (tool, arguments))
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    result = F.array(F.lit("unknown tool"))
    for name, schema in sorted(schemas.items()):
        result = F.when(tool == name, _complaints(value, as_schema(schema), F.lit(""))).otherwise(result)
    return F.when(is_object, result).otherwise(F.array(F.lit("not an object")))


def canonical(arguments: str | Column) -> Column:
    """JSON text with the keys of all objects sorted and no blanks; null if it is no JSON."""
    return F.to_json(F.try_parse_json(arguments))


def _depths(nodes: DataFrame) -> DataFrame:
    """``nodes``: node, parent. Adds ``depth``, the number of steps to a node without a parent.

    Every round doubles the steps that each node looks ahead, so a chain of n calls takes about
    log2(n) rounds. A node that is still under way after as many rounds as the number of nodes
    allows is on a cycle or behind one; its depth is null. Keys are unique on the side that is
    looked up, and each round is written to the shared folder.
    """
    steps = F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long")
    now = write_through(nodes.select("node", F.col("parent").alias("up"), steps.alias("steps")), "depths")
    count = now.count()
    for _ in range(math.ceil(math.log2(count + 1)) + 1 if count else 0):
        if now.where(F.col("up").isNotNull()).isEmpty():
            break
        done = now.where(F.col("up").isNull())
        going = now.where(F.col("up").isNotNull())
        ahead = now.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        moved = going.join(ahead, "up").select("node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"))
        now = write_through(done.unionByName(moved), "depths")
    return now.select("node", F.when(F.col("up").isNull(), F.col("steps")).alias("depth"))


def link_tools(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call and per result, linked, checked and written out.

    ``calls``: conv_id, call_id, turn, tool, arguments (JSON text), after (the call whose result
    this one uses, or null). ``results``: conv_id, call_id, turn, content. Further columns are not
    carried along.

    Result columns: conv_id, call_id, kind (call or result), turn, depth, status, valid, errors,
    message. Sorted by (depth, kind, call_id) within a conversation, every result follows its call
    and every call the results it uses; equal depths may stand in any order. ``depth`` is the number
    of calls that come before through ``after``.

    ``status`` is, the first that holds: ``no id`` (conversation or call id null), ``repeated`` (not
    the first of its kind with that id, by turn and then content; equal rows are all first),
    ``orphan`` (a result without a call), ``cycle`` (the call depends on itself; depth is null),
    ``unanswered`` (a call without a result), ``lost`` (``after`` names no call; depth is 0),
    ``early`` (a result with a smaller turn than its call: it is moved behind it), ``linked``.
    ``valid`` says whether a call's arguments fit its tool's schema, with ``errors`` joined by ``; ``;
    for a result it is its call's, null without one. Arguments that are no JSON, or too long for ``argument_errors``,
    are kept as text, whole; contents may be of any length.

    ``message`` is canonical JSON. Null arguments are no object; a null content is written as
    null. Empty tables give no rows.

    Nothing is gathered by conversation: calls and results of one id are combined ahead of the
    shuffle (the first of each), and each row then joins that one row. So a conversation or an id
    that holds a third of all rows takes no task more than its share.
    """
    columns = ["conv_id", "call_id", "turn", "kind", "tool", "arguments", "after", "content"]
    none = F.lit(None).cast("string")
    rows = calls.select(
        "conv_id", "call_id", "turn", F.lit(CALL).alias("kind"), F.col("tool").cast("string"),
        F.col("arguments").cast("string"), "after", none.alias("content"),
    ).unionByName(
        results.select(
            "conv_id", "call_id", "turn", F.lit(RESULT).alias("kind"), none.alias("tool"), none.alias("arguments"),
            F.lit(None).cast(calls.schema["after"].dataType).alias("after"), F.col("content").cast("string"),
        )
    )
    whole = F.struct("turn", "tool", "arguments", "after", "content")
    rows = rows.select(*columns, whole.alias("_whole"))
    named = rows.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    of_kind = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("_whole")))
    firsts = named.groupBy("conv_id", "call_id").agg(of_kind(CALL).alias("_call"), of_kind(RESULT).alias("_result"))
    firsts = write_through(firsts, "tool-ids")

    node = F.struct("conv_id", "call_id").alias("node")
    own = firsts.where(F.col("_call").isNotNull()).select("conv_id", node, F.col("_call.after").alias("_after"))
    ids = own.select(F.col("node").alias("_parent"))
    wanted = F.when(F.col("_after").isNotNull(), F.struct("conv_id", F.col("_after").alias("call_id")))
    edges = own.select("node", wanted.alias("_wanted")).join(ids, F.col("_wanted") == F.col("_parent"), "left")
    lost = F.col("_wanted").isNotNull() & F.col("_parent").isNull()
    edges = write_through(edges.select("node", F.col("_parent").alias("parent"), lost.alias("lost")), "tool-edges")
    ordered = edges.select("node", "lost").join(_depths(edges), "node").select("node.*", "depth", "lost")

    first = firsts.join(ordered, ["conv_id", "call_id"], "left")
    linked = rows.join(first, ["conv_id", "call_id"], "left")
    is_call = F.col("kind") == CALL
    same = F.col("_whole").eqNullSafe(F.when(is_call, F.col("_call")).otherwise(F.col("_result")))
    status = (
        F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no id")
        .when(~same, "repeated")
        .when(F.col("_call").isNull(), "orphan")
        .when(F.col("depth").isNull(), "cycle")
        .when(is_call & F.col("_result").isNull(), "unanswered")
        .when(is_call & F.col("lost"), "lost")
        .when(~is_call & (F.col("turn") < F.col("_call.turn")), "early")
        .otherwise("linked")
    )
    checked = F.when(is_call, argument_errors("tool", "arguments", schemas)).otherwise(
        F.when(F.col("_call").isNotNull(), argument_errors(F.col("_call.tool"), F.col("_call.arguments"), schemas))
    )
    # Fields in alphabetical order; what is parsed comes out with sorted keys by itself.
    keep = {"ignoreNullFields": "false"}

    def call_with(arguments: Column) -> Column:
        function = F.struct(arguments.alias("arguments"), F.col("tool").alias("name"))
        call = F.struct(function.alias("function"), F.col("call_id").alias("id"), F.lit("function").alias("type"))
        return F.to_json(F.struct(F.lit("assistant").alias("role"), F.array(call).alias("tool_calls")), keep)

    parsed = F.try_parse_json(F.coalesce("arguments", F.lit("{}")))
    as_text = call_with(F.struct(F.col("arguments").alias("text")))
    message = F.when(is_call, F.when(parsed.isNotNull(), call_with(parsed)).otherwise(as_text)).otherwise(F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id")), keep))
    return linked.select(
        "conv_id",
        "call_id",
        F.when(is_call, "call").otherwise("result").alias("kind"),
        "turn",
        "depth",
        status.alias("status"),
        (F.size(checked) == 0).alias("valid"),
        F.array_join(checked, "; ").alias("errors"),
        message.alias("message"),
    )
