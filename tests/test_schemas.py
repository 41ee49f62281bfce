"""Tool schemas against a restated check, on values of every type."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from quillon.functions import schemas
from quillon.operators import cases

VALUES = ["a", "b", "", 0, -5, 2**53, 2**70, 1.5, 1e300, True, False, None, [], [1, "a"], [1, 2], {}, {"x": 1}, {"x": "a", "y": [1]}]
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def fits(value, schema):
    kind = schema.get("type")
    if kind not in KINDS or isinstance(value, bool) and kind != "boolean" or not isinstance(value, KINDS[kind]):
        return False
    return kind != "string" or "enum" not in schema or value in schema["enum"]


def valid(arguments, schema):
    named = schema["properties"]
    return isinstance(arguments, dict) and all(r in arguments for r in schema.get("required", [])) and all(k in named and fits(v, named[k]) for k, v in arguments.items())


def test_values_of_every_type(spark):
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(VALUES)], "k int, t string").withColumn("v", F.parse_json("t"))
    for schema in [{"type": t} for t in KINDS] + [{"type": "string", "enum": ["a", 3]}, {"type": "date"}, {}]:
        got = {r["k"]: r["ok"] for r in frame.select("k", schemas.matches(F.col("v"), schema).alias("ok")).collect()}
        assert got == {k: fits(v, schema) for k, v in enumerate(VALUES)}, schema


def test_arguments(spark):
    schema = {"type": "object", "properties": {"name": {"type": "string"}, "n": {"type": "integer"}, "on": {"type": "string", "enum": ["x", "y"]}}, "required": ["name"]}
    given = [{"name": "a"}, {"name": "a", "n": 1}, {"name": 1}, {}, {"n": 1}, {"name": "a", "more": 1}, {"name": "a", "on": "x"}, {"name": "a", "on": "z"}, {"name": None}, {"name": "a", "n": True}, {"name": "a", "n": 1.5}, [], "name", None]
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(given)], "k int, t string").withColumn("v", F.parse_json("t"))
    got = {r["k"]: r for r in frame.select("k", schemas.valid_arguments(F.col("v"), schema).alias("ok"), schemas.valid_arguments(F.col("v"), {"type": "object", "properties": {}}).alias("none"), *[schemas.valid_arguments(F.col("v"), s).alias(n) for n, s in (("a", {"type": "array", "properties": {}}), ("b", {"type": "object"}), ("c", schema | {"required": "name"}))]).collect()}
    assert {k: r["ok"] for k, r in got.items()} == {k: valid(v, schema) for k, v in enumerate(given)}
    assert [k for k, r in got.items() if r["none"]] == [3] and not any(r[n] for r in got.values() for n in "abc")


def test_nested_arguments(spark):
    """With ``deep``, items and inner properties are checked as well."""
    schema = {"type": "object", "properties": {"people": {"type": "array", "items": {"type": "object", "properties": {"name": {"type": "string"}, "tags": {"type": "array", "items": {"type": "string"}}}, "required": ["name"]}}}}
    given = [{"people": []}, {"people": [{"name": "a", "tags": ["x"]}]}, {"people": [{"name": "a", "tags": [1]}]}, {"people": [{"name": "a"}, {}]}, {"people": ["a"]}, {"people": {}}]
    frame = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(given)], "k int, t string").withColumn("v", F.parse_json("t"))
    got = {r["k"]: (r["deep"], r["flat"]) for r in frame.select("k", schemas.valid_arguments(F.col("v"), schema, deep=True).alias("deep"), schemas.valid_arguments(F.col("v"), schema).alias("flat")).collect()}
    assert got == {0: (True, True), 1: (True, True), 2: (False, True), 3: (False, True), 4: (False, True), 5: (False, False)}


def test_sixteen_tools(spark):
    tools = cases.tool_schemas()
    assert len(tools) == 16 and [len(cases.input_schemas(d)) for d in ("contacts", "mobile_messages", "workspace_tasks")] == [4, 6, 6]
    assert tools["list_contacts"] == {"name": "list_contacts", "description": "List the available contact names.", "input_schema": {"type": "object", "properties": {}}, "output_schema": {"type": "object", "properties": {"contacts": {"type": "array"}}}}
    shown = spark.range(1).select(cases.public_tools(F.array(F.lit("get_draft_reply"), F.lit("lookup_contact"))).alias("t")).first()["t"]
    assert shown == json.dumps([tools["get_draft_reply"], tools["lookup_contact"]], sort_keys=True, separators=(",", ":"))
