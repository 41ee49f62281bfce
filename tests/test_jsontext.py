"""JSON of any depth against Python's own serialiser and the rules restated."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from quillon.functions import jsontext, text
from quillon.sources import artifacts


def anything(rng, depth=0):
    kinds = ["text", "number", "other"] + ["list", "object"] * (2 if depth < 5 else 0)
    kind = rng.choice(kinds)
    if kind == "text":
        return rng.choice(["", "plain", "/etc/passwd", "a /b c", "C:\\x", "q\"uo\\te", "ünï\u2028 \ud83d\ude00", "\x00\x1f\x7f", "Bearer x", "my PASSWORD", "http://a/b"])
    if kind == "number":
        return rng.choice([0, -1, 2**70, 1.0, -0.0, 1e16, 1e-7, 123456.789, 5e-324, 1.7976931348623157e308])
    if kind == "other":
        return rng.choice([None, True, False])
    if kind == "list":
        return [anything(rng, depth + 1) for _ in range(rng.randrange(4))]
    keys = ["a", "b", "Z", "é", "\u2028", "\ud83d\ude00", "", "api_key", "Author", "provider_id", "x_token_y", "Response", "total"]
    return {rng.choice(keys): anything(rng, depth + 1) for _ in range(rng.randrange(5))}


def clean(value):
    if isinstance(value, dict):
        return {k: clean(v) for k, v in value.items() if k.lower() in text.SAFE_KEYS or not any(p in k.lower() for p in text.FORBIDDEN_KEY_PARTS)}
    if isinstance(value, list):
        return [clean(v) for v in value]
    bad = isinstance(value, str) and value in ("/etc/passwd", "a /b c", "C:\\x", "Bearer x", "my PASSWORD")
    return "[redacted]" if bad else value


def canonical(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def test_any_value(spark):
    rng = random.Random(8)
    values = [anything(rng) for _ in range(400)]
    styles = [{}, {"indent": 1}, {"ensure_ascii": False}]
    rows = [(k, json.dumps(v, **styles[k % 3]).encode("utf-16", "surrogatepass").decode("utf-16")) for k, v in enumerate(values)]
    got = spark.createDataFrame(rows, "k int, t string").select("k", jsontext.canonical_json("t").alias("c"), jsontext.sanitized_json("t").alias("s"), jsontext.unsafe_json("t").alias("u"))
    for r in got.collect():
        value = values[r["k"]]
        assert r["c"] == canonical(value) and r["s"] == canonical(clean(value)) and r["u"] == (clean(value) != value or canonical(clean(value)) != canonical(value))


def test_odd_texts(spark):
    rows = [(None,), ("",), ("no",), ("[1] x",), ('{"a":1,"a":{"b":2}}',), (" 1.50 ",), ("[" * 100_000,), ("NaN",)]
    got = [r["c"] for r in spark.createDataFrame(rows, "t string").coalesce(1).select(jsontext.canonical_json("t").alias("c")).collect()]
    assert got == [None, None, None, None, '{"a":{"b":2}}', "1.5", None, "NaN"]
    leaves = spark.createDataFrame([('{"a":[1,{"b":null}],"c":{},"d":"x"}',)], "t string").select(jsontext.json_leaves("t").alias("l")).first()["l"]
    assert [tuple(x) for x in leaves] == [("$.a[0]", "1"), ("$.a[1].b", "null"), ("$.d", '"x"')]


def test_one_rule_for_columns_and_python(spark):
    """The column expressions and the Python predicates judge alike."""
    samples = ["/x", "~", "a/b", "a /b", "x:/y", "file://h", "http://h/p", "c:\\d", "ab~/c", "a ~/c", "SK-1", "bearer t", "Authorization: x", "the secret", "/", "a//b", "x /", "d/tmp/e", ""]
    keys = ["author", "tokens", "known_total_tokens", "Session", "name", "raw", "draw", "EXPECTED_x", "content"]
    frame = spark.createDataFrame([(x,) for x in samples + keys], "t string").select("t", text.forbidden_text(F.col("t")).alias("a"), text.forbidden_key(F.col("t")).alias("b"))
    for r in frame.collect():
        assert r["a"] == text.is_forbidden_text(r["t"]) and r["b"] == text.is_forbidden_key(r["t"]), r["t"]


def test_events_have_declared_fields(spark):
    tools = [{"name": "look", "input_schema": {"type": "object", "properties": {"name": {"type": "string"}}}, "output_schema": {"properties": {"email": {}}}}]
    events = [
        {"event_type": "action", "tool_name": "look", "arguments": {"name": {"token": 1, "n": ["/x"]}, "more": 1}}, {"event_type": "observation", "tool_name": "look", "observation": {"email": "e", "name": "n"}},
        {"event_type": "state_change", "tool_name": "other", "change": {"email": "e"}}, {"event_type": "error", "tool_name": "look", "error_code": "x"}, {"event_type": "final_response", "content": "see /etc"},
    ]
    got = spark.createDataFrame([(json.dumps(events), json.dumps(tools)), (None, json.dumps(tools)), ("x", None)], "e string, t string").coalesce(1).select(jsontext.public_events("e", "t").alias("p")).collect()
    want = [events[0] | {"arguments": {"name": {"n": ["[redacted]"]}}}, events[1] | {"observation": {"email": "e"}}, events[2] | {"change": {}}, events[3], events[4] | {"content": "[redacted]"}]
    assert [r["p"] for r in got] == [canonical(want), None, None]


def test_collections_are_clean_at_any_depth(spark, tmp_path):
    events = "array<struct<event_type:string,arguments:map<string,string>,token:string,inner:struct<note:string,list:array<string>>>>"
    row = (1, "demonstrations", "see /etc/x", "k", [("action", {"name": "Ann", "api_key": "k", "where": "~/x"}, "t", ("password", ["ok", "/private/x"]))], '{"deep":{"raw":1,"ok":["/tmp/x",2]}}')
    rows = spark.createDataFrame([row], f"sequence int, collection string, instruction string, secret_note string, events {events}, more string").withColumn("more", F.parse_json("more"))
    artifacts.write_collections(rows, str(tmp_path / "out"))
    got = json.loads(next((tmp_path / "out" / "collection=demonstrations").glob("part-*.json")).read_text())
    assert got == {"sequence": 1, "instruction": "[redacted]", "events": [{"event_type": "action", "arguments": {"name": "Ann", "where": "[redacted]"}, "inner": {"note": "[redacted]", "list": ["ok", "[redacted]"]}}], "more": {"deep": {"ok": ["[redacted]", 2]}}}
