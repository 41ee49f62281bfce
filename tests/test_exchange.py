"""Requests and public records as JSON, and stored private cases, against Python's own."""

from __future__ import annotations

import base64
import json

from pyspark.sql import functions as F

from quillon.operators import cases, exchange, rollout

canonical = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"))


def test_agent_contexts(spark):
    events = [("action", "look", '{"name":"Ann"}', None, None, None, None), ("observation", "look", None, {"b": "2", "a": 'x"y'}, None, None, None), ("error", None, None, None, None, None, "oops"), ("final_response", None, None, None, None, "dóne", None)]
    names = ("event_type", "tool_name", "arguments", "observation", "change", "content", "error_code")
    frame = spark.createDataFrame([("Do \"it\"", events), ("Nothing", [])], f"instruction string, events array<{rollout.EVENT}>")
    tools = cases.public_tools(F.array(F.lit("lookup_contact")))
    got = [r["c"] for r in frame.coalesce(1).select(exchange.agent_context(F.col("instruction"), tools, F.col("events"), F.lit(7)).alias("c")).collect()]
    shown = [{n: json.loads(v) if n == "arguments" else v for n, v in zip(names, e, strict=True) if v is not None} for e in events]
    want = lambda text, history: canonical({"task": {"instruction": text, "tools": [cases.tool_schemas()["lookup_contact"]]}, "observable_history": history, "remaining_step_budget": 7})
    assert got == [want('Do "it"', shown), want("Nothing", [])]
    slots = spark.createDataFrame([([("s1", "Do\nit"), ("s2", "x")],)], "slots array<struct<slot_id:string,proposal_prompt:string>>")
    assert slots.select(exchange.generation_context(F.col("slots")).alias("c")).first()["c"] == canonical({"slots": [{"slot_id": "s1", "proposal_prompt": "Do\nit"}, {"slot_id": "s2", "proposal_prompt": "x"}]})


def test_records_leave_out_what_does_not_apply(spark):
    kind = "struct<passed:boolean,checks:array<struct<name:string,passed:boolean>>,reason_codes:array<string>,coverage_tags:array<string>,structural_key:string,state_change_evidence:string,task_type:string,difficulty:string>"
    rows = [((True, [("a", True)], [], ["t"], "k", None, "type", "easy"),), ((False, [], ["r"], [], "k", "e", "type", None),)]
    got = [json.loads(r["j"]) for r in spark.createDataFrame(rows, f"a {kind}").coalesce(1).select(exchange.assessment_record(F.col("a")).alias("j")).collect()]
    base = {"passed": True, "checks": [{"name": "a", "passed": True}], "reason_codes": [], "coverage_tags": ["t"], "structural_key": "k", "state_change_evidence": None, "review_stratification": {"task_type": "type", "difficulty": "easy"}}
    assert got == [base, {"passed": False, "checks": [], "reason_codes": ["r"], "coverage_tags": [], "structural_key": "k", "state_change_evidence": "e"}]
    gates = F.struct(*[F.lit(g != "assessment").alias(g) for g in exchange.GATES])
    record = lambda mode: json.loads(spark.range(1).select(exchange.admission_record(F.lit(mode), F.lit(False), gates, F.lit("fail"), F.lit("p")).alias("j")).first()["j"])
    plain = {"mode": "deterministic", "status": "rejected", "gates": {g: g != "assessment" for g in exchange.GATES}, "human_review_status": "unreviewed"}
    assert record("deterministic") == plain and record("enforced") == plain | {"mode": "enforced", "semantic_judgment": "fail", "semantic_policy_id": "p"}


def test_stored_cases(spark):
    texts = ["", "plain", "ünï 😀", "x" * 500]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").withColumn("s", exchange.stored(F.col("t")))
    assert {r["k"]: (r["s"], r["b"]) for r in frame.select("k", "s", exchange.unstored(F.col("s")).alias("b")).collect()} == {k: (base64.b64encode(t.encode("utf-16", "surrogatepass").decode("utf-16").encode()).decode(), t.encode("utf-16", "surrogatepass").decode("utf-16")) for k, t in enumerate(texts)}
    bad = spark.createDataFrame([("no*base64",), (base64.b64encode(b"\xff\xfe").decode(),), (None,)], "s string")
    assert [r["b"] for r in bad.select(exchange.unstored(F.col("s")).alias("b")).collect()] == [None] * 3
