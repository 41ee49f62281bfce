"""Steps of registered queries that must be made once, or in parts that follow the rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quillon.functions import jsontext
from quillon.operators import cases, rollout
from quillon.plans import episodes
from quillon.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["domain_results", "domain_decisions"])
def test_episodes_are_admitted_once(spark, monkeypatch, name):
    """Whatever counts admitted episodes reads one table of them."""
    asked, admitted = [], episodes.admitted
    monkeypatch.setattr(episodes, "admitted", lambda s, d: asked.append(d) or admitted(s, d))
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(asked) == 1 and "winner" not in plan


def test_quality_counts_read_one_table(spark):
    assert not [f for f in QUERIES["quality_counts"](spark, SF).inputFiles() if "orders" in f]


def test_grounding_is_dealt_by_rows(spark, monkeypatch):
    """1,200 conversations at 100 a task."""
    monkeypatch.setattr(episodes, "SORTED", 100)
    got = QUERIES["final_grounding"](spark, SF)
    parts = set(re.findall(r"hashpartitioning\(conv_id#\d+, (\d+)\)", got._jdf.queryExecution().executedPlan().toString()))
    assert parts == {str(max(4, got.count() // 100 + 1))}


def test_public_events_carry_no_definitions(spark):
    """Tools' definitions are in no shuffled row."""
    plan = QUERIES["public_events"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "input_schema" not in plan and "mapinarrow" in plan.lower()


def test_public_leaves_are_those_of_public_events(spark):
    """Of null and broken texts, unknown tools and what may not be public too."""
    known = cases.tool_schemas()
    texts = [None, "x", "[]", '[{"event_type":"action","tool_name":"lookup_contact","arguments":{"name":"/home/a","x":1}}]', '[{"event_type":"observation","tool_name":"none","observation":{"name":"a"}},{"content":"é","token":2}]']
    rows = spark.createDataFrame([(k, t, ["none", "lookup_contact"][k % 2 :]) for k, t in enumerate(texts)], "k long, e string, t array<string>")
    leaves = rows.select("k", F.explode(jsontext.json_leaves(jsontext.public_events("e", cases.public_tools(F.col("t"))))).alias("l")).select("k", "l.path", "l.value")
    got = jsontext.public_leaves(rows, "e", "t", known, "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, leaves.collect())) and got.count() > 4


@pytest.mark.parametrize(("name", "target"), [("contact_rollout", "contact_key"), ("message_rollout", "message_id"), ("workspace_rollout", "item_id")])
def test_responses_are_read_once_for_a_target(spark, monkeypatch, name, target):
    """Episodes of one target say the same again and again."""
    asked, read = [], rollout.read_decisions
    monkeypatch.setattr(rollout, "read_decisions", lambda rows, schemas: asked.append(rows) or read(rows, schemas))
    QUERIES[name](spark, SF)
    texts = asked[0].select(target, "content")
    assert texts.count() == texts.distinct().count() > 0


def test_replay_reads_the_texts_of_its_variants_alone(spark, monkeypatch):
    asked, read = [], rollout.read_decisions
    monkeypatch.setattr(rollout, "read_decisions", lambda rows, schemas: asked.append(rows) or read(rows, schemas))
    QUERIES["rollout_replay"](spark, SF)
    assert not asked[0].where("content like '%\" bad\"%'").count()
