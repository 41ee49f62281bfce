"""The rollout loop and its replay against the rules restated in Python."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from quillon.operators import cases, rollout
from quillon.operators.rollout import EVENT

CONTACTS = {"Ann": "ann@x.test", "Bob": "bob@x.test"}
TOOLS = {"lookup_contact": ["name"], "list_contacts": [], "record_followup": ["name", "note"], "get_followup": ["name"]}
KEYS = ("event_type", "tool_name", "arguments", "observation", "change", "content", "error_code")


class Contacts:
    """The tools of one contact task, one call after the other."""

    def __init__(self, action, route):
        self.action, self.route = action, route
        self.offered = ["lookup_contact", *(["list_contacts"] if route in ("directory", "recovery") else []), *(["record_followup"] if action == "record_followup" else []), *(["get_followup"] if action == "record_followup" and route == "verify" else [])]
        self.log, self.saved = [], None

    def call(self, tool, given):
        if tool not in self.offered:
            return "error", "unknown_tool"
        if set(given) != set(TOOLS[tool]) or not all(isinstance(v, str) for v in given.values()):
            return "error", "invalid_tool_arguments"
        name, known = given.get("name"), given.get("name") in CONTACTS
        self.log.append((tool, name))
        if tool == "lookup_contact":
            return ("observation", {"name": name, "email": CONTACTS[name]}) if known else ("error", "contact_not_found")
        if tool == "list_contacts":
            return "observation", {"contacts": '["Ann","Bob"]'}
        if tool == "get_followup":
            return ("observation", self.saved) if self.saved and self.saved["name"] == name else ("error", "followup_not_found")
        if name != "Ann":
            return "refused", "mutation_not_authorized"
        hits = [k for k, x in enumerate(self.log) if x == ("lookup_contact", "Ann")]
        lists = [k for k, x in enumerate(self.log) if x[0] == "list_contacts"]
        probes = [k for k, x in enumerate(self.log) if x == ("lookup_contact", "Ann (stale)")]
        ready = bool(hits) and (self.route not in ("directory", "recovery") or bool(lists) and lists[0] < hits[-1]) and (self.route != "recovery" or bool(probes))
        if not ready:
            return "refused", "mutation_condition_not_observed"
        if not 3 <= len(given["note"]) <= 160 or given["note"] != given["note"].strip():
            return "refused", "unsupported_note"
        if self.saved:
            return "refused", "unintended_state_change"
        self.saved = {"name": name, "note": given["note"]}
        return "state_change", self.saved


def public(v):
    return "[redacted]" if isinstance(v, str) and ("password" in v or v.startswith("/")) else v


def event(kind, tool=None, **more):
    return {k: None for k in KEYS} | {"event_type": kind, "tool_name": tool, **more}


def outcome(kind, tool, got):
    return event("error", tool, error_code=got) if isinstance(got, str) else event(kind, tool, **{"observation" if kind == "observation" else "change": {k: public(v) for k, v in got.items()}})


def episode(responses, action, route, limit, repairs):
    """(events, terminal_reason, mutation_authorization) of a list of texts or error codes."""
    world, events, authorized, steps, broken = Contacts(action, route), [], "not_applicable", 0, 0
    for text, error in responses:
        if steps == limit:
            break
        if text is None:
            return [*events, event("error", error_code=error or "agent_request_failed")], error or "agent_request_failed", authorized
        try:
            value = json.loads(text)
        except ValueError:
            value = None
        value = value if isinstance(value, dict) else {}
        call = value.get("type") == "tool_call" and set(value) == {"type", "tool_name", "arguments"} and isinstance(value["arguments"], dict) and isinstance(value["tool_name"], str) and 1 <= len(value["tool_name"]) <= 128
        final = value.get("type") == "final_response" and set(value) == {"type", "content"} and isinstance(value["content"], str) and value["content"]
        if not call and not final:
            events.append(event("error", error_code="malformed_agent_decision"))
            if broken == repairs:
                return events, "malformed_agent_decision", authorized
            broken += 1
            continue
        steps += 1
        if final:
            return [*events, event("final_response", content=public(value["content"]))], None, authorized
        tool, given = value["tool_name"], value["arguments"]
        events.append(event("action", tool, arguments=json.dumps({k: public(v) for k, v in given.items() if k in TOOLS.get(tool, [])}, sort_keys=True, separators=(",", ":"))))
        kind, got = world.call(tool, given)
        events.append(outcome(kind, tool, got))
        authorized = "authorized" if kind == "state_change" else authorized
        if kind == "refused":
            return events, "unauthorized_mutation", "rejected"
    reason = "step_budget_exhausted" if steps == limit else "agent_request_failed"
    return [*events, event("error", error_code=reason)], reason, authorized


def responses(rng):
    def call(tool, **given):
        return json.dumps({"type": "tool_call", "tool_name": tool, "arguments": given})

    pool = [
        *[call("lookup_contact", name="Ann")] * 4, call("lookup_contact", name="Bob"), *[call("lookup_contact", name="Ann (stale)")] * 2, *[call("list_contacts")] * 3, call("list_contacts", more=1), call("lookup_contact", name=5), call("lookup_contact"),
        *[call("record_followup", name="Ann", note="Call back")] * 3, call("record_followup", name="Ann", note="my password"), call("record_followup", name="Bob", note="Call back"), call("record_followup", name="Ann", note=" x"), *[call("get_followup", name="Ann")] * 2,
        call("dance", name="/x"), "no json", "[]", '{"type":"tool_call"}', '{"type":"final_response","content":""}', '{"type":"final_response","content":"done","why":1}', '{"type":"final_response","content":"All done"}', '{"type":"final_response","content":"/etc/x"}',
        '{"type":"x","type":"final_response","content":"last wins"}', '{"type":"tool_call","tool_name":"lookup_contact","arguments":{"name":5,"name":"Ann"}}',
    ]
    out = [(rng.choice(pool), None) for _ in range(rng.randrange(12))]
    return [(None, rng.choice(["provider_timeout", None])) if rng.random() < 0.03 else r for r in out]


def test_loop_equals_the_rules(spark):
    rng = random.Random(4)
    kinds = [("lookup_email", "direct"), ("lookup_email", "recovery"), ("record_followup", "direct"), ("record_followup", "directory"), ("record_followup", "recovery"), ("record_followup", "verify")]
    told = [(k, *kinds[k % 6], responses(rng)) for k in range(300)]
    frame = spark.createDataFrame([(k, a, r, "Ann", "open", None) for k, a, r, _ in told], "id int, action string, route string, target string, note_constraint string, exact_note string")
    rows = spark.createDataFrame([(k, i, *r) for k, _, _, rs in told for i, r in enumerate(rs)], "id int, idx int, content string, error_code string").repartition(5)
    schemas = cases.input_schemas("contacts")
    read = rollout.read_decisions(rows, schemas).withColumn("found", F.lit(None).cast("map<string,string>"))
    fields = F.struct("idx", "kind", "tool_name", "arguments", "call_error", "shown", "final_content", "unsafe", "error_code", "found")
    held = read.groupBy("id").agg(F.array_sort(F.collect_list(fields), lambda a, b: a["idx"] - b["idx"]).alias("responses"))
    none, world = F.lit(None).cast("map<string,string>"), F.create_map(*[F.lit(x) for pair in CONTACTS.items() for x in pair])
    step = rollout.contact_step(world)
    at = frame.join(held, "id", "left")
    got = {limit: rollout.ended(at, rollout.looped(F.col("responses"), cases.contact_tools(), none, step, *limit), limit[0]) for limit in ((12, 1), (3, 0))}
    seen = set()
    for limit, episodes in got.items():
        for r in episodes.collect():
            _, action, route, given = told[r["id"]]
            events, reason, authorization = episode(given, action, route, *limit)
            assert [e.asDict() for e in r["events"]] == events, (given, action, route)
            assert (r["terminal_reason"], r["mutation_authorization"]) == (reason, authorization)
            seen.add(reason)
    assert seen == {None, "unauthorized_mutation", "malformed_agent_decision", "step_budget_exhausted", "agent_request_failed", "provider_timeout"}
    # Every trace replays as it was saved.
    saved = got[12, 1].withColumns({"saved": F.col("events"), "saved_authorization": F.col("mutation_authorization")})
    again = rollout.replayed(saved, rollout.replayed_events(F.col("saved"), cases.contact_tools(), none, step, schemas), F.lit(True), F.lit(True)).where("not exists(events, e -> e.change['note'] = '[redacted]')")
    drifted = [r for r in again.collect() if r["status"] != "aligned"]
    # What was redacted or left out of the saved arguments can't run as it did.
    assert all(any(e["event_type"] == "error" and e["error_code"] == "invalid_tool_arguments" for e in r["events"]) for r in drifted) and len(drifted) < 150


def test_replay_statuses(spark):
    look = event("action", "lookup_contact", arguments='{"name":"Ann"}')
    hit, miss, end = event("observation", "lookup_contact", observation={"name": "Ann", "email": "ann@x.test"}), event("error", "lookup_contact", error_code="contact_not_found"), event("final_response", content="done")
    write, wrote = event("action", "record_followup", arguments='{"name":"Ann","note":"Call back"}'), event("state_change", "record_followup", change={"name": "Ann", "note": "Call back"})
    told = [
        ([look, hit, end], "not_applicable", True, True, "a", "aligned"), ([look, miss, end], "not_applicable", True, True, "a", "observation_drift"), ([look], "not_applicable", True, True, "a", "observation_drift"), ([look, hit, look], "not_applicable", True, True, "b", "observation_and_assessment_drift"),
        ([look | {"tool_name": None}, end], "not_applicable", True, True, "a", "observation_drift"), ([look, hit, write, wrote, end], "authorized", True, True, "a", "aligned"), ([look, hit, write, wrote, end], "rejected", True, True, "a", "observation_drift"),
        ([write, event("error", "record_followup", error_code="mutation_condition_not_observed")], "rejected", True, True, "a", "aligned"), ([look, hit, end], "not_applicable", True, True, "b", "assessment_drift"), ([look, hit, end], "not_applicable", True, False, "a", "replay_failed"),
        ([look, hit, end], "not_applicable", True, None, "a", "replay_failed"), ([], "not_applicable", False, False, "a", "not_executed"), ([], "not_applicable", True, True, "a", "aligned"), (None, "not_applicable", True, True, "a", "replay_failed"),
        ([event("action", "dance", arguments="{}"), event("error", "dance", error_code="unknown_tool"), end], "not_applicable", True, True, "a", "aligned"), ([look, look, hit], "not_applicable", True, True, "a", "observation_drift"),
    ]
    rows = [(k, "record_followup", "direct", "Ann", "open", None, e and [tuple(x[n] for n in KEYS) for x in e], *rest) for k, (e, *rest, _) in enumerate(told)]
    frame = spark.createDataFrame(rows, f"id int, action string, route string, target string, note_constraint string, exact_note string, saved array<{EVENT}>, saved_authorization string, has_case boolean, restored boolean, judged string")
    none, step = F.lit(None).cast("map<string,string>"), rollout.contact_step(F.create_map(F.lit("Ann"), F.lit("ann@x.test")))
    state = rollout.replayed_events(F.col("saved"), cases.contact_tools(), none, step, cases.input_schemas("contacts"))
    got = {r["id"]: r for r in rollout.replayed(frame, state, F.col("has_case"), F.col("restored"), (F.lit("a"), F.col("judged"))).collect()}
    assert [got[k]["status"] for k in range(len(told))] == [t[-1] for t in told]
    assert all(got[k]["observation_drift"] and got[k]["assessment_drift"] for k, t in enumerate(told) if t[-1] == "replay_failed")
