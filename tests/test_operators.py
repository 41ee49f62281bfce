"""Operators against plain restatements of their rules on small and odd inputs."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions import canon, payload
from quillon.functions import text as T
from quillon.operators import admission, calibration, cases, decisions, evidence, reports, review, sequence, tasks, usage
from quillon.plans.queries import QUERIES

EPISODES = "sequence long, domain_id string, semantic_key string, terminal_reason string, mutation_authorization string, passed boolean, grounded boolean, unsafe boolean, reason_codes array<string>"


def episodes(rng, n):
    one = lambda good, bad: good if rng.random() < 0.8 else bad
    return [(i, rng.choice("ab"), rng.choice("klmno"), one(None, "step_budget_exhausted"), one("authorized", "rejected"), one(True, None), one(True, False), one(None, True), one(["x", "y"], None)) for i in range(1, n + 1)]


def test_winner_is_the_first_that_passes(spark):
    rows = episodes(random.Random(3), 160)
    got = {r["sequence"]: r for r in admission.semantic_dedup(admission.gate_admission(spark.createDataFrame(rows, EPISODES))).collect()}
    won = set()
    for i, _, key, ended, status, passed, grounded, unsafe, codes in rows:
        reason = ended or ("unsafe_public_material" if unsafe else "unauthorized_mutation" if status == "rejected" else "final_response_grounding_missing" if not grounded else None if passed else codes[0] if codes else "deterministic_assessment_failed")
        assert (got[i]["admitted"], got[i]["duplicate"]) == (reason is None and key not in won, key in won)
        assert got[i]["reason_code"] == ("duplicate_semantic_task" if key in won else reason) and got[i]["gates"]["semantic_key"]
        if reason is None:
            won.add(key)


def test_prefix_stops_at_the_target(spark):
    rows = [(i, d, i % 3 == 0) for d in ("a", "b") for i in range(1, 31)]
    frame = spark.createDataFrame(rows, "sequence long, domain_id string, admitted boolean")
    got = admission.accepted_prefix(frame, 4)
    assert got.groupBy("domain_id").agg(F.max("sequence").alias("m")).collect()[0]["m"] == 12
    assert admission.accepted_prefix(frame, 11).count() == 60
    assert admission.accepted_prefix(frame.limit(0), 4).count() == 0


def test_budget_equals_the_sequential_rule(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["agent", "task_generation"])) for i in range(1, 200)]
    got = {r["request_id"] for r in usage.budget_admitted(spark.createDataFrame(rows, "request_id long, role string"), 90, {"agent": 40, "task_generation": 70}).collect()}
    used, passed = {"agent": 0, "task_generation": 0}, set()
    for i, role in rows:
        if sum(used.values()) < 90 and used[role] < {"agent": 40, "task_generation": 70}[role]:
            used[role] += 1
            passed.add(i)
    assert got == passed


def test_unknown_tokens_stay_null(spark):
    frame = spark.createDataFrame([(1, "a", "x", "initial", "completed", None)], "request_id long, role string, logical_request_id string, request_kind string, status string, total_tokens long")
    row = usage.usage_summary(frame).first()
    assert (row["known_total_tokens"], row["unknown_usage_count"], row["retry_count"]) == (None, 1, 0)


def test_round_robin_takes_turns(spark):
    rows = [(i, s) for i, s in enumerate("aaaaabbc")]
    got = [r["sequence"] for r in review.round_robin(spark.createDataFrame(rows, "sequence long, stratum string"), ["stratum"], 5).collect()]
    assert got == [0, 5, 7, 1, 6]


def test_verdict_needs_five_dimensions(spark):
    rows = [(1, d, "pass") for d in review.DIMENSIONS] + [(2, d, "pass") for d in review.DIMENSIONS[:4]] + [(3, d, "fail" if d == "safety" else "uncertain") for d in review.DIMENSIONS]
    got = {r["episode_id"]: r["verdict"] for r in review.dimension_verdict(spark.createDataFrame(rows, "episode_id long, dimension string, verdict string")).collect()}
    assert got == {1: "pass", 2: None, 3: "fail"}


def test_thresholds_are_exact(spark):
    columns = "domain_id string, reviewed long, agree long, judge_pass long, false_pass long, human_pass long, false_fail long, critical_false_pass long"
    got = calibration.threshold_reasons(spark.createDataFrame([(None, 100, 85, 20, 1, 20, 2, 0), ("x", 10, 0, 10, 1, 1, 0, 0), ("y", 0, 0, 0, 0, 0, 0, 0)], columns)).collect()
    assert [r["reasons"] for r in got] == ["", "", "per_domain_false_pass_denominator_zero"]
    worse = calibration.threshold_reasons(spark.createDataFrame([(None, 100, 84, 19, 1, 19, 2, 1)], columns)).first()["reasons"]
    assert worse == "overall_agreement_below_threshold,overall_false_pass_above_threshold,overall_false_fail_above_threshold,critical_safety_false_pass_detected"


def test_route_needs_its_order(spark):
    rows = [(1, i, t, "") for i, t in enumerate(["stale", "failure", "directory", "target"])] + [(2, i, t, "") for i, t in enumerate(["directory", "stale", "failure", "target"])]
    kind = lambda name: lambda e: e["event_type"] == name
    traced = sequence.traces(spark.createDataFrame(rows, "conv_id long, idx int, event_type string, content string"))
    got = {r["conv_id"]: (r["direct"], r["by_directory"], r["by_recovery"]) for r in sequence.route_completion(traced, kind("target"), kind("directory"), kind("stale"), kind("failure")).collect()}
    assert got == {1: (True, True, True), 2: (True, True, False)}


def test_slots_of_contacts(spark):
    contacts = spark.createDataFrame([("Ann B",), ("ann b",), ("Cy",)], "name string")
    slots = tasks.contact_slots(contacts, spark.createDataFrame([("Cy",)], "name string"))
    assert slots.count() == 8 + 8 + 3
    assert slots.select("slot_id").distinct().count() == 19
    assert tasks.capacity(slots, 10).first() == (19, 10, False)


def test_containment_counts_are_exact(spark):
    bodies = [(1, "The launch checklist is due"), (2, "launch CHECKLIST is"), (3, "nothing here at all"), (4, None)]
    messages = spark.createDataFrame(bodies, "message_id long, body string")
    queries = spark.createDataFrame([(1, "Launch checklist is"), (3, "nothing here at all")], "message_id long, query string")
    got = {r["query_id"]: r["bodies"] for r in tasks.containment_counts(messages, queries).collect()}
    assert got == {1: 2, 3: 1}


def test_phrases_of_all_lengths_are_made_once(spark, monkeypatch):
    """Phrases shorter and longer than what is hashed at every place, in several passes and slices, against brute force; each query's text is read once."""
    from quillon.functions import phrases

    monkeypatch.setattr(phrases, "PASS", 16)
    rng = random.Random(3)
    bodies = ["".join(rng.choice("ab ") for _ in range(rng.choice([1, 5, 40, 70, 200, 900]))) for _ in range(150)] + ["ab" * 40_000, "ab" * 33, ""]
    asked = []
    for n in (1, 2, 31, 32, 33, 34, 63, 64, 65, 66, 127, 128, 129, 130, 255, 256, 257, 700) * 3:
        body = rng.choice([b for b in bodies if len(b) >= n])
        at = rng.randrange(len(body) - n + 1)
        asked += [body[at : at + n], body[at : at + n - 1] + "c"]
    read = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            read.add(len(part))
            yield part

    messages = spark.createDataFrame(list(enumerate(bodies)), "message_id long, body string")
    queries = spark.createDataFrame(list(enumerate(asked)), "message_id long, query string").mapInPandas(count, "message_id long, query string")
    got = {r["query_id"]: r["bodies"] for r in tasks.containment_counts(messages, queries).collect()}
    assert got == {k: n for k, q in enumerate(asked) if (n := sum(q in b for b in bodies))}
    assert read.value == len(asked)


def test_message_selectors_search_for_whole_bodies(spark, tmp_path):
    same = "the same opening of twenty-four characters"
    bodies = [same + " one", same + " two", "short", "a short one", "Launch CHECKLIST a", "my launch checklist b", "An invoice", "", None, "line\nbreak and more", "LINE\nbreak and more", "x"]
    spark.createDataFrame([(k, "s", b) for k, b in enumerate(bodies)], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ask = lambda b: next((q for q in ("launch checklist", "invoice") if q in b.lower()), b).lower()
    want = {k: sum(ask(b) in c.lower() for c in bodies if c is not None) for k, b in enumerate(bodies) if b is not None}
    got = QUERIES["message_unique_selectors"](spark, str(tmp_path)).collect()
    assert {r["query_id"]: r["bodies"] for r in got} == want and len(got) == len(want)
    assert want[0] == want[1] == 1 and want[2] == 2


def test_text_rules(spark):
    cases = [("/etc/passwd", True), ("see C:\\x now", True), ("go to ~/x", True), ("http://a.b/c", False), ("a/b", False), ("plain", False), ("my api_key", True), ("sk-1", True), ("x /y", True)]
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", T.forbidden_text(F.col("t")).alias("bad")).orderBy("i").collect()
    assert [r["bad"] for r in got] == [bad for _, bad in cases]
    keys = spark.createDataFrame([("provider_id",), ("raw_value",), ("name",)], "k string").select(T.forbidden_key(F.col("k")).alias("bad")).collect()
    assert [r["bad"] for r in keys] == [False, True, False]


def test_predicates_see_every_line(spark, tmp_path):
    bodies = ["first line\nnever on a later one", "Thanks a lot\nsecond", "Prepare the report\nx", "status: all is done\nx", "Thanks a lot", None]
    spark.createDataFrame([(k, "s", b) for k, b in enumerate(bodies)], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r)[1:] for r in QUERIES["text_predicates"](spark, str(tmp_path)).orderBy("message_id").collect()]
    no = (False,) * 4
    assert got == [(*no, True), (*no, False), (*no, False), (*no, False), (True, True, False, False, False), (None,) * 5]


def test_canonical_json_is_that_of_the_standard_library(spark):
    texts = ["plain", 'quo"te', "back\\slash", "line\nbreak\r\t\b\f", "\x01\x1f\x7f", "é ñ ß", "日本", "😀 pair", "", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r["k"]: r["c"] for r in rows.select("k", canon.canonical({"b": F.col("t"), "a": F.lit("x")}).alias("c")).collect()}
    assert got == {k: json.dumps({"b": t, "a": "x"}, sort_keys=True, separators=(",", ":")) for k, t in enumerate(texts)}
    spaced = {r["k"]: r["c"] for r in rows.select("k", canon.spaced({"b": F.col("t"), "a": F.lit("x")}).alias("c")).collect()}
    assert spaced == {k: json.dumps({"b": t, "a": "x"} if t is not None else {"a": "x"}, sort_keys=True) for k, t in enumerate(texts)}
    odd = ["Straße", " \u3000x\x1c", "ﬁne", "ſ", "ABC"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "k int, t string").select("k", canon.casefold(F.col("t")).alias("f"), canon.stripped(F.col("t")).alias("s")).orderBy("k").collect()
    assert [(r["f"], r["s"]) for r in got] == [(t.casefold(), t.strip()) for t in odd]


def test_what_counts_as_json(spark):
    texts = ['{"a": "x"}', " [1] ", '{"a": 1} x', '{"a": 1},{"b": 2}', "1] [2", '1} {"v":2', "{bad}", "", "null", '"s"', None, '{"a": true, "b": null}']
    p = payload.Payload(F.col("t"))
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", p.broken.alias("broken"), p.object.alias("object"), p.text("a").alias("a"), p.true("a").alias("true"), p.only("a").alias("only"), p.has("b").alias("b")).orderBy("k").collect()

    def parsed(t):
        try:
            return json.loads(t)
        except (TypeError, ValueError):
            return ValueError

    for r, t in zip(got, texts):
        value = parsed(t)
        fields = value if isinstance(value, dict) else {}
        assert (r["broken"], r["object"], r["true"], r["only"], r["b"]) == (value is ValueError, isinstance(value, dict), fields.get("a") is True, set(fields) == {"a"}, "b" in fields), t
        assert r["a"] == (fields.get("a") if isinstance(fields.get("a"), str) else None)


def test_judgments_are_checked(spark):
    kind = "array<struct<dimension:string,verdict:string,reason_codes:array<string>,event_indexes:array<int>>>"
    good = [(d, "pass", [], [0]) for d in review.DIMENSIONS]
    bad = lambda k, row: [*good[:k], row, *good[k + 1 :]]
    rows = [
        (None, "available", "pass", None, "j", 2, good), ("verdict_missing", "available", "unavailable", None, "j", 2, good), ("dimensions_incomplete", "available", "pass", None, "j", 2, good[:4]), ("verdict_mismatch", "available", "fail", None, "j", 2, good),
        ("judge_identity_missing", "available", "pass", None, None, 2, good), ("unknown_event", "available", "pass", None, "j", 2, bad(0, ("instruction_fidelity", "pass", [], [2]))), ("no_event_reference", "available", "pass", None, "j", 2, bad(0, ("instruction_fidelity", "pass", [], []))),
        ("pass_with_reasons", "available", "pass", None, "j", 2, bad(4, ("safety", "pass", ["unsafe_action"], [0]))), ("no_reason", "available", "fail", None, "j", 2, bad(4, ("safety", "fail", [], [0]))), ("event_references_repeat", "available", "pass", None, "j", 2, bad(4, ("safety", "pass", [], [1, 1]))),
        ("unknown_reason", "available", "fail", None, "j", 2, bad(4, ("safety", "fail", ["because"], [0]))), (None, "available", "fail", None, "j", 2, bad(4, ("safety", "fail", ["unsafe_action"], [0]))), (None, "unavailable", "unavailable", "not_requested", None, 2, []),
        ("unavailable_with_dimensions", "unavailable", "unavailable", "not_requested", None, 2, good), ("unavailable_with_dimensions", "unavailable", "unavailable", "lost", None, 2, None),
    ]
    frame = spark.createDataFrame(rows, f"want string, availability string, verdict string, unavailable_reason string, judge_id string, event_count int, dimensions {kind}")
    assert [r["error"] for r in decisions.judgment_errors(frame).collect()] == [r[0] for r in rows]


def test_policies(spark):
    names = (*evidence.IDENTITIES, *evidence.SETTINGS, *evidence.SCOPES)
    schema = ", ".join(f"{n} string" for n in names) + ", domain_scopes array<string>"
    base = {n: n for n in names}
    rows = [tuple((base | change)[n] for n in names) + (scopes,) for change, scopes in (({}, ["d"]), ({"judge_prompt_id": None}, ["d"]), ({}, []), ({"judge_identity": "agent_identity"}, ["d"]))]
    assert [r["reason"] for r in evidence.policy_reasons(spark.createDataFrame(rows, schema)).collect()] == [None, "policy_identity_or_scope_missing", "policy_identity_or_scope_missing", "policy_judge_identity_not_independent"]
    policy = spark.createDataFrame([("p", "f")], "policy_id string, fingerprint string")
    bound = lambda *rows: evidence.frozen_policy(spark.createDataFrame(list(rows), "policy_id string, policy_fingerprint string"), policy).first()["frozen"]
    assert (bound(("p", "f"), ("p", "f")), bound(("p", "f"), (None, None)), bound()) == (True, False, False)


def test_membership_hash_binds_a_cohort(spark):
    fields = dict(cohort_id="c", purpose="held-out-evaluation", selection_method="operator_selected", campaign_id=None, quality_policy_id=None, quality_policy_fingerprint=None, episode_ids=["e1", "e2"], stratified_pass_stratum_count=3)
    frame = spark.createDataFrame([("c", "held-out-evaluation", ["e1", "e2"], "operator_selected", 3, None, None, None)], "cohort_id string, purpose string, episode_ids array<string>, selection_method string, stratum_count int, campaign_id string, policy_id string, policy_fingerprint string")
    want = "sha256:" + hashlib.sha256(json.dumps(fields, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert review.membership_hash(frame).first()["membership_hash"] == want


def test_a_missing_item_has_a_free_name(spark):
    items = lambda *queries: spark.createDataFrame([("document", q) for q in queries] + [("task", "archived roadmap")], "kind string, query string")
    first = lambda *queries: cases.missing_query(items(*queries)).first()[0]
    assert first() == "archived roadmap" and first("archived roadmap") == "archived roadmap unavailable 1"
    assert first("archived roadmap", "archived roadmap unavailable 1", "archived roadmap unavailable 3", "archived roadmap unavailable x") == "archived roadmap unavailable 2"


def test_cohort_members_must_be_there(spark):
    members = spark.createDataFrame([("c", 1, "e1"), ("c", 2, "e2")], "cohort_id string, position int, episode_id string")
    known = spark.createDataFrame([("e1", "see /tmp/x"), ("e2", "fine")], "episode_id string, body string")
    assert {r["body"] for r in review.blind_queue(members, known, ["body"]).collect()} == {"[redacted]", "fine"}
    with pytest.raises(Exception, match="no such episode: e2"):
        review.blind_queue(members, known.limit(1), ["body"]).collect()
    admitted = spark.createDataFrame([("e1", True), ("e2", False)], "episode_id string, admitted boolean")
    assert review.held_out_cohort(admitted).first()["selection_method"] == "held_out_all_deterministically_eligible"
    with pytest.raises(ValueError):
        review.held_out_cohort(admitted, admitted.select("episode_id"))
    assert review.unjudged(admitted, admitted.where("admitted")).count() == 1


def test_slots_and_reports(spark):
    slots = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "sequence int, slot_id string")
    assert decisions.bounded_slots(slots, 2).count() == 2
    with pytest.raises(ValueError):
        decisions.bounded_slots(slots, 3)
    ids = spark.createDataFrame([("fine-id", "sk-secret", None)], "run_id string, model_id string, policy_id string")
    assert [r["field"] for r in decisions.unsafe_identifiers(ids, "run_id", "model_id", "policy_id").collect()] == ["model_id"]
    report = json.loads(reports.as_json(spark.createDataFrame([("s", "b", 2), ("s", "a", 1), ("r", None, 3)], "section string, name string, n long").where("name is not null")).first()["report"])
    assert json.loads(report["s"]) == {"a": 1, "b": 2}


def test_containment_compares_only_what_is_held(spark):
    """Bodies that all begin and end alike, of one length or of many: a row for each that is held, none for the others that share their beginnings, whatever their number."""
    from quillon.functions.phrases import PASS, holding, phrases

    texts = [f"Please read the report of Supplier#{k:09d} about {k % 25}" for k in range(2000)] + ["a", "", "READ THE REPORT", "Straße", "STRASSE 7", None, "x" * 70, "x" * 64, "x" * 33]
    rows = spark.createDataFrame(list(enumerate(texts)), "message_id int, body string")
    asked = phrases(rows, "message_id", "body")
    assert holding(rows, "message_id", "body", asked).count() < 4 * len(texts) and len(texts) < PASS
    got = sorted(map(tuple, tasks.containment_pairs(rows, rows.withColumnRenamed("body", "query")).collect()))
    folded = [(k, t.casefold()) for k, t in enumerate(texts) if t is not None]
    assert got == sorted((q, m) for q, a in folded if a for m, b in folded if a in b)
