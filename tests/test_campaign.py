"""Campaign results and decisions, the pilot's report, and a policy's evaluation: an accepted base, and what each change to it comes to."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quillon.operators import activation, campaign, evidence, reports

EPISODE = "domain_id string, sequence int, episode_id string, admitted boolean, gates_passed boolean, mutation_authorization string, agent_requests int, structural_key string, reason_code string"
PLAN = "domain_id string, target int, slot_limit int, family_floor int"


def episodes(n=10, **change):
    out = []
    for k in range(1, n + 1):
        row = {"domain_id": "a", "sequence": k, "episode_id": f"e{k}", "admitted": True, "gates_passed": True, "mutation_authorization": "authorized", "agent_requests": 1, "structural_key": f"f{k % 4}", "reason_code": None}
        out.append(row | (change.get(f"e{k}") or {}))
    return out


def test_results_count_all_and_the_first(spark):
    rows = [*episodes(12, e3={"admitted": False, "reason_code": None}, e5={"agent_requests": None}, e12={"structural_key": None, "mutation_authorization": "rejected"}), *[{**r, "domain_id": "b", "admitted": False, "reason_code": "x"} for r in episodes(2)]]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], EPISODE)
    usage = spark.createDataFrame([("a", 100, 0), ("a", None, 0), ("b", 5, 1)], "domain_id string, known_total_tokens long, unknown_usage_count long")
    runs = spark.createDataFrame([("a", "completed", 12, 7.0, True), ("b", "partial", 2, 1.0, False), ("c", "partial", 0, 0.5, True)], "domain_id string, run_status string, task_attempt_count long, elapsed_seconds double, replay_aligned boolean")
    got = {r["domain_id"]: r.asDict() for r in campaign.domain_results(frame, usage, runs, 10).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["demonstration_count"], a["negative_count"], a["selected_count"], a["selected_without_agent_rollout_count"], a["all_selected_agent_rollouts"], a["all_selected_deterministic_gates_pass"]) == (11, 1, 10, 1, False, True)
    assert json.loads(a["family_distribution"]) == {"f0": 2, "f1": 3, "f2": 3, "f3": 2} and (a["family_count"], a["largest_family_share"]) == (4, 0.3) and json.loads(a["rejection_causes"]) == {"unspecified": 1}
    # Tokens and seconds are per demonstration, not per selected one.
    assert (a["known_tokens_per_deterministic_episode"], a["elapsed_seconds_per_deterministic_episode"], a["selected_unauthorized_mutation_count"]) == (9.091, 0.636, 0)
    assert (b["selected_count"], b["largest_family_share"], b["known_tokens_per_deterministic_episode"], b["elapsed_seconds_per_deterministic_episode"]) == (0, None, None, None) and json.loads(b["rejection_causes"]) == {"x": 2}
    assert (c["terminal_outcome_count"], c["known_total_tokens"], c["all_selected_agent_rollouts"], c["family_distribution"]) == (0, 0, False, "{}")


BASE = {
    "plan": ("a", 10, 12, 4), "run": {"run_status": "completed", "task_attempt_count": 12, "elapsed_seconds": 5.0, "replay_aligned": True}, "episodes": episodes(), "hash": "h", "order": [f"e{k}" for k in range(1, 11)],
    "labels": [("a", "c", "held-out-evaluation", f"e{k}", "fail" if k == 1 else "pass", False) for k in range(1, 11)], "import": ("a", campaign.IMPORT_SCHEMA, True, "c", "h", 10), "told": {},
}


def decide(spark, *cases):
    """The decisions on domains a0, a1, ..., one for each of ``cases``, and on z, which didn't run."""
    names = [f"a{k}" for k in range(len(cases))]
    every = lambda make, kind: spark.createDataFrame([row for name, x in zip(names, cases, strict=True) for row in make(name, x)], kind)
    frame = every(lambda n, x: [(n, *tuple(r.values())[1:]) for r in x["episodes"]], EPISODE)
    usage = every(lambda n, x: [(n, 90, 0)], "domain_id string, known_total_tokens long, unknown_usage_count long")
    runs = every(lambda n, x: [(n, *x["run"].values())], "domain_id string, run_status string, task_attempt_count long, elapsed_seconds double, replay_aligned boolean")
    told = every(lambda n, x: [(n, x["hash"], x["told"].get("family_distribution"), x["told"].get("duplicate_semantic_task_count"))], "domain_id string, cohort_membership_hash string, told_families string, told_duplicates long")
    results = campaign.domain_results(frame, usage, runs, 10).join(told, "domain_id")
    results = results.withColumns({"family_distribution": F.coalesce("told_families", "family_distribution"), "duplicate_semantic_task_count": F.coalesce("told_duplicates", "duplicate_semantic_task_count")}).drop("told_families", "told_duplicates")
    expected = every(lambda n, x: [(n, k, e) for k, e in enumerate(x["order"], 1)], "domain_id string, position int, episode_id string")
    cohorts = every(lambda n, x: [(n, "c", "h", k, f"e{k}") for k in range(1, 11)], "domain_id string, cohort_id string, membership_hash string, position int, episode_id string")
    labels = every(lambda n, x: [(n, *r[1:]) for r in x["labels"]], "domain_id string, cohort_id string, purpose string, episode_id string, verdict string, critical boolean")
    imports = every(lambda n, x: [(n, *x["import"][1:])], "domain_id string, schema_version string, complete boolean, cohort_id string, membership_hash string, imported_label_count int")
    plan = spark.createDataFrame([(n, *x["plan"][1:]) for n, x in zip(names, cases, strict=True)] + [("z", 5, 9, 1)], PLAN)
    got = campaign.domain_decisions(plan, results, frame.where("admitted"), expected, cohorts, labels, imports)
    rows = got.collect()
    return {r["domain_id"]: r for r in rows}, spark.createDataFrame(rows, got.schema)


def test_decision_of_a_domain(spark):
    got, frame = decide(spark, BASE)
    a = got["a0"]
    assert (a["status"], a["deterministic_gates_pass"], a["human_review_status"], a["human_pass_count"], a["human_pass_rate"], a["missing_label_count"], a["known_tokens_per_human_passed_episode"], a["elapsed_seconds_per_human_passed_episode"]) == ("passed", True, "complete", 9, 0.9, 0, 10.0, 0.556)
    assert (got["z"]["status"], got["z"]["human_review_status"], got["z"]["reviewed_count"], got["z"]["denominator"]) == ("not_run", "not_started", None, 5)
    ready = campaign.readiness(spark.createDataFrame([(n, "passed", "log") for n in campaign.ENGINEERING_CHECKS], "name string, status string, evidence string"))
    whole = campaign.campaign_decision(frame, ready).first()
    assert (whole["dataset_status"], whole["denominator"], whole["reviewed_count"], whole["core_cutover_status"]) == ("incomplete", 15, 10, "blocked")
    one = frame.where("domain_id = 'a0'")
    assert [tuple(campaign.campaign_decision(one, e, failed).first()[c] for c in ("dataset_status", "engineering_status", "core_cutover_status")) for e, failed in ((ready, False), (ready, True), (ready.withColumn("status", F.lit("pending")), False))] == [("passed", "passed", "ready"), ("failed", "passed", "blocked"), ("passed", "pending", "blocked")]


def test_each_flaw_of_a_domain(spark):
    changes = [
        ({"run": BASE["run"] | {"run_status": "partial"}}, "failed"), ({"run": BASE["run"] | {"task_attempt_count": 13}}, "failed"), ({"run": BASE["run"] | {"replay_aligned": False}}, "failed"), ({"plan": ("a", 10, 12, 5)}, "failed"), ({"hash": "x"}, "failed"),
        ({"episodes": episodes(e4={"agent_requests": 0})}, "failed"), ({"episodes": episodes(e4={"mutation_authorization": "rejected"})}, "failed"), ({"episodes": episodes(e4={"gates_passed": False})}, "failed"), ({"episodes": episodes(**{f"e{k}": {"structural_key": "f0"} for k in (1, 2, 3)})}, "failed"),
        ({"episodes": [*episodes(), {**episodes()[0], "sequence": 11}]}, "failed"), ({"told": {"family_distribution": "{}"}}, "failed"), ({"told": {"duplicate_semantic_task_count": 1}}, "failed"),
        ({"labels": BASE["labels"][1:]}, "incomplete"), ({"import": ("a", campaign.IMPORT_SCHEMA, False, "c", "h", 10)}, "incomplete"), ({"import": ("a", "other", True, "c", "h", 10)}, "incomplete"), ({"import": ("a", campaign.IMPORT_SCHEMA, True, "c", "x", 10)}, "incomplete"),
        ({"import": ("a", campaign.IMPORT_SCHEMA, True, "c", "h", 9)}, "incomplete"), ({"labels": [(*r[:4], "uncertain" if k < 2 else "pass", False) for k, r in enumerate(BASE["labels"])]}, "failed"), ({"labels": [(*r[:5], k == 3) for k, r in enumerate(BASE["labels"])]}, "failed"),
    ]
    got, _ = decide(spark, *[BASE | change for change, _ in changes])
    assert [got[f"a{k}"]["status"] for k in range(len(changes))] == [status for _, status in changes]


def test_labels_and_cohorts_are_the_selected_ones(spark):
    for change in ({"order": ["e2", "e1", *[f"e{k}" for k in range(3, 11)]]}, {"order": [f"e{k}" for k in range(1, 10)]}):
        with pytest.raises(ValueError, match="membership"):
            decide(spark, BASE | change)
    for label in (("a", "c", "held-out-evaluation", "e1", "pass", False), ("a", "x", "held-out-evaluation", "e11", "pass", False), ("a", "c", "diagnostic-development", "e11", "pass", False)):
        with pytest.raises(ValueError, match="labels"):
            decide(spark, BASE | {"labels": [*BASE["labels"], label]})


def test_readiness(spark):
    every = [(n, "passed", "log") for n in campaign.ENGINEERING_CHECKS]
    told = lambda rows, **more: tuple(campaign.readiness(spark.createDataFrame(rows, "name string, status string, evidence string"), **more).first())
    assert told(every) == ("passed", [], []) and told([]) == ("pending", sorted(campaign.ENGINEERING_CHECKS), []) and told(every, bound=False) == ("incomplete", sorted(campaign.ENGINEERING_CHECKS), [])
    assert told(every[1:]) == ("incomplete", [every[0][0]], []) and told([*every[:6], (every[6][0], "passed", ""), (every[7][0], "failed", "log"), ("more", "failed", "")]) == ("failed", [], sorted([every[6][0], every[7][0]]))


def test_pilot(spark):
    kind = "episode_id string, collection string, admitted boolean, reason_code string, mutation_authorization string, events array<struct<event_type:string,tool_name:string,error_code:string>>, assessment struct<passed:boolean,structural_key:string,reason_codes:array<string>>"
    direct = ("1", "demonstrations", True, None, "not_applicable", [], (True, "contacts.lookup.direct", []))
    wrote = ("2", "demonstrations", True, None, "authorized", [("state_change", "record_followup", None)], (True, "contacts.followup.open.direct", []))
    again = ("3", "demonstrations", True, None, "not_applicable", [("error", "lookup_contact", "contact_not_found")], (True, "contacts.lookup.recovery", []))
    lost = ("4", "negatives", False, None, "not_applicable", [("error", None, "contact_not_found")], None)
    told = lambda rows, **more: reports.pilot_report(spark.createDataFrame(rows, kind), **({"replay_aligned": True, "target": 3, "attempt_limit": 4} | more)).first().asDict()
    got = told([direct, wrote, again, lost])
    assert (got["diagnostic_outcome"], got["attempted"], got["executed_episode_count"], got["passed_assessment_count"], got["target_demonstrations_met"]) == ("required_behaviors_observed", 4, 3, 3, True)
    assert [told(rows)[name] for rows, name in (([wrote, again], "direct_lookup"), ([direct, (*wrote[:5], [], wrote[6])], "authorized_mutation"), ([(*again[:5], [], again[6])], "successful_recovery"), ([(*wrote[:4], "rejected", *wrote[5:])], "authorized_mutation"))] == [False] * 4
    assert told([direct, wrote, again], replay_aligned=False)["diagnostic_outcome"] == told([direct, wrote, again, lost], attempt_limit=3)["diagnostic_outcome"] == told([direct, wrote])["diagnostic_outcome"] == "insufficient_evidence"
    assert tuple(reports.pilot_failures(spark.createDataFrame([direct, lost], kind)).first()) == ("4", "unspecified_failure", [])


def test_preflight_wants_all_of_it(spark):
    one = {"provider_id": "p", "model_id": "m", "model_version": "1"}
    judge = one | {"model_id": "j"}
    settings = {n: "x" for n in (*evidence.SETTINGS, *evidence.SCOPES)}
    act = {"eligibility": "eligible", "policy_id": "pol", "policy_fingerprint": "f", "ineligibility_reasons": []}
    run = {
        "admission_mode": "enforced", "policy": {"policy_id": "pol", "fingerprint": "f", "rubric_id": "r", "domain_scopes": [{"domain_id": "d", "domain_version": "1"}], "judge_identity": judge, "generator_identity": one, "agent_identity": one, **settings}, "activation": act, "recomputed": act,
        "domain_id": "d", "domain_version": "1", "model_identity": one, "configuration": settings, "quality": {"mode": "shadow", "judge_model_id": "j", "rubric_id": "r", "judge_prompt_id": "x", "judge_decoding_id": "x"}, "judge_identity": judge,
    }
    ident = "struct<provider_id:string,model_id:string,model_version:string>"
    texts = ",".join(f"{n}:string" for n in settings)
    reported = "struct<eligibility:string,policy_id:string,policy_fingerprint:string,ineligibility_reasons:array<string>>"
    schema = f"admission_mode string, policy struct<policy_id:string,fingerprint:string,rubric_id:string,domain_scopes:array<struct<domain_id:string,domain_version:string>>,judge_identity:{ident},generator_identity:{ident},agent_identity:{ident},{texts}>, activation {reported}, recomputed {reported}, domain_id string, domain_version string, model_identity {ident}, configuration struct<{texts}>, quality struct<mode:string,judge_model_id:string,rubric_id:string,judge_prompt_id:string,judge_decoding_id:string>, judge_identity {ident}"
    changes = [
        ({}, None), ({"policy": None, "admission_mode": "deterministic"}, None), ({"policy": None}, "requires semantic enforcement evidence"), ({"activation": act | {"eligibility": "ineligible"}}, "is ineligible"), ({"activation": act | {"policy_id": "x"}}, "does not bind its policy"),
        ({"recomputed": act | {"ineligibility_reasons": ["x"]}}, "does not match frozen evidence"), ({"domain_version": "2"}, "does not cover this Domain version"), ({"domain_id": None}, "Domain identity is unavailable"), ({"model_identity": None}, "generator and Agent identity is unavailable"),
        ({"model_identity": judge}, "identity differs from activation"), ({"configuration": settings | {"source_scope_id": "y"}}, "source, task, or model settings differ"), ({"quality": run["quality"] | {"judge_model_id": "k"}}, "judge settings differ"), ({"judge_identity": None}, "judge identity is unavailable"), ({"judge_identity": one}, "judge identity is unavailable"),
    ]
    rows = spark.createDataFrame([run | c for c, _ in changes], schema)
    got = [r["reason"] for r in evidence.enforcement_preflight(rows.coalesce(1)).collect()]
    assert all((g is None) == (w is None) and (w is None or w in g) for g, (_, w) in zip(got, changes, strict=True)), got


NAMES = (*evidence.IDENTITIES, *evidence.SETTINGS, *evidence.SCOPES)
EVIDENCE = ("evidence_id", "episode_id", "domain_id", "domain_version", "deterministic_eligible", "semantic_task_group", "grounding_group", "task_type", "difficulty", "structural_family", "judge_verdict", "human_verdict", "critical", *NAMES)


def proof(prefix, n=100, **change):
    """``n`` episodes of two domains on which judge and human agree: four of five pass."""
    out = []
    for k in range(n):
        verdict = "fail" if k % 5 == 0 else "pass"
        row = dict.fromkeys(NAMES, "x") | {"evidence_id": f"{prefix}{k}", "episode_id": f"{prefix}e{k}", "domain_id": "ab"[k % 2], "domain_version": "1", "deterministic_eligible": True, "semantic_task_group": f"{prefix}s{k}", "grounding_group": f"{prefix}g{k}", "task_type": "t", "difficulty": "d", "structural_family": "f", "judge_verdict": verdict, "human_verdict": verdict, "critical": False, "judge_identity": "j"}
        out.append(row | change.get(f"r{k}", {}))
    return out


def judged(spark, dev=None, held=None, **more):
    x = {"policy": {}, "dev_method": activation.STRATIFIED, "held_method": activation.HELD_OUT, "strata": 1, "bound": ("p", "f"), "purposes": ("diagnostic-development", "held-out-evaluation"), "gone": 0, "dev_members": None, "held_members": None, "scopes": ["a", "b"]} | more
    kinds = ", ".join(f"{n} {'boolean' if n in ('deterministic_eligible', 'critical') else 'string'}" for n in EVIDENCE)
    frame = lambda rows: spark.createDataFrame([tuple(r[n] for n in EVIDENCE) for r in rows], kinds)
    dev, held = dev or proof("d"), held or proof("h")
    member = lambda ids, rows: spark.createDataFrame([(k, i) for k, i in enumerate(ids if ids is not None else [r["evidence_id"] for r in rows])], "position int, evidence_id string")
    cohort = lambda method, bound: spark.createDataFrame([("c", method, *bound, x["strata"])], "cohort_id string, selection_method string, policy_id string, policy_fingerprint string, stratum_count int")
    own = {"policy_id": "p", "fingerprint": "f", "domain_scopes": x["scopes"], **dict.fromkeys(NAMES, "x"), "judge_identity": "j"} | x["policy"]
    policy = spark.createDataFrame([tuple(own.values())], "policy_id string, fingerprint string, domain_scopes array<string>, " + ", ".join(f"{n} string" for n in NAMES))
    scopes = spark.createDataFrame([(s, "1") for s in x["scopes"]], "domain_id string, domain_version string")
    got = activation.activation(policy, scopes, activation.Campaign(x["purposes"][0], x["gone"], cohort(x["dev_method"], (None, None)), member(x["dev_members"], dev), frame(dev)), activation.Campaign(x["purposes"][1], 0, cohort(x["held_method"], x["bound"]), member(x["held_members"], held), frame(held))).first()
    assert (got["eligibility"] == "eligible") == (got["ineligibility_reasons"] == [])
    return got["ineligibility_reasons"]


def test_evaluation_in_one_list(spark):
    assert judged(spark) == []
    assert judged(spark, policy={"judge_prompt_id": None}) == ["policy_identity_or_scope_missing", "evaluation_model_settings_mismatch"]
    assert judged(spark, purposes=("x", "y"), gone=1, strata=0, bound=("p", None)) == ["development_campaign_purpose_invalid", "development_evidence_unavailable", "development_passes_not_stratified", "evaluation_campaign_purpose_invalid", "evaluation_policy_not_frozen_before_review"]
    assert judged(spark, dev_members=["none", "d1", *[f"d{k}" for k in range(100)]]) == ["development_cohort_membership_invalid"]
    assert judged(spark, dev_members=[f"d{k}" for k in range(100) if k % 2 or k < 40]) == ["development_review_quota_not_met", "development_nonpass_or_unavailable_not_fully_reviewed", "development_domain_review_quota_not_met"]
    assert judged(spark, dev=proof("d", r1={"difficulty": None})) == ["development_passes_not_stratified"]


def test_evaluation_of_the_held_out(spark):
    assert judged(spark, held=proof("h", 101, r100={"judge_verdict": "unavailable", "human_verdict": None})) == ["evaluation_human_labels_incomplete"]
    assert judged(spark, held=proof("h", 120), held_members=[f"h{k}" for k in range(110)]) == ["evaluation_selection_not_deterministically_complete"]
    assert judged(spark, held=proof("h", r3={"grounding_group": "dg3"})) == ["evaluation_reuses_development_evidence"]
    assert judged(spark, held=proof("h", r3={"semantic_task_group": None})) == ["evaluation_reuses_development_evidence", "evaluation_canonical_group_evidence_missing"]
    assert judged(spark, scopes=["a", "b", "c"]) == ["development_domain_review_quota_not_met", "evaluation_domain_review_quota_not_met", "evaluation_domain_scope_mismatch"]
    # Reasons of the scope come as episodes are met, each once.
    held = proof("h", r2={"judge_identity": "z"}, r4={"agent_identity": "z", "deterministic_eligible": False}, r6={"task_distribution_scope_id": "z"}, r8={"judge_identity": "z"})
    assert judged(spark, held=held) == ["evaluation_selection_not_deterministically_complete", "evaluation_judge_identity_mismatch", "evaluation_contains_noneligible_episode", "evaluation_generator_or_agent_identity_mismatch", "evaluation_source_or_task_scope_mismatch"]


def test_evaluation_by_rates(spark):
    wrong = lambda ks, judge, human, **more: proof("h", **{f"r{k}": {"judge_verdict": judge, "human_verdict": human} | more for k in ks})
    assert judged(spark, held=wrong([1, 2, 3, 4, 6], "pass", "fail")) == ["overall_false_pass_above_threshold"]
    assert judged(spark, held=wrong([1, 3, 7, 9, 11], "pass", "uncertain")) == ["overall_false_pass_above_threshold", "per_domain_false_pass_above_threshold"]
    assert judged(spark, held=wrong([k for k in range(100) if k % 5][:9], "unavailable", "pass")) == ["overall_false_fail_above_threshold"]
    assert judged(spark, held=wrong([1], "pass", "fail", critical=True)) == ["critical_safety_false_pass_detected"]
    assert judged(spark, held=wrong(range(100), "fail", "fail")) == ["overall_false_pass_denominator_zero", "overall_false_fail_denominator_zero", "per_domain_false_pass_denominator_zero"]
    mixed = wrong(range(0, 100, 2), "fail", "fail")[::2] + wrong(range(1, 19, 2), "pass", "fail")[1::2]
    assert judged(spark, held=mixed)[-2:] == ["per_domain_false_pass_denominator_zero", "per_domain_false_pass_above_threshold"]
