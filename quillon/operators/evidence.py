"""Calibration evidence from finished runs, and what speaks against a policy or an evaluation's scope (JN-2, JN-3, 2.13, PRD-33, PRD-34, HP-18, HP-19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import canonical, canonical_array, sha
from ..functions.payload import first_reason

# What a policy must name besides its scopes, and the settings that evidence must share with it.
IDENTITIES = ("generator_identity", "agent_identity", "judge_identity")
SETTINGS = ("generator_prompt_id", "generator_decoding_id", "agent_prompt_id", "agent_decoding_id", "judge_prompt_id", "judge_decoding_id")
SCOPES = ("source_scope_id", "task_distribution_scope_id")


def calibration_group(kind: str, *parts: Column) -> Column:
    """1.5: the group of a kind and its parts, null where a part is."""
    whole = F.concat(F.lit("sha256:"), sha(canonical_array(F.lit(kind), *parts)))
    missing = F.lit(False)
    for part in parts:
        missing = missing | part.isNull()
    return F.when(~missing, whole)


def role_identity(roles: Column, role: str) -> Column:
    """HP-19: the identity of the first lineage entry of ``role``, or null."""
    first = F.try_element_at(F.filter(roles, lambda r: r["role"] == role), F.lit(1))
    return F.when(first.isNotNull(), F.struct(first["provider_id"].alias("provider_id"), first["model_id"].alias("model_id"), first["model_version"].alias("model_version")))


def critical_failure(dimensions: Column) -> Column:
    """HP-19: safety failed, and critically so."""
    return F.exists(dimensions, lambda d: (d["dimension"] == "safety") & (d["verdict"] == "fail") & F.array_contains(d["reason_codes"], "critical_safety_failure"))


def campaign_evidence(runs: DataFrame, members: DataFrame, terminals: DataFrame, labels: DataFrame, judgments: DataFrame, cases: DataFrame, campaign_id: str, purpose: str) -> tuple[DataFrame, DataFrame]:
    """JN-2, JN-3: the evidence of a campaign, a row for each terminal episode of its runs, and how many runs are unavailable.

    ``runs``: run_id, status; ``members``: run_id, cohort_id, episode_id,
    purpose, campaign_id; ``terminals``: run_id, sequence, episode_id,
    domain_id, domain_version, gates_passed, task_type, difficulty,
    structural_key; ``labels``: run_id, cohort_id, episode_id, verdict,
    critical; ``judgments``: run_id, episode_id, verdict; ``cases``: run_id,
    sequence, semantic_key.  A run counts if it was completed and has a cohort
    of the campaign; runs that repeat count once.  A missing judgment is
    unavailable, a missing label null, a missing case has no groups.
    """
    mine = members.where((F.col("purpose") == purpose) & (F.col("campaign_id") == campaign_id))
    used = runs.where("status = 'completed'").join(mine.select("run_id").distinct(), "run_id", "left_semi").select("run_id").distinct()
    unavailable = runs.select("run_id").distinct().join(used, "run_id", "left_anti").agg(F.count(F.lit(1)).alias("unavailable_source_count"))
    at = terminals.join(used, "run_id", "left_semi")
    at = at.join(mine.select("run_id", "episode_id", "cohort_id"), ["run_id", "episode_id"], "left")
    at = at.join(labels.select("run_id", "cohort_id", "episode_id", F.col("verdict").alias("human_verdict"), "critical"), ["run_id", "cohort_id", "episode_id"], "left")
    at = at.join(judgments.select("run_id", "episode_id", F.col("verdict").alias("judge_verdict")), ["run_id", "episode_id"], "left").join(cases.select("run_id", "sequence", "semantic_key"), ["run_id", "sequence"], "left")
    domain = F.col("domain_id"), F.col("domain_version"), F.col("semantic_key")
    evidence = at.select(
        calibration_group("episode", F.col("run_id").cast("string"), F.col("episode_id").cast("string")).alias("evidence_id"), "episode_id", "domain_id", "domain_version", F.col("gates_passed").alias("deterministic_eligible"),
        calibration_group("semantic-task", *domain).alias("semantic_task_group"), calibration_group("grounding", *domain).alias("grounding_group"), "task_type", "difficulty", F.col("structural_key").alias("structural_family"),
        F.coalesce("judge_verdict", F.lit("unavailable")).alias("judge_verdict"), "human_verdict", F.coalesce("critical", F.lit(False)).alias("critical"), F.col("cohort_id").isNotNull().alias("reviewed"),
    )
    return evidence, unavailable


def policy_fingerprint(policy: DataFrame) -> DataFrame:
    """1.5, HP-18: ``fingerprint`` of policies whose columns are texts (identities as canonical JSON)."""
    fields = {c: F.col(c) for c in policy.columns}
    return policy.withColumn("fingerprint", F.concat(F.lit("sha256:"), sha(canonical(fields, nested=tuple(c for c in IDENTITIES if c in fields)))))


def policy_reasons(policy: DataFrame) -> DataFrame:
    """2.13 step 1: the reason against each policy, null if there is none: IDENTITIES, SETTINGS, SCOPES and domain_scopes (an array)."""
    missing = F.size(F.coalesce("domain_scopes", F.array().cast(policy.schema["domain_scopes"].dataType))) == 0
    for name in (*IDENTITIES, *SETTINGS, *SCOPES):
        missing = missing | F.col(name).isNull()
    shared = F.col("judge_identity").eqNullSafe(F.col("generator_identity")) | F.col("judge_identity").eqNullSafe(F.col("agent_identity"))
    return policy.withColumn("reason", F.when(missing, "policy_identity_or_scope_missing").when(shared, "policy_judge_identity_not_independent"))


def frozen_policy(cohorts: DataFrame, policy: DataFrame) -> DataFrame:
    """2.13 step 3: one row: whether the cohorts (policy_id, policy_fingerprint) were all bound to the policy before the review; an empty campaign isn't."""
    bound = F.col("policy_id").eqNullSafe(F.col("own_id")) & F.col("policy_fingerprint").eqNullSafe(F.col("own_fingerprint"))
    at = cohorts.crossJoin(F.broadcast(policy.select(F.col("policy_id").alias("own_id"), F.col("fingerprint").alias("own_fingerprint"))))
    return at.agg((F.coalesce(F.every(bound), F.lit(False))).alias("frozen"))


def scope_reasons(reviewed: DataFrame, policy: DataFrame) -> DataFrame:
    """2.13 step 3, the scope: reasons against an evaluation in the order in which they are first met: position, reason.

    ``reviewed`` has a position for each row, the evidence's columns and those
    of the policy; the reasons of a row come in the order of its checks.
    """
    one = F.broadcast(policy.select(*[F.col(c).alias(f"own_{c}") for c in (*IDENTITIES, *SETTINGS, *SCOPES)]))
    differs = lambda *names: reduce_or([~F.col(n).eqNullSafe(F.col(f"own_{n}")) for n in names])
    checks = [
        (~F.coalesce("deterministic_eligible", F.lit(False)), "evaluation_contains_noneligible_episode"), (F.col("semantic_task_group").isNull() | F.col("grounding_group").isNull(), "evaluation_canonical_group_evidence_missing"),
        (differs(*SCOPES), "evaluation_source_or_task_scope_mismatch"), (differs("generator_identity", "agent_identity"), "evaluation_generator_or_agent_identity_mismatch"), (differs("judge_identity"), "evaluation_judge_identity_mismatch"),
        (differs(*SETTINGS), "evaluation_model_settings_mismatch"),
    ]
    met = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("check"), F.lit(reason).alias("reason"))) for k, (c, reason) in enumerate(checks)]))
    each = reviewed.crossJoin(one).select("position", F.explode(met).alias("m")).groupBy("m.reason").agg(F.min(F.struct("position", "m.check")).alias("first"))
    first = each.select("reason", F.col("first.position").alias("position"), F.col("first.check").alias("check"))
    return first.orderBy("position", "check").select("position", "check", "reason")


def reduce_or(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def enforcement_preflight(runs: DataFrame) -> DataFrame:
    """PRD-34, HP-18: ``runs`` with ``reason``: why a policy may not be enforced in each run, null if it may or none is asked for.

    ``runs``: admission_mode; policy (null: none; policy_id, fingerprint,
    rubric_id, domain_scopes as an array of domain_id and domain_version,
    IDENTITIES, SETTINGS and SCOPES); activation (eligibility, policy_id,
    policy_fingerprint and the rest of what was reported) and recomputed (the
    same of activation() over the frozen evidence); domain_id,
    domain_version; model_identity; configuration (SCOPES and the SETTINGS of
    generator and agent); quality (mode, judge_model_id, rubric_id,
    judge_prompt_id, judge_decoding_id); judge_identity, null where no judge
    is available.  Identities are structs of provider_id, model_id and
    model_version.
    """
    p, a, c, q = F.col("policy"), F.col("activation"), F.col("configuration"), F.col("quality")
    text = lambda x: F.to_json(x)
    other = lambda x, y: ~x.eqNullSafe(y)
    scope = F.struct(F.col("domain_id").alias("domain_id"), F.col("domain_version").alias("domain_version"))
    scopes = F.transform(p["domain_scopes"], lambda x: F.struct(x["domain_id"].alias("domain_id"), x["domain_version"].alias("domain_version")))
    model = F.col("model_identity")
    settings = [other(c[n], p[n]) for n in (*SCOPES, *[n for n in SETTINGS if not n.startswith("judge")])]
    judged = [other(q["mode"], F.lit("shadow")), other(q["judge_model_id"], p["judge_identity"]["model_id"]), *[other(q[n], p[n]) for n in ("rubric_id", "judge_prompt_id", "judge_decoding_id")]]
    # What is told in each case, in the order of the checks.
    reason = first_reason([
        (p.isNull() | a.isNull(), "enforced admission requires semantic enforcement evidence"),
        (other(a["eligibility"], F.lit("eligible")), "semantic enforcement activation is ineligible"),
        (other(a["policy_id"], p["policy_id"]) | other(a["policy_fingerprint"], p["fingerprint"]), "semantic enforcement activation does not bind its policy"),
        (other(text(a), text(F.col("recomputed"))), "semantic enforcement activation does not match frozen evidence"),
        (reduce_or([p[n].isNull() for n in IDENTITIES]) | (F.size(F.coalesce(scopes, F.array().cast("array<struct<domain_id:string,domain_version:string>>"))) == 0), "enforcement policy identity or scope is unavailable"),
        (F.col("domain_id").isNull() | F.col("domain_version").isNull(), "enforcement Domain identity is unavailable"),
        (~F.array_contains(scopes, scope), "enforcement policy does not cover this Domain version"),
        (model.isNull() | model["provider_id"].isNull() | model["model_id"].isNull() | model["model_version"].isNull(), "enforcement generator and Agent identity is unavailable"),
        (other(model, p["generator_identity"]) | other(model, p["agent_identity"]), "enforcement generator or Agent identity differs from activation"),
        (reduce_or(settings), "enforcement source, task, or model settings differ from activation"),
        (reduce_or(judged), "enforcement judge settings differ from activation"),
        (F.col("judge_identity").isNull() | other(F.col("judge_identity"), p["judge_identity"]), "enforcement judge identity is unavailable or differs from activation"),
    ])
    return runs.withColumn("reason", F.when(F.col("admission_mode") != "deterministic", reason))
