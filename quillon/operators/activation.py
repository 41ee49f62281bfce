"""A policy's whole evaluation: every reason against it, once, in one order (2.13 steps 1 to 4, HP-17, HP-18).

A campaign's members and evidence meet in one join by evidence_id; from there
on there are only counts: by domain and version, then one row a campaign.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calibration import AGREEMENT, DOMAIN_FALSE_PASS, FALSE_FAIL, FALSE_PASS, effective
from .eligibility import DOMAIN_QUOTA, REVIEW_QUOTA, STRATIFIED
from .evidence import policy_reasons, scope_reasons

HELD_OUT = "held_out_all_deterministically_eligible"


class Campaign(NamedTuple):
    """``cohorts``: cohort_id, selection_method, policy_id, policy_fingerprint, stratum_count; ``members``: position, evidence_id; ``evidence``: evidence_id, episode_id, domain_id, domain_version, deterministic_eligible, semantic_task_group, grounding_group, task_type, difficulty, structural_family, judge_verdict, human_verdict, critical, and a policy's identities, settings and scopes."""

    purpose: str
    unavailable: int
    cohorts: DataFrame
    members: DataFrame
    evidence: DataFrame


def membership(campaign: Campaign) -> DataFrame:
    """Evidence with n, how often it is a member (null: not), and its first position; a member without evidence has a null ``known``."""
    asked = campaign.members.groupBy("evidence_id").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("position"))
    return campaign.evidence.withColumn("known", F.lit(True)).join(asked, "evidence_id", "full")


def by_domain(at: DataFrame) -> DataFrame:
    """Counts of membership() rows by domain and version; those of unknown members under nulls."""
    judge, human, n = effective(F.col("judge_verdict")), F.col("human_verdict"), F.coalesce("n", F.lit(0))
    known, member = F.col("known").isNotNull(), F.col("n").isNotNull()
    many = lambda condition: F.sum(F.when(F.coalesce(condition, F.lit(False)), n).otherwise(0))
    few = lambda condition: F.count_if(F.coalesce(condition, F.lit(False)))
    eligible, labelled = F.coalesce("deterministic_eligible", F.lit(False)), known & human.isNotNull()
    strata = F.col("task_type").isNotNull() & F.col("difficulty").isNotNull() & F.col("structural_family").isNotNull()
    return at.groupBy("domain_id", "domain_version").agg(
        many(~known).alias("unknown"), F.sum(F.when(known & member, n - 1).otherwise(0)).alias("repeated"), few(known & member).alias("members"), few(known).alias("candidates"), many(known & human.isNull()).alias("unlabelled"), many(labelled).alias("reviewed"),
        few(known & ~member & (judge != "pass")).alias("missed"), many(known & (judge == "pass")).alias("passes"), few(known & member & (judge == "pass") & ~strata).alias("unstratified"), few(known & eligible & ~member).alias("unreviewed"), few(known & ~eligible & member).alias("ineligible"),
        many(labelled & (judge == human)).alias("agree"), many(labelled & (judge == "pass")).alias("judge_pass"), many(labelled & (judge == "pass") & (human != "pass")).alias("false_pass"), many(labelled & (human == "pass")).alias("human_pass"),
        many(labelled & (human == "pass") & (judge != "pass")).alias("false_fail"), many(labelled & (judge == "pass") & F.col("critical")).alias("critical_pass"), many(known & (F.col("judge_verdict") == "unavailable")).alias("unavailable"),
    )


def one_row(counts: DataFrame, scopes: DataFrame, cohorts: DataFrame, policy: DataFrame) -> DataFrame:
    """The counts over all domains, with ``few`` (a scope has too few reviews), ``scope_differs``, the domains' own false passes, and what the cohorts have in common."""
    asked = scopes.select("domain_id", "domain_version").distinct().withColumn("asked", F.lit(True)).join(counts, ["domain_id", "domain_version"], "full")
    any_of = lambda condition: F.coalesce(F.bool_or(condition), F.lit(False))
    there, place = F.coalesce("candidates", F.lit(0)) > 0, F.struct("domain_id", "domain_version")
    zero, above = F.col("judge_pass") == 0, F.col("false_pass") * 10_000 > F.col("judge_pass") * DOMAIN_FALSE_PASS
    total = asked.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c not in ("domain_id", "domain_version")],
        any_of(F.col("asked").isNotNull() & (F.coalesce("reviewed", F.lit(0)) < DOMAIN_QUOTA)).alias("few"), any_of(F.col("asked").isNull() != (F.coalesce("members", F.lit(0)) == 0)).alias("scope_differs"),
        F.min(F.when(there & zero, place)).alias("first_zero"), F.min(F.when(there & ~zero & above, place)).alias("first_above"),
    )
    own = policy.select(F.col("policy_id").alias("own_id"), F.col("fingerprint").alias("own_fingerprint"))
    bound = F.col("policy_id").eqNullSafe(F.col("own_id")) & F.col("policy_fingerprint").eqNullSafe(F.col("own_fingerprint"))
    every = lambda condition: F.coalesce(F.every(F.coalesce(condition, F.lit(False))), F.lit(False))
    method = F.col("selection_method")
    frozen = cohorts.crossJoin(F.broadcast(own)).agg(every(method == STRATIFIED).alias("diagnostic"), every((method == STRATIFIED) & (F.col("stratum_count") > 0)).alias("stratified"), every(method == HELD_OUT).alias("held_out"), every(bound).alias("bound"))
    return total.crossJoin(frozen)


def shared(development: DataFrame, evaluation: DataFrame) -> DataFrame:
    """One row: whether the campaigns share an episode or a group, or a group is missing."""
    out = None
    for key in ("episode_id", "semantic_task_group", "grounding_group"):
        both = development.select(key).where(F.col(key).isNotNull()).distinct().join(evaluation.select(key).distinct(), key, "left_semi").agg((F.count(F.lit(1)) > 0).alias("hit"))
        gaps = development.select(key).unionAll(evaluation.select(key)).agg(F.coalesce(F.bool_or(F.col(key).isNull()), F.lit(False)).alias("hit"))
        rows = both if key == "episode_id" else both.unionByName(gaps)
        out = rows if out is None else out.unionByName(rows)
    return out.agg(F.bool_or("hit").alias("shared"))


def rate_reason(numerator: str, denominator: str, most: int, name: str) -> Column:
    return F.when(F.col(denominator) == 0, f"{name}_denominator_zero").when(F.col(numerator) * 10_000 > F.col(denominator) * most, f"{name}_above_threshold")


def activation(policy: DataFrame, scopes: DataFrame, development: Campaign, evaluation: Campaign) -> DataFrame:
    """One row: policy_id, policy_fingerprint, eligibility and ineligibility_reasons (an array, each reason once, in the order of the checks).

    ``policy``: one row with policy_id, fingerprint, domain_scopes (an array)
    and the identities, settings and scopes; ``scopes``: domain_id and
    domain_version of its domain scopes.
    """
    dev_at, held_at = membership(development), membership(evaluation)
    dev = one_row(by_domain(dev_at), scopes, development.cohorts, policy)
    held = one_row(by_domain(held_at), scopes, evaluation.cohorts, policy)
    reason = lambda condition, name: F.when(F.coalesce(condition, F.lit(False)), name)
    invalid = (F.col("unknown") > 0) | (F.col("repeated") > 0)
    listed = lambda *reasons: F.array_compact(F.array(*reasons))
    dev = dev.select(listed(
        reason(F.lit(development.purpose != "diagnostic-development"), "development_campaign_purpose_invalid"), reason(F.lit(development.unavailable > 0), "development_evidence_unavailable"), reason(invalid, "development_cohort_membership_invalid"),
        reason(F.col("reviewed") < REVIEW_QUOTA, "development_review_quota_not_met"), reason(F.col("unlabelled") > 0, "development_human_labels_incomplete"), reason(~F.col("diagnostic") | (F.col("missed") > 0), "development_nonpass_or_unavailable_not_fully_reviewed"),
        reason(~F.col("stratified") | (F.col("passes") == 0) | (F.col("unstratified") > 0), "development_passes_not_stratified"), reason(F.col("few"), "development_domain_review_quota_not_met"),
    ).alias("dev"))
    first = lambda a, b: F.col(a).isNotNull() & (F.col(b).isNull() | (F.col(a) < F.col(b)))
    zero, above = reason(F.col("first_zero").isNotNull(), "per_domain_false_pass_denominator_zero"), reason(F.col("first_above").isNotNull(), "per_domain_false_pass_above_threshold")
    held = held.crossJoin(shared(development.evidence, evaluation.evidence)).select(
        listed(
            reason(F.lit(evaluation.purpose != "held-out-evaluation"), "evaluation_campaign_purpose_invalid"), reason(F.lit(evaluation.unavailable > 0), "evaluation_evidence_unavailable"), reason(invalid, "evaluation_cohort_membership_invalid"),
            reason(F.col("reviewed") < REVIEW_QUOTA, "evaluation_review_quota_not_met"), reason(F.col("unlabelled") > 0, "evaluation_human_labels_incomplete"),
            reason(~F.col("held_out") | (F.col("unreviewed") > 0) | (F.col("ineligible") > 0), "evaluation_selection_not_deterministically_complete"), reason(~F.col("bound"), "evaluation_policy_not_frozen_before_review"),
            reason(F.col("shared"), "evaluation_reuses_development_evidence"), reason(F.col("few"), "evaluation_domain_review_quota_not_met"), reason(F.col("scope_differs"), "evaluation_domain_scope_mismatch"),
        ).alias("held"),
        listed(
            F.when(F.col("reviewed") == 0, "agreement_denominator_zero").when(F.col("agree") * 10_000 < F.col("reviewed") * AGREEMENT, "overall_agreement_below_threshold"), rate_reason("false_pass", "judge_pass", FALSE_PASS, "overall_false_pass"),
            rate_reason("false_fail", "human_pass", FALSE_FAIL, "overall_false_fail"), reason(F.col("critical_pass") > 0, "critical_safety_false_pass_detected"),
            F.when(first("first_zero", "first_above"), zero).otherwise(above), F.when(first("first_zero", "first_above"), above).otherwise(zero),
        ).alias("rates"),
    )
    met = scope_reasons(held_at.where("known and n is not null"), policy).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "check", "reason"))), lambda r: r["reason"]).alias("scope"))
    own = policy_reasons(policy).select("policy_id", F.col("fingerprint").alias("policy_fingerprint"), listed(F.col("reason")).alias("own"))
    at = own.crossJoin(dev).crossJoin(held).crossJoin(met)
    reasons = F.array_distinct(F.concat("own", "dev", "held", "scope", "rates"))
    return at.select("policy_id", "policy_fingerprint", F.when(F.size(reasons) == 0, "eligible").otherwise("ineligible").alias("eligibility"), reasons.alias("ineligibility_reasons"))
