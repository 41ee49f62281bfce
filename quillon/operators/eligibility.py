"""Whether campaigns may carry an enforcement policy: the reasons before the thresholds (§2.13 steps 2 and 3, ST-1 to ST-5, JN-7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least reviews of a campaign and of each of its domains, and the method that stratifies passes.
REVIEW_QUOTA, DOMAIN_QUOTA = 100, 30
STRATIFIED = "diagnostic_all_nonpass_stratified_pass"


def _one(frame: DataFrame, condition: Column, name: str) -> DataFrame:
    """One row: whether any row of ``frame`` meets ``condition``."""
    return frame.agg(F.coalesce(F.max(F.coalesce(condition, F.lit(False))), F.lit(False)).alias(name))


def _table(flags: list[tuple[str, DataFrame]]) -> DataFrame:
    """position, reason, found of one-row flags, in the order of emission."""
    rows = [flag.select(F.lit(k).alias("position"), F.lit(reason).alias("reason"), F.col(flag.columns[0]).alias("found")) for k, (reason, flag) in enumerate(flags)]
    return reduce(DataFrame.unionByName, rows)


def _membership(members: DataFrame, evidence: DataFrame) -> DataFrame:
    """JN-7: a member that isn't in the evidence, or is there twice."""
    known = evidence.select("evidence_id").distinct().withColumn("known", F.lit(True))
    at = members.join(known, "evidence_id", "left").groupBy("evidence_id").agg(F.count(F.lit(1)).alias("n"), F.max("known").alias("known"))
    return _one(at, F.col("known").isNull() | (F.col("n") > 1), "found")


def _few(reviewed: DataFrame, scopes: DataFrame) -> DataFrame:
    counts = scopes.join(reviewed.groupBy("domain_id").agg(F.count(F.lit(1)).alias("n")), "domain_id", "left")
    return _one(counts, F.coalesce("n", F.lit(0)) < DOMAIN_QUOTA, "found")


def development_reasons(members: DataFrame, evidence: DataFrame, scopes: DataFrame, purpose: str, unavailable: int, method: str) -> DataFrame:
    """Reasons against a development campaign; ``members``: evidence_id; ``evidence`` has domain_id, judge_verdict, human_verdict, task_type, structural_family."""
    reviewed = evidence.join(members.select("evidence_id").distinct(), "evidence_id", "left_semi")
    missed = evidence.where(F.col("judge_verdict") != "pass").join(members, "evidence_id", "left_anti")
    passes = reviewed.where(F.col("judge_verdict") == "pass")
    unstratified = F.col("task_type").isNull() | F.col("structural_family").isNull() | F.lit(method != STRATIFIED)
    const = lambda value: evidence.sparkSession.range(1).select(F.lit(value).alias("found"))
    return _table([
        ("development_campaign_purpose_invalid", const(purpose != "diagnostic-development")),
        ("development_evidence_unavailable", const(unavailable > 0)),
        ("development_cohort_membership_invalid", _membership(members, evidence)),
        ("development_review_quota_not_met", reviewed.agg((F.count(F.lit(1)) < REVIEW_QUOTA).alias("found"))),
        ("development_human_labels_incomplete", _one(reviewed, F.col("human_verdict").isNull(), "found")),
        ("development_nonpass_or_unavailable_not_fully_reviewed", _one(missed, F.lit(True), "found")),
        ("development_passes_not_stratified", _one(passes, unstratified, "found")),
        ("development_domain_review_quota_not_met", _few(reviewed, scopes)),
    ])


def evaluation_reasons(members: DataFrame, evidence: DataFrame, development: DataFrame, scopes: DataFrame, purpose: str, unavailable: int, keys: list[str]) -> DataFrame:
    """Reasons against a held-out campaign; ``keys`` must not be shared with ``development`` nor be null."""
    reviewed = evidence.join(members.select("evidence_id").distinct(), "evidence_id", "left_semi")
    left = evidence.where("eligible").select("evidence_id").join(members, "evidence_id", "left_anti")
    extra = reviewed.where(~F.col("eligible"))
    reused = reduce(DataFrame.unionByName, [
        evidence.select(F.col(k).cast("string").alias("key")).where(F.col("key").isNotNull()).join(development.select(F.col(k).cast("string").alias("key")), "key", "left_semi").select(F.lit(True).alias("hit"))
        .unionByName(evidence.where(F.col(k).isNull()).select(F.lit(True).alias("hit"))) for k in keys
    ])
    domains = reviewed.select("domain_id").distinct().withColumn("seen", F.lit(1)).join(scopes.withColumn("asked", F.lit(1)), "domain_id", "full")
    const = lambda value: evidence.sparkSession.range(1).select(F.lit(value).alias("found"))
    return _table([
        ("evaluation_campaign_purpose_invalid", const(purpose != "held-out-evaluation")),
        ("evaluation_evidence_unavailable", const(unavailable > 0)),
        ("evaluation_cohort_membership_invalid", _membership(members, evidence)),
        ("evaluation_review_quota_not_met", reviewed.agg((F.count(F.lit(1)) < REVIEW_QUOTA).alias("found"))),
        ("evaluation_human_labels_incomplete", _one(reviewed, F.col("human_verdict").isNull(), "found")),
        ("evaluation_selection_not_deterministically_complete", _one(left.unionByName(extra.select("evidence_id")), F.lit(True), "found")),
        ("evaluation_reuses_development_evidence", _one(reused, F.col("hit"), "found")),
        ("evaluation_domain_review_quota_not_met", _few(reviewed, scopes)),
        ("evaluation_domain_scope_mismatch", _one(domains, F.col("seen").isNull() | F.col("asked").isNull(), "found")),
        ("evaluation_contains_noneligible_episode", _one(extra, F.lit(True), "found")),
    ])
