"""Human review: verdicts, cohorts, blind queues, labels and coverage (AG-12 to AG-14, WN-6, WN-7, PRD-29, PRD-32, JN-8, ST-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.canon import canonical, json_string, sha

# The five quality dimensions in their order.
DIMENSIONS = ("instruction_fidelity", "action_efficiency", "observation_grounding", "final_response_quality", "safety")


def dimension_verdict(labels: DataFrame) -> DataFrame:
    """AG-12: fail over uncertain over pass, over exactly five dimensions; null otherwise."""
    counts = labels.groupBy("episode_id").agg(F.count_distinct("dimension").alias("dimensions"), F.count_if(F.col("verdict") == "fail").alias("fails"), F.count_if(F.col("verdict") == "uncertain").alias("uncertain"))
    verdict = F.when(F.col("dimensions") != len(DIMENSIONS), None).when(F.col("fails") > 0, "fail").when(F.col("uncertain") > 0, "uncertain").otherwise("pass")
    return counts.select("episode_id", verdict.alias("verdict"))


def review_summary(members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """AG-13, AG-14: by cohort, members, labels and verdicts; members without a label are missing."""
    at = members.join(verdicts, "episode_id", "left")
    return at.groupBy("cohort_id").agg(
        F.count(F.lit(1)).alias("members"), F.count("verdict").alias("reviewed"), F.count_if(F.col("verdict").isNull()).alias("missing"),
        *[F.count_if(F.col("verdict") == v).alias(f"{v}_count") for v in ("pass", "fail", "uncertain")],
    )


def label_summary(members: DataFrame, labels: DataFrame, approved: bool = True) -> DataFrame:
    """AG-13, JN-8, JN-9: one row over all cohorts: the import's status, verdicts, and the held-out denominator.

    ``members``: cohort_id, episode_id, purpose; ``labels``: cohort_id,
    episode_id, purpose, verdict.  ``approved`` adds the sorted ids of all
    episodes that passed, whatever the purpose; that is a report's list, so
    leave it out where they are very many.
    """
    wanted = members.select("cohort_id", "episode_id").distinct()
    have = labels.select("cohort_id", "episode_id").distinct().withColumn("has", F.lit(True))
    coverage = wanted.join(have, ["cohort_id", "episode_id"], "left").agg(F.count(F.lit(1)).alias("expected"), F.count_if(F.col("has").isNull()).alias("missing"))
    held_out = members.where("purpose = 'held-out-evaluation'").select("episode_id").distinct()
    evaluated = labels.where("purpose = 'held-out-evaluation'").join(held_out, "episode_id", "left_semi").agg(F.count(F.lit(1)).alias("evaluation_reviewed_count"), F.count_if(F.col("verdict") == "pass").alias("evaluation_human_pass_count"))
    counts = labels.agg(*[F.count_if(F.col("verdict") == v).alias(f"{v}_count") for v in ("pass", "fail", "uncertain")], *([F.array_sort(F.collect_set(F.when(F.col("verdict") == "pass", F.col("episode_id")))).alias("approved_ids")] if approved else []))
    one = coverage.crossJoin(held_out.agg(F.count(F.lit(1)).alias("evaluation_denominator"))).crossJoin(evaluated).crossJoin(counts)
    status = F.when(F.col("expected") == 0, "not_started").when(F.col("missing") == 0, "complete").otherwise("incomplete")
    return one.withColumn("status", status).withColumn("evaluation_incomplete_count", F.col("evaluation_denominator") - F.col("evaluation_reviewed_count")).drop("expected", "missing")


def strata(episodes: DataFrame) -> DataFrame:
    """WN-6: the strata of passes: unassessed episodes, and those without a stratification, have names of their own."""
    unclassified = lambda c: F.coalesce(c, F.lit("unclassified")).alias(c)
    others = [c for c in episodes.columns if c not in ("task_type", "difficulty", "structural_key")]
    return episodes.select(*others, unclassified("task_type"), unclassified("difficulty"), F.coalesce("structural_key", F.lit("unassessed")).alias("structural_key"))


def round_robin(candidates: DataFrame, strata: list[str], limit: int) -> DataFrame:
    """WN-6: rounds over the sorted strata, each giving its next row by sequence, up to ``limit`` rows.

    No stratum gives more than ``limit`` rows, so its window keeps no more.
    """
    by = Window.partitionBy(*strata).orderBy("sequence")
    first = candidates.withColumn("round", F.row_number().over(by)).where(F.col("round") <= limit)
    return first.orderBy("round", *strata).limit(limit)


def diagnostic_cohort(judged: DataFrame, strata: list[str], passes: int) -> DataFrame:
    """WN-7: everything that didn't pass, and a stratified sample of what did."""
    sample = round_robin(judged.where(F.col("judge_verdict") == "pass"), strata, passes).drop("round")
    return judged.where(F.col("judge_verdict") != "pass").unionByName(sample)


def held_out_cohort(episodes: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """WN-7, JN-5: all admitted demonstrations, or those ``chosen`` (episode_id); an unknown or not admitted one is an error."""
    admitted = episodes.where("admitted")
    method = "operator_selected" if chosen is not None else "held_out_all_deterministically_eligible"
    if chosen is not None:
        if found := chosen.join(admitted, "episode_id", "left_anti").limit(3).collect():
            raise ValueError(f"not admitted: {[r[0] for r in found]}")
        admitted = admitted.join(chosen, "episode_id", "left_semi")
    return admitted.withColumn("selection_method", F.lit(method))


def unjudged(candidates: DataFrame, judgments: DataFrame) -> DataFrame:
    """JN-6: candidates of a diagnostic cohort (episode_id) without a judgment; the cohort can be built if there are none."""
    return candidates.join(judgments.select("episode_id"), "episode_id", "left_anti")


def membership_hash(cohorts: DataFrame) -> DataFrame:
    """1.5: ``membership_hash`` of cohorts: cohort_id, purpose, episode_ids, selection_method, stratum_count, campaign_id, policy_id, policy_fingerprint."""
    ids = F.concat(F.lit("["), F.array_join(F.transform("episode_ids", json_string), ","), F.lit("]"))
    fields = {
        "cohort_id": F.col("cohort_id"), "purpose": F.col("purpose"), "selection_method": F.col("selection_method"), "campaign_id": F.col("campaign_id"), "quality_policy_id": F.col("policy_id"), "quality_policy_fingerprint": F.col("policy_fingerprint"),
        "episode_ids": ids, "stratified_pass_stratum_count": F.col("stratum_count").cast("string"),
    }
    return cohorts.withColumn("membership_hash", F.concat(F.lit("sha256:"), sha(canonical(fields, nested=("episode_ids", "stratified_pass_stratum_count")))))


def blind_queue(members: DataFrame, episodes: DataFrame, public: list[str]) -> DataFrame:
    """PRD-29, JN-4: members in cohort order with their public columns alone, texts sanitized; a member that isn't there fails the query when it is read."""
    from ..functions.text import sanitized

    known = episodes.select("episode_id", *public, F.lit(True).alias("__known"))
    at = members.select("cohort_id", "position", "episode_id").join(known, "episode_id", "left")
    there = F.when(F.col("__known"), F.col("episode_id")).otherwise(F.raise_error(F.concat(F.lit("no such episode: "), F.col("episode_id").cast("string"))).cast(episodes.schema["episode_id"].dataType))
    shown = [sanitized(F.col(c)).alias(c) if episodes.schema[c].dataType.simpleString() == "string" else F.col(c) for c in public]
    return at.select("cohort_id", "position", there.alias("episode_id"), *shown)


def label_coverage(members: DataFrame, labels: DataFrame) -> DataFrame:
    """JN-8, AG-14: by cohort, whether every member has a label; an empty cohort isn't complete."""
    at = members.join(labels.select("cohort_id", "episode_id").distinct().withColumn("has", F.lit(1)), ["cohort_id", "episode_id"], "left")
    counts = at.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("expected"), F.count("has").alias("imported"))
    return counts.withColumn("complete", (F.col("expected") > 0) & (F.col("expected") == F.col("imported")))


def label_errors(submitted: DataFrame, members: DataFrame, imported: DataFrame, episodes: DataFrame) -> DataFrame:
    """PRD-32: the first error of each submitted label, null if it can be imported.

    Where both sides have a ``purpose``, a label's has to be its cohort's;
    where labels have ``event_indexes`` and episodes ``event_count``, they have
    to be there.
    """
    purposes = "purpose" in submitted.columns and "purpose" in members.columns
    events = "event_indexes" in submitted.columns and "event_count" in episodes.columns
    known = members.select("cohort_id", *([F.col("purpose").alias("cohort_purpose")] if purposes else [])).distinct().withColumn("has_cohort", F.lit(True))
    held = members.select("cohort_id", "episode_id").withColumn("has_member", F.lit(True))
    before = imported.select("cohort_id", "episode_id").distinct().withColumn("has_label", F.lit(True))
    exists = episodes.select("episode_id", *(["event_count"] if events else [])).withColumn("has_episode", F.lit(True))
    at = submitted.join(known, "cohort_id", "left").join(held, ["cohort_id", "episode_id"], "left").join(before, ["cohort_id", "episode_id"], "left").join(exists, "episode_id", "left")
    other = F.col("purpose") != F.col("cohort_purpose") if purposes else F.lit(False)
    beyond = F.coalesce(F.exists("event_indexes", lambda k: (k < 0) | (k >= F.col("event_count"))), F.lit(False)) if events else F.lit(False)
    error = (
        F.when(F.col("has_cohort").isNull(), "unknown_cohort").when(other, "purpose_mismatch").when(F.col("has_member").isNull(), "episode_not_in_cohort").when(F.col("has_label").isNotNull(), "already_imported")
        .when(F.col("has_episode").isNull(), "unknown_episode").when(beyond, "unknown_event")
    )
    return at.select("cohort_id", "episode_id", error.alias("error"))


def shared_members(members: DataFrame) -> DataFrame:
    """ST-1: episodes in more than one cohort; cohorts are disjoint if there are none."""
    return members.groupBy("episode_id").agg(F.count_distinct("cohort_id").alias("cohorts")).where(F.col("cohorts") > 1)
