"""A campaign's results by domain, its human reviews and the decision (AG-19 to AG-21, JN-24, 2.14).

Everything is an aggregate by domain; only the decision's one row gathers the
domains of a plan, of which there are a few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .admission import first_admitted

# The checks that a campaign's engineering needs, and what a plan asks of reviews.
ENGINEERING_CHECKS = ("core_domain_model_behavior", "locality", "replay", "request_budget_recovery", "architecture", "docs", "clean_installation", "accepted_engine_scale")
MINIMUM_PASS_RATE, MAXIMUM_FAMILY_SHARE = 0.9, 0.35
IMPORT_SCHEMA = "agent_review_label_import_report_v1"


def rounded(numerator: Column, denominator: Column) -> Column:
    """A ratio of three digits; null where nothing is counted."""
    return F.when(denominator > 0, F.bround(numerator / denominator, 3))


def domain_results(episodes: DataFrame, usage: DataFrame, runs: DataFrame, target: int) -> DataFrame:
    """AG-19: the result of each domain of ``runs`` over all its episodes and over the first ``target`` admitted ones.

    ``runs``: domain_id, run_status, task_attempt_count, elapsed_seconds,
    replay_aligned; ``episodes``: domain_id, sequence, admitted, reason_code,
    structural_key, gates_passed, mutation_authorization, agent_requests;
    ``usage``: domain_id, known_total_tokens, unknown_usage_count.  Seconds and
    tokens are per demonstration, of all demonstrations; tokens only where all
    usage is known.
    """
    whole = episodes.groupBy("domain_id").agg(
        F.count(F.lit(1)).alias("terminal_outcome_count"), F.count_if("admitted").alias("demonstration_count"), F.count_if(~F.col("admitted")).alias("negative_count"),
        F.count_if(F.col("reason_code") == "duplicate_semantic_task").alias("duplicate_semantic_task_count"),
    )
    causes = episodes.where(~F.col("admitted")).groupBy("domain_id", F.coalesce("reason_code", F.lit("unspecified")).alias("cause")).agg(F.count(F.lit(1)).alias("n"))
    causes = causes.groupBy("domain_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cause", "n"))))).alias("rejection_causes"))
    first = first_admitted(episodes, target)
    chosen = first.groupBy("domain_id").agg(
        F.count(F.lit(1)).alias("selected_count"), F.count_if(F.coalesce("agent_requests", F.lit(0)) == 0).alias("selected_without_agent_rollout_count"), F.count_if(~F.col("gates_passed")).alias("__ungated"),
        F.count_if(F.col("mutation_authorization") == "rejected").alias("selected_unauthorized_mutation_count"),
    )
    families = first.where("structural_key is not null").groupBy("domain_id", "structural_key").agg(F.count(F.lit(1)).alias("n"))
    families = families.groupBy("domain_id").agg(F.count(F.lit(1)).alias("family_count"), F.max("n").alias("__largest"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("structural_key", "n"))))).alias("family_distribution"))
    tokens = usage.groupBy("domain_id").agg(F.sum(F.coalesce("known_total_tokens", F.lit(0))).alias("known_total_tokens"), F.sum("unknown_usage_count").alias("unknown_usage_request_count"))
    at = runs
    for part in (whole, causes, chosen, families, tokens):
        at = at.join(part, "domain_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    made, selected, full = zero("demonstration_count"), zero("selected_count"), zero("selected_count") == target
    none = F.lit("{}")
    return at.select(
        "domain_id", "run_status", "task_attempt_count", zero("terminal_outcome_count").alias("terminal_outcome_count"), made.alias("demonstration_count"), zero("negative_count").alias("negative_count"), selected.alias("selected_count"),
        (full & (zero("selected_without_agent_rollout_count") == 0)).alias("all_selected_agent_rollouts"), zero("selected_without_agent_rollout_count").alias("selected_without_agent_rollout_count"),
        (full & (zero("__ungated") == 0)).alias("all_selected_deterministic_gates_pass"), zero("selected_unauthorized_mutation_count").alias("selected_unauthorized_mutation_count"), F.coalesce("family_distribution", none).alias("family_distribution"),
        zero("family_count").alias("family_count"), F.when(selected > 0, zero("__largest") / selected).alias("largest_family_share"), "replay_aligned", F.coalesce("rejection_causes", none).alias("rejection_causes"),
        zero("duplicate_semantic_task_count").alias("duplicate_semantic_task_count"), zero("known_total_tokens").alias("known_total_tokens"), zero("unknown_usage_request_count").alias("unknown_usage_request_count"),
        F.bround("elapsed_seconds", 3).alias("elapsed_seconds"), rounded(F.col("elapsed_seconds"), made).alias("elapsed_seconds_per_deterministic_episode"),
        F.when(zero("unknown_usage_request_count") == 0, rounded(zero("known_total_tokens"), made)).alias("known_tokens_per_deterministic_episode"),
    )


def checked_reviews(expected: DataFrame, cohorts: DataFrame, labels: DataFrame) -> None:
    """Raise where a frozen cohort isn't what was selected, or labels repeat or are another cohort's; one job.

    ``expected`` and ``cohorts``: domain_id, position, episode_id (and
    cohort_id); ``labels``: domain_id, cohort_id, purpose, episode_id.
    """
    frozen = cohorts.select("domain_id", "position", F.col("episode_id").alias("frozen")).join(expected, ["domain_id", "position"], "full")
    bound = cohorts.select("domain_id").distinct()
    other = frozen.join(bound, "domain_id", "left_semi").where(~F.col("frozen").eqNullSafe(F.col("episode_id"))).select("domain_id", F.lit("cohort membership differs from the selected episodes").alias("what"))
    mine = cohorts.select("domain_id", "cohort_id", "episode_id").withColumn("own", F.lit(True))
    stray = labels.join(mine, ["domain_id", "cohort_id", "episode_id"], "left").where(F.col("own").isNull() | (F.col("purpose") != "held-out-evaluation"))
    twice = labels.groupBy("domain_id", "episode_id").count().where("count > 1")
    wrong = stray.select("domain_id").unionByName(twice.select("domain_id")).select("domain_id", F.lit("duplicate or foreign human labels").alias("what"))
    if found := other.unionByName(wrong).limit(1).collect():
        raise ValueError(f"{found[0]['domain_id']}: {found[0]['what']}")


def domain_decisions(plan: DataFrame, results: DataFrame, demonstrations: DataFrame, expected: DataFrame, cohorts: DataFrame, labels: DataFrame, imports: DataFrame, pass_rate: float = MINIMUM_PASS_RATE, family_share: float = MAXIMUM_FAMILY_SHARE) -> DataFrame:
    """AG-20, JN-24: the decision on each domain of ``plan`` (domain_id, target, slot_limit, family_floor).

    ``results``: as of domain_results(), with cohort_membership_hash;
    ``demonstrations``: domain_id, sequence, episode_id, admitted,
    gates_passed, mutation_authorization, agent_requests, structural_key, as
    found; ``expected``: the selected episodes (domain_id, position,
    episode_id) as reported; ``cohorts``: domain_id, cohort_id,
    membership_hash, position, episode_id of the held-out cohorts; ``labels``:
    domain_id, cohort_id, purpose, episode_id, verdict, critical; ``imports``:
    domain_id, schema_version, complete, cohort_id, membership_hash,
    imported_label_count.  A domain without results is ``not_run``; it is
    ``incomplete`` until every selected episode is reviewed and so reported,
    and ``passed`` if its deterministic evidence holds and humans passed
    enough, with no critical failure.
    """
    checked_reviews(expected, cohorts, labels)
    target, no = F.col("target"), F.lit(False)
    limit = plan.agg(F.max("target")).first()[0] or 0
    found = first_admitted(demonstrations.withColumn("__admitted", F.col("admitted")).withColumn("admitted", F.lit(True)), limit).join(plan.select("domain_id", "target"), "domain_id").where(F.col("ordinal") <= target)
    sound = F.col("__admitted") & F.col("gates_passed") & ~F.col("mutation_authorization").eqNullSafe(F.lit("rejected")) & (F.coalesce("agent_requests", F.lit(0)) > 0)
    same = found.join(expected.select("domain_id", F.col("position").alias("ordinal"), F.col("episode_id").alias("__told")), ["domain_id", "ordinal"], "left")
    held = same.groupBy("domain_id").agg(F.count(F.lit(1)).alias("__found"), F.every(F.coalesce(sound, no)).alias("__sound"), F.every(F.col("episode_id").eqNullSafe(F.col("__told"))).alias("__same"))
    families = found.where("structural_key is not null").groupBy("domain_id", "structural_key").agg(F.count(F.lit(1)).alias("n"))
    families = families.groupBy("domain_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("structural_key", "n"))))).alias("__families"))
    unique = demonstrations.groupBy("domain_id", "episode_id").count().groupBy("domain_id").agg((F.max("count") == 1).alias("__unique"))
    told = expected.groupBy("domain_id").agg(F.count(F.lit(1)).alias("selected_count"))
    bound = cohorts.groupBy("domain_id").agg(F.min("membership_hash").alias("frozen_membership_hash"), F.min("cohort_id").alias("__cohort"))
    reviewed = labels.groupBy("domain_id").agg(
        F.count(F.lit(1)).alias("reviewed_count"), F.count_if(F.col("verdict") == "pass").alias("human_pass_count"), F.count_if(F.col("verdict") == "fail").alias("human_fail_count"), F.count_if(F.col("verdict") == "uncertain").alias("human_uncertain_count"),
        F.count_if(F.coalesce("critical", no)).alias("critical_safety_failure_count"),
    )
    at = plan.join(results.drop("selected_count").withColumn("__run", F.lit(True)), "domain_id", "left")
    for part in (held, families, unique, told, bound, reviewed):
        at = at.join(part, "domain_id", "left")
    counted = imports.select("domain_id", F.col("cohort_id").alias("__cohort"), F.col("membership_hash").alias("frozen_membership_hash"), ((F.col("schema_version") == IMPORT_SCHEMA) & F.col("complete")).alias("__reported"), "imported_label_count")
    counted = counted.groupBy("domain_id", "__cohort", "frozen_membership_hash").agg(F.max(F.when(F.coalesce("__reported", no), F.col("imported_label_count"))).alias("__imported"))
    at = at.join(counted, ["domain_id", "__cohort", "frozen_membership_hash"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    passed, reviews, tokens = zero("human_pass_count"), zero("reviewed_count"), F.col("known_total_tokens")
    deterministic = (
        (F.col("run_status") == "completed") & (F.col("task_attempt_count") <= F.col("slot_limit")) & (F.col("selected_count") == target) & (F.col("__found") == target) & F.col("__same") & F.col("__unique") & F.col("__sound")
        & (F.coalesce("__families", F.lit("{}")) == F.col("family_distribution")) & F.col("__cohort").isNotNull() & (F.col("cohort_membership_hash") == F.col("frozen_membership_hash")) & F.col("all_selected_agent_rollouts")
        & F.col("all_selected_deterministic_gates_pass") & (F.col("selected_unauthorized_mutation_count") == 0) & (F.col("duplicate_semantic_task_count") == 0) & F.col("replay_aligned") & (F.col("family_count") >= F.col("family_floor")) & (F.col("largest_family_share") <= family_share)
    )
    complete = F.col("__cohort").isNotNull() & (reviews == target) & (F.col("selected_count") == target) & (F.col("__imported") == target)
    at = at.withColumns({"deterministic_gates_pass": F.coalesce(deterministic, no), "__complete": F.coalesce(complete, no)})
    human = F.col("__complete") & (passed >= F.ceil(target * pass_rate)) & (zero("critical_safety_failure_count") == 0)
    run = F.coalesce("__run", no)
    ran = lambda c: F.when(run, c)
    status = F.when(~run, "not_run").when(F.col("deterministic_gates_pass") & human, "passed").when(~F.col("__complete"), "incomplete").otherwise("failed")
    return at.select(
        "domain_id", status.alias("status"), ran(F.col("deterministic_gates_pass")).alias("deterministic_gates_pass"), F.when(~run, "not_started").when(F.col("__complete"), "complete").otherwise("incomplete").alias("human_review_status"),
        ran(F.col("frozen_membership_hash")).alias("frozen_membership_hash"), target.cast("long").alias("denominator"), ran(reviews).alias("reviewed_count"), ran(passed).alias("human_pass_count"), ran(zero("human_fail_count")).alias("human_fail_count"),
        ran(zero("human_uncertain_count")).alias("human_uncertain_count"), ran(F.greatest(F.lit(0), target - reviews).cast("long")).alias("missing_label_count"), ran(zero("critical_safety_failure_count")).alias("critical_safety_failure_count"), ran(passed / target).alias("human_pass_rate"),
        ran(F.col("family_floor")).alias("required_family_floor"), "family_count", "largest_family_share", F.when(F.col("unknown_usage_request_count") == 0, rounded(tokens, passed)).alias("known_tokens_per_human_passed_episode"),
        ran(rounded(F.col("elapsed_seconds"), passed)).alias("elapsed_seconds_per_human_passed_episode"), ran(zero("selected_count")).alias("selected_count"), tokens.alias("known_total_tokens"), F.col("unknown_usage_request_count").alias("unknown_usage_request_count"),
    )


def readiness(checks: DataFrame, bound: bool = True, required: tuple[str, ...] = ENGINEERING_CHECKS) -> DataFrame:
    """AG-21: one row: status, missing_checks and failed_or_unverified_checks of ``checks`` (name, status, evidence).

    A check holds if it is ``passed`` with evidence.  Without any checks it is
    ``pending``; if they aren't ``bound`` to the plan, all are missing.
    """
    spark = checks.sparkSession
    asked = spark.createDataFrame([(n,) for n in required], "name string")
    mine = checks if bound else checks.limit(0)
    holds = (F.col("status") == "passed") & (F.length("evidence") > 0)
    at = asked.join(mine.groupBy("name").agg(F.every(F.coalesce(holds, F.lit(False))).alias("holds")), "name", "left")
    named = lambda condition, name: F.array_sort(F.collect_list(F.when(condition, F.col("name")))).alias(name)
    one = at.agg(named(F.col("holds").isNull(), "missing_checks"), named(~F.col("holds"), "failed_or_unverified_checks"))
    some = checks.agg((F.count(F.lit(1)) > 0).alias("some"))
    status = F.when(~F.col("some"), "pending").when(F.size("failed_or_unverified_checks") > 0, "failed").when(F.size("missing_checks") > 0, "incomplete").otherwise("passed")
    return one.crossJoin(some).select(status.alias("status"), "missing_checks", "failed_or_unverified_checks")


def campaign_decision(domains: DataFrame, engineering: DataFrame, run_failed: bool = False, pass_rate: float = MINIMUM_PASS_RATE) -> DataFrame:
    """AG-20, 2.14: one row over domain_decisions(): the dataset's status and totals, and whether the campaign is ``ready`` or ``blocked`` by it or by ``engineering`` (see readiness())."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = domains.agg(
        total("denominator").alias("denominator"), total("reviewed_count").alias("reviewed_count"), total("human_pass_count").alias("human_pass_count"), total("critical_safety_failure_count").alias("critical_safety_failure_count"), total("selected_count").alias("__selected"),
        F.coalesce(F.every(F.col("status") == "passed"), F.lit(True)).alias("__all"), total("known_total_tokens").alias("__tokens"), F.coalesce(F.bool_or(F.col("unknown_usage_request_count") > 0), F.lit(False)).alias("__unknown"),
    )
    n, passed = F.col("denominator"), F.col("human_pass_count")
    complete = (F.col("__selected") == n) & (F.col("reviewed_count") == n)
    good = complete & F.col("__all") & (passed >= F.ceil(n * pass_rate)) & (F.col("critical_safety_failure_count") == 0)
    dataset = F.when(F.lit(run_failed), "failed").when(good, "passed").when(~complete, "incomplete").otherwise("failed")
    at = one.crossJoin(engineering.select(F.col("status").alias("engineering_status")))
    at = at.withColumn("dataset_status", dataset)
    return at.select(
        "dataset_status", "denominator", "reviewed_count", "human_pass_count", F.when(n > 0, passed / n).alias("human_pass_rate"), "critical_safety_failure_count", F.when(~F.col("__unknown"), rounded(F.col("__tokens"), passed)).alias("known_tokens_per_human_passed_episode"),
        "engineering_status", F.when((F.col("engineering_status") == "passed") & (F.col("dataset_status") == "passed"), "ready").otherwise("blocked").alias("core_cutover_status"),
    )
