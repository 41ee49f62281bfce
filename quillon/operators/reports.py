"""Reports of counts, as relations and as JSON (AG-9 to AG-11, AG-22, PRD-28, SNK-5, SNK-7, SNK-10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .admission import GATES
from .review import label_summary


def _section(df: DataFrame, section: str, name: Column, *counts: tuple[str, Column]) -> DataFrame:
    """Rows (section, name, count) of a frame of counts."""
    stacked = F.explode(F.array(*[F.struct(F.lit(label).alias("label"), value.cast("long").alias("n")) for label, value in counts])).alias("c")
    return df.select(F.lit(section).alias("section"), name.alias("key"), stacked).select("section", F.when(F.col("c.label") == "", F.col("key")).otherwise(F.concat_ws(".", "key", "c.label")).alias("name"), F.col("c.n").alias("n"))


def quality_counts(episodes: DataFrame, judgments: DataFrame, allocated: int | None = None, capacity: int | None = None, usage: DataFrame | None = None, members: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """AG-9 to AG-11: the report's counts, in rows (section, name, n); it has no scores, only counts.

    ``episodes``: admitted, collection, reason_code, structural_key,
    coverage_tags, gates; ``judgments``: availability, verdict; ``usage``: role
    and counts; ``members`` and ``labels``: as of review.label_summary(), for
    the sections of review.  One aggregate over the episodes, one for families
    and one for the judgments.
    """
    admitted = F.col("collection") == "demonstrations"
    recovery = F.coalesce(F.array_contains("coverage_tags", "recovery"), F.lit(False))
    passed = [F.count_if(F.col(f"gates.{g}")).alias(f"pass_{g}") for g in GATES]
    one = episodes.agg(
        F.count(F.lit(1)).alias("terminal"), F.count_if(admitted).alias("admitted"), F.count_if(F.col("reason_code") == "duplicate_semantic_task").alias("duplicates"), F.count_if(recovery & admitted).alias("recovered"), F.count_if(recovery & ~admitted).alias("lost"), *passed,
    )
    n, a, none = F.col("terminal"), F.col("admitted"), F.lit(None).cast("string")
    parts = [
        _section(one, "yield", none, ("terminal_episode_count", n), ("deterministically_admitted_demonstration_count", a), ("negative_count", n - a), ("allocated_task_attempt_count", F.lit(allocated) if allocated is not None else n)),
        _section(one, "duplicates", none, ("duplicate_semantic_task_count", F.col("duplicates"))), _section(one, "capacity", none, ("known_task_capacity", F.lit(capacity))),
        _section(one, "recovery", none, ("demonstration_recovery_count", F.col("recovered")), ("negative_recovery_count", F.col("lost"))), _section(one, "admission_status", none, ("admitted", a), ("rejected", n - a)),
        _section(one, "gate_pass", none, *[(g.removeprefix("mutation_"), F.col(f"pass_{g}")) for g in GATES]), _section(one, "gate_failure", none, *[(g.removeprefix("mutation_"), n - F.col(f"pass_{g}")) for g in GATES]),
        _section(episodes.where("structural_key is not null").groupBy("collection", "structural_key").agg(F.count(F.lit(1)).alias("n")), "structural_family", F.concat_ws(".", "collection", "structural_key"), ("", F.col("n"))),
        _section(judgments.groupBy("availability").agg(F.count(F.lit(1)).alias("n")), "judgment_availability", F.col("availability"), ("", F.col("n"))), _section(judgments.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")), "judgment_verdict", F.col("verdict"), ("", F.col("n"))),
    ]
    uncertain = judgments.agg(F.count_if(F.col("verdict") == "unavailable").alias("n"))
    parts += [
        _section(one, "demonstration_yield", none, ("numerator", a), ("denominator", n)), _section(one, "capacity_known", none, ("", F.lit(int(capacity is not None)))), _section(one, "review_status", none, ("unreviewed", n)),
        _section(uncertain, "judgment", none, ("unavailable_as_uncertain_count", F.col("n"))),
    ]
    if usage is not None:
        parts.append(_section(usage, "usage", F.col("role"), *[(c, F.col(c)) for c in usage.columns if c != "role"]))
    if members is not None:
        summary = label_summary(members, labels, approved=False)
        verdicts = [(v, F.col(f"{v}_count")) for v in ("pass", "fail", "uncertain")]
        accepted = [(c, F.col(f"evaluation_{c}")) for c in ("denominator", "reviewed_count", "human_pass_count", "incomplete_count")]
        parts += [
            _section(summary, "label_import_status", F.col("status"), ("", F.lit(1))), _section(summary, "human_verdict", none, *verdicts), _section(summary, "demonstration_acceptance", none, *accepted),
            _section(members.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("n")), "cohort_members", F.col("cohort_id"), ("", F.col("n"))),
        ]
    return reduce(DataFrame.unionByName, parts)


def as_json(counts: DataFrame) -> DataFrame:
    """SNK-5, SNK-7: one row: the counts as a JSON object of sections, keys sorted; a report of bounded length, computed anew whenever it is asked for."""
    sections = counts.groupBy("section").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("counts"))
    return sections.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", F.to_json("counts").alias("counts"))))).cast("map<string,string>")).alias("report"))


def deterministic_results(episodes: DataFrame) -> DataFrame:
    """PRD-28: an episode's gates and checks without its admission."""
    return episodes.select("episode_id", "gates", F.col("assessment.checks").alias("checks"), F.col("assessment.reason_codes").alias("reason_codes"))


def pilot_report(episodes: DataFrame, replay_aligned: bool, target: int, attempt_limit: int) -> DataFrame:
    """AG-22: one row: what a pilot's episodes showed, and whether that is enough.

    ``episodes``: collection, admitted, mutation_authorization, events (with
    event_type, tool_name, error_code) and assessment (with passed and
    structural_key; null where nothing ran).  The behaviours are those of
    admitted demonstrations whose assessment passed.
    """
    a, shown = F.col("assessment"), F.col("collection") == "demonstrations"
    good = F.coalesce(shown & F.col("admitted") & a["passed"], F.lit(False))
    has = lambda test: F.coalesce(F.exists("events", test), F.lit(False))
    behaviours = {
        "direct_lookup": a["structural_key"] == "contacts.lookup.direct",
        "authorized_mutation": (F.col("mutation_authorization") == "authorized") & a["structural_key"].startswith("contacts.followup.") & has(lambda e: (e["event_type"] == "state_change") & (e["tool_name"] == "record_followup")),
        "successful_recovery": a["structural_key"].endswith(".recovery") & has(lambda e: (e["event_type"] == "error") & (e["error_code"] == "contact_not_found")),
    }
    one = episodes.agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(shown).alias("demonstrations"), F.count_if(F.col("collection") == "negatives").alias("negatives"), *[F.coalesce(F.bool_or(good & F.coalesce(test, F.lit(False))), F.lit(False)).alias(name) for name, test in behaviours.items()],
        F.count_if(a.isNotNull()).alias("executed_episode_count"), F.count_if(shown & a["passed"]).alias("passed_assessment_count"), F.count_if("admitted").alias("admitted_episode_count"),
    )
    every = reduce(Column.__and__, [F.col(name) for name in behaviours])
    one = one.withColumns({"target_demonstrations_met": F.col("demonstrations") >= target, "attempt_ceiling_respected": F.col("attempted") <= attempt_limit, "minimum_behavior_examples_met": every, "replay_aligned": F.lit(replay_aligned)})
    met = F.col("attempt_ceiling_respected") & F.col("minimum_behavior_examples_met") & F.col("replay_aligned")
    return one.withColumn("diagnostic_outcome", F.when(met, "required_behaviors_observed").otherwise("insufficient_evidence"))


def pilot_failures(episodes: DataFrame) -> DataFrame:
    """AG-22: the negatives of a pilot with why they failed."""
    codes = F.coalesce("assessment.reason_codes", F.array().cast("array<string>"))
    return episodes.where(F.col("collection") == "negatives").select("episode_id", F.coalesce("reason_code", F.lit("unspecified_failure")).alias("reason_code"), codes.alias("verification_reason_codes"))


def eligibility_report(reasons: DataFrame) -> DataFrame:
    """SNK-10, HP-18: one row: the reasons that were found (position, reason, found) in order, each once, and whether there are none."""
    met = reasons.where("found").groupBy("reason").agg(F.min("position").alias("position"))
    listed = met.agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "reason"))), lambda r: r["reason"]).alias("reasons"))
    return listed.withColumn("eligible", F.size("reasons") == 0)
