"""Deterministic admission: gates, reasons, de-duplication, targets and reports (PRD-1, PRD-2, WN-1, WN-2, AG-5, AG-9, AG-18, AG-19)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.canon import numbered_id
from ..functions.text import forbidden_text

# The gates in their order.
GATES = ("execution", "mutation_authorization", "assessment", "final_grounding", "unsafe_material", "semantic_key")


def gate_admission(episodes: DataFrame) -> DataFrame:
    """PRD-1, PRD-2: ``gates`` (a struct), ``gates_passed`` and the first reason of a rejection, by the order of precedence.

    Episodes have terminal_reason (null where they ran to their end),
    mutation_authorization, passed and reason_codes (of the assessment), grounded and
    unsafe (null: not).  An executed episode always has a semantic key.
    """
    gates = {
        "execution": F.col("terminal_reason").isNull(), "mutation_authorization": ~F.col("mutation_authorization").eqNullSafe(F.lit("rejected")), "assessment": F.coalesce("passed", F.lit(False)),
        "final_grounding": F.coalesce("grounded", F.lit(False)), "unsafe_material": ~F.coalesce("unsafe", F.lit(False)), "semantic_key": F.lit(True),
    }
    at = episodes.withColumn("gates", F.struct(*[gates[g].alias(g) for g in GATES]))
    reason = (
        F.when(F.col("terminal_reason").isNotNull(), F.col("terminal_reason"))
        .when(~F.col("gates.unsafe_material"), "unsafe_public_material")
        .when(~F.col("gates.mutation_authorization"), "unauthorized_mutation")
        .when(~F.col("gates.final_grounding"), "final_response_grounding_missing")
        .when(~F.col("gates.assessment"), F.coalesce(F.try_element_at("reason_codes", F.lit(1)), F.lit("deterministic_assessment_failed")))
    )
    return at.withColumn("gates_passed", reduce(lambda x, y: x & y, [F.col(f"gates.{g}") for g in GATES])).withColumn("gate_reason", reason)


# The reasons that refuse a change before execution; the public task of what has none.
CHANGE_REFUSED = ("mutation_not_authorized_by_public_task", "unauthorized_mutation")
NO_TASK = ("Task generation failed before public task compilation.", "unavailable")


def pre_execution_negatives(rejections: DataFrame, run_id: Column | None = None) -> DataFrame:
    """PRD-3 to PRD-5: the episodes of what failed before it ran; ``rejections``: sequence, domain_id, reason_code, instruction and tools (null where generation failed)."""
    run = run_id if run_id is not None else F.lit("run")
    instruction = F.coalesce("instruction", F.lit(NO_TASK[0]))
    closed = {g: F.lit(False) for g in GATES} | {"mutation_authorization": ~F.col("reason_code").isin(*CHANGE_REFUSED), "unsafe_material": ~forbidden_text(instruction)}
    return rejections.select(
        numbered_id("episode", run, F.col("sequence")).alias("episode_id"), numbered_id("candidate", run, F.col("sequence")).alias("candidate_id"), "sequence", "domain_id", instruction.alias("instruction"),
        F.coalesce("tools", F.array(F.lit(NO_TASK[1]))).alias("tools"), F.struct(*[closed[g].alias(g) for g in GATES]).alias("gates"), F.lit("negatives").alias("collection"), F.lit("rejected_before_execution").alias("status"), "reason_code",
    )


def semantic_dedup(admitted: DataFrame) -> DataFrame:
    """WN-1: after the first passing episode of a semantic key, every later one is a duplicate.

    The winner of a key is an aggregate, joined back, so a key that many
    episodes share never meets in one task.
    """
    winners = admitted.where("gates_passed").groupBy("semantic_key").agg(F.min("sequence").alias("winner"))
    at = admitted.join(winners, "semantic_key", "left")
    duplicate = F.coalesce(F.col("sequence") > F.col("winner"), F.lit(False))
    out = at.withColumn("duplicate", duplicate).withColumn("admitted", F.col("gates_passed") & ~F.col("duplicate"))
    reason = F.when(F.col("duplicate"), "duplicate_semantic_task").otherwise(F.col("gate_reason"))
    collection = F.when(F.col("admitted"), "demonstrations").otherwise("negatives")
    return out.withColumn("reason_code", reason).withColumn("collection", collection).drop("winner")


def accepted_prefix(episodes: DataFrame, target: int) -> DataFrame:
    """WN-2 by domain: the shortest prefix by sequence that holds ``target`` admitted episodes.

    The sequence of the last accepted episode is found by a top-k of admitted
    rows (``target`` of them), not by a running sum over all rows.
    """
    first = first_admitted(episodes, target)
    last = first.groupBy("domain_id").agg(F.max("sequence").alias("last"), F.count(F.lit(1)).alias("n"))
    last = last.select("domain_id", F.when(F.col("n") == target, F.col("last")).alias("last"))
    return episodes.join(last, "domain_id", "left").where(F.col("last").isNull() | (F.col("sequence") <= F.col("last"))).drop("last")


def first_admitted(episodes: DataFrame, n: int) -> DataFrame:
    """WN-10, by domain: the first ``n`` admitted episodes by sequence."""
    by = Window.partitionBy("domain_id").orderBy("sequence")
    return episodes.where("admitted").withColumn("ordinal", F.row_number().over(by)).where(F.col("ordinal") <= n)


def gate_counts(episodes: DataFrame) -> DataFrame:
    """AG-9: passes and failures of each gate, as the report names them."""
    sums = episodes.agg(*[F.count_if(F.col(f"gates.{g}")).alias(g) for g in GATES], F.count(F.lit(1)).alias("n"))
    stacked = ", ".join(f"'{g.removeprefix('mutation_')}', {g}" for g in GATES)
    return sums.selectExpr("n", f"stack({len(GATES)}, {stacked}) as (gate, passed)").select("gate", "passed", (F.col("n") - F.col("passed")).alias("failed"))


def run_report(episodes: DataFrame, allocated: DataFrame | None = None) -> DataFrame:
    """AG-5, AG-18: totals by domain; with ``allocated`` (domain_id, one row a slot) attempts, and what hasn't come to an end."""
    ended = episodes.groupBy("domain_id").agg(F.count(F.lit(1)).alias("terminal_count"), F.count_if("admitted").alias("accepted_count"), F.count_if(~F.col("admitted")).alias("negative_count"))
    if allocated is None:
        return ended
    slots = allocated.groupBy("domain_id").agg(F.count(F.lit(1)).alias("attempt_count"))
    known = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("terminal_count", "accepted_count", "negative_count")]
    return slots.join(ended, "domain_id", "left").select("domain_id", "attempt_count", *known, (F.col("attempt_count") - F.coalesce("terminal_count", F.lit(0))).alias("incomplete_count"))


def family_share(episodes: DataFrame) -> DataFrame:
    """AG-10, AG-19: families of admitted episodes by domain, and the share of the largest as a pair of counts."""
    families = episodes.where("admitted").groupBy("domain_id", "structural_key").agg(F.count(F.lit(1)).alias("n"))
    return families.groupBy("domain_id").agg(F.count(F.lit(1)).alias("family_count"), F.max("n").alias("largest_family"), F.sum("n").alias("admitted_count"))


def rejection_causes(episodes: DataFrame) -> DataFrame:
    """AG-19: rejections by domain and cause; null causes are ``unspecified``."""
    return episodes.where(~F.col("admitted")).groupBy("domain_id", F.coalesce("reason_code", F.lit("unspecified")).alias("reason_code")).agg(F.count(F.lit(1)).alias("n"))


def generation_batches(slots: DataFrame, batch: int) -> DataFrame:
    """WN-3: the batch of each slot and the batch's bounds."""
    numbered = slots.withColumn("batch", F.floor((F.col("sequence") - 1) / F.lit(batch)))
    return numbered.groupBy("batch").agg(F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence"), F.count(F.lit(1)).alias("slots"))


def run_status(runs: DataFrame) -> DataFrame:
    """SF-10: status and reason of each run, by the order of precedence.

    ``runs``: cancelled, stop_reason, accepted_target (null: none),
    accepted_count, allocated_count, slot_limit and known_task_capacity (null:
    unknown).  A target that the known capacity can't reach fails before the
    run begins, whatever it then counts.
    """
    target, stop = F.col("accepted_target"), F.col("stop_reason")
    met = target.isNotNull() & (F.col("accepted_count") >= target)
    short = target.isNotNull() & (F.col("known_task_capacity") < target)
    stopped = F.coalesce(stop.isin("provider_request_budget_exhausted", "scheduler_no_progress"), F.lit(False))
    missed = F.when(F.col("allocated_count") < F.col("slot_limit"), "domain_slot_exhausted").when(F.col("known_task_capacity").isNull(), "unknown_task_capacity").otherwise("bounded_replacement_exhausted")
    cases = [(short, "failed", F.lit("known_task_capacity_insufficient")), (F.coalesce("cancelled", F.lit(False)), "cancelled", F.lit("operator_cancelled")), (met, "completed", F.lit(None).cast("string")), (stopped, "partial", stop), (target.isNotNull(), "partial", missed)]
    status, reason = F.lit("completed"), F.lit(None).cast("string")
    for condition, name, why in reversed(cases):
        condition = F.coalesce(condition, F.lit(False))
        status, reason = F.when(condition, name).otherwise(status), F.when(condition, why).otherwise(reason)
    return runs.withColumn("status", status).withColumn("reason", reason)


def work_states(slots: DataFrame, claims: DataFrame, cases: DataFrame, outcomes: DataFrame) -> DataFrame:
    """SF-1: the state of every slot (sequence): an outcome ends it; else its claim (sequence, status: generating or running) tells, else whether it has a case."""
    flag = lambda df, name: df.select("sequence").distinct().withColumn(name, F.lit(True))
    at = slots.select("sequence").join(claims.select("sequence", F.col("status").alias("claimed")), "sequence", "left").join(flag(cases, "has_case"), "sequence", "left").join(flag(outcomes, "ended"), "sequence", "left")
    status = F.when(F.col("ended"), "terminal").otherwise(F.coalesce("claimed", F.when(F.col("has_case"), "compiled").otherwise("pending")))
    return at.select("sequence", status.alias("status"), F.coalesce("has_case", F.lit(False)).alias("has_case"))


def recovered_state(work: DataFrame) -> DataFrame:
    """SF-2: work in flight goes back to compiled where a case exists, else to pending."""
    flying = F.col("status").isin("generating", "running")
    return work.withColumn("recovered", F.when(flying, F.when(F.col("has_case"), "compiled").otherwise("pending")).otherwise(F.col("status")))


def enforced(admitted: DataFrame, judgments: DataFrame) -> DataFrame:
    """PRD-27: what passed every gate is admitted only where its judgment (sequence, judge_verdict) passed; a missing one is unavailable.

    Everything else keeps its outcome.
    """
    at = admitted.join(judgments.select("sequence", "judge_verdict"), "sequence", "left")
    verdict = F.coalesce("judge_verdict", F.lit("unavailable"))
    refused = F.col("admitted") & (verdict != "pass")
    return at.select(
        *[c for c in admitted.columns if c not in ("admitted", "collection", "reason_code")], (F.col("admitted") & ~refused).alias("admitted"),
        F.when(refused, "negatives").otherwise(F.col("collection")).alias("collection"), F.when(refused, F.concat(F.lit("semantic_judge_"), verdict)).otherwise(F.col("reason_code")).alias("reason_code"),
    )
