"""Ordered event sequences: final responses, action pairs, routes, grounding and replay (WN-8, WN-9, SQ-10, SQ-11, SF-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.canon import holds


def traces(events: DataFrame) -> DataFrame:
    """One row for each conversation with its events in order, as an array; an episode's events are bounded by its steps."""
    return events.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("idx", "event_type", "content"))).alias("events"))


def final_response(events: DataFrame) -> DataFrame:
    """WN-8: the last final response of each conversation."""
    return events.where(F.col("event_type") == "final_response").groupBy("conv_id").agg(F.max("idx").alias("idx"), F.max_by("content", "idx").alias("content"))


def action_pairs(events: DataFrame) -> DataFrame:
    """WN-9: each action with the type of the event after it, null at the end."""
    by = Window.partitionBy("conv_id").orderBy("idx")
    return events.withColumn("next_type", F.lead("event_type").over(by)).where(F.col("event_type") == "action")


def _first(events: Column, is_one, after: Column | None = None) -> Column:
    """The least index of an event for which ``is_one`` holds, of those after ``after``."""
    hits = F.filter(events, lambda e: is_one(e) & ((e["idx"] > after) if after is not None else F.lit(True)))
    return F.array_min(F.transform(hits, lambda e: e["idx"]))


def route_completion(traced: DataFrame, is_target, is_directory, is_stale, is_failure) -> DataFrame:
    """SQ-10: direct, directory and recovery routes by the order of events.

    The recovery chain takes the earliest event for each step, which finds a
    chain wherever there is one, as each step only needs some later event.
    """
    events = F.col("events")
    out = traced.withColumn("target", _first(events, is_target)).withColumn("directory", _first(events, is_directory))
    out = out.withColumn("stale", _first(events, is_stale))
    out = out.withColumn("failure", _first(events, is_failure, F.col("stale")))
    out = out.withColumn("after_failure", _first(events, is_directory, F.col("failure")))
    later_target = F.exists(events, lambda e: is_target(e) & (e["idx"] > F.col("after_failure")))
    return out.select(
        "conv_id", F.col("target").isNotNull().alias("direct"), F.coalesce(F.col("directory") < F.col("target"), F.lit(False)).alias("by_directory"),
        F.coalesce(later_target & F.col("after_failure").isNotNull() & (F.col("after_failure") < F.col("target")), F.lit(False)).alias("by_recovery"),
    )


def grounded(finals: DataFrame, values: DataFrame) -> DataFrame:
    """SQ-11: whether all required ``value`` rows of a conversation are in its last final response, whatever their case."""
    at = values.join(finals.select("conv_id", "content"), "conv_id", "left")
    found = holds(F.col("content"), F.col("value"))
    return at.groupBy("conv_id").agg(F.every(found).alias("grounded"), F.count(F.lit(1)).alias("required"))


def replay_status(saved: DataFrame, again: DataFrame) -> DataFrame:
    """JN-1, SF-12, AG-23: drift of each conversation between two traces.

    An episode without a second trace is ``not_executed``; events that differ
    or lack a counterpart are observation drift, final responses assessment
    drift.
    """
    both = saved.alias("a").join(again.alias("b"), ["conv_id", "idx"], "full")
    same = F.col("a.event_type").eqNullSafe(F.col("b.event_type")) & F.col("a.content").eqNullSafe(F.col("b.content"))
    final = F.coalesce(F.col("a.event_type"), F.col("b.event_type")) == "final_response"
    flags = both.groupBy("conv_id").agg(F.max(F.col("b.event_type").isNotNull()).alias("executed"), F.max(~same & ~final).alias("observation"), F.max(~same & final).alias("assessment"))
    status = (
        F.when(~F.col("executed"), "not_executed")
        .when(F.col("observation") & F.col("assessment"), "observation_and_assessment_drift")
        .when(F.col("observation"), "observation_drift")
        .when(F.col("assessment"), "assessment_drift")
        .otherwise("aligned")
    )
    return flags.select("conv_id", status.alias("status"))


def whitelisted(payloads: DataFrame, declared: DataFrame) -> DataFrame:
    """PRD-11: payload entries whose key the event's tool declares; ``payloads``: tool_name, key, value; ``declared``: tool_name, key."""
    return payloads.join(declared, ["tool_name", "key"], "left_semi")
