"""Model output as data: agent decisions, tool arguments, proposals of a batch and judgments (PRD-13 to PRD-15, PRD-17, PRD-30, PRD-31, JN-11, JN-16, HP-29)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import Payload, first_reason
from ..functions.schemas import call_error
from ..functions.text import safe_identifier
from .review import DIMENSIONS


def decision(p: Payload) -> Column:
    """PRD-14 for one parsed text: kind (tool_call, final_response or null: malformed), tool_name, arguments (a variant) and content; extra fields and texts beyond the bounds are malformed."""
    kind, tool, final = p.text("type"), p.text("tool_name"), p.text("content")
    calls = (kind == "tool_call") & p.only("type", "tool_name", "arguments") & F.length(tool).between(1, 128) & F.try_variant_get(p.get("arguments"), "$", "map<string,variant>").isNotNull()
    ends = (kind == "final_response") & p.only("type", "content") & F.length(final).between(1, 8_000)
    found = F.when(F.coalesce(calls, F.lit(False)), "tool_call").when(F.coalesce(ends, F.lit(False)), "final_response")
    return F.struct(found.alias("kind"), tool.alias("tool_name"), p.get("arguments").alias("arguments"), final.alias("content"))


def with_decision(responses: DataFrame, name: str) -> DataFrame:
    """``responses`` with the decision() of ``content`` in column ``name``; each text is parsed once."""
    out, p, names = Payload.read(responses, F.col("content"))
    out = out.withColumn(name, decision(p)).drop(*names)
    d = F.col(name)
    called = d["kind"] == "tool_call"
    return out.withColumn(name, F.struct(d["kind"].alias("kind"), F.when(called, d["tool_name"]).alias("tool_name"), F.when(called, d["arguments"]).alias("arguments"), F.when(~called, d["content"]).alias("content")))


def agent_decisions(responses: DataFrame) -> DataFrame:
    """PRD-14: ``responses`` (content) with ``decision`` (tool_call, final_response or null: malformed), tool_name, arguments (JSON text) and final_content."""
    d = F.col("__d")
    return with_decision(responses, "__d").withColumns({"decision": d["kind"], "tool_name": d["tool_name"], "arguments": F.to_json(d["arguments"]), "final_content": d["content"]}).drop("__d")


def checked_calls(calls: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """PRD-13, JN-16: the error of each call (tool_name, arguments: JSON text): unknown_tool, invalid_tool_arguments, or null.

    ``tools``: name to input schema, of the tools that are offered; they are
    compiled, so a call is one expression and no join.
    """
    parsed = calls.withColumn("__a", F.try_parse_json("arguments"))
    return parsed.withColumn("error_code", call_error(F.col("tool_name"), F.col("__a"), tools)).drop("__a")


def mapped_proposals(responses: DataFrame, slots: DataFrame) -> DataFrame:
    """PRD-15, JN-11: sequence, slot_id, content and error of every slot of each batch; a batch stands or falls as a whole.

    ``responses``: batch, content (JSON text: proposals with slot_id and
    content, nothing else); ``slots``: batch, sequence, slot_id.  A batch has a
    bounded number of slots, so its ids are compared as arrays.
    """
    responses, p, _ = Payload.read(responses, F.col("content"))
    shape = "array<struct<slot_id:string,content:string>>"
    items = F.try_variant_get(p.get("proposals"), "$", "array<variant>")
    sound = F.forall(items, lambda v: (F.array_sort(F.map_keys(v.cast("map<string,variant>"))) == F.array(F.lit("content"), F.lit("slot_id"))) & (F.schema_of_variant(F.try_variant_get(v, "$.slot_id", "variant")) == "STRING") & (F.schema_of_variant(F.try_variant_get(v, "$.content", "variant")) == "STRING"))
    objects = F.forall(items, lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    formed = p.only("proposals") & F.coalesce(objects, F.lit(False)) & (F.size(items) > 0)
    read = responses.select("batch", F.when(formed, F.when(F.coalesce(sound, F.lit(False)), F.from_json(F.to_json(p.get("proposals")), shape))).alias("proposals"))
    expected = slots.groupBy("batch").agg(F.array_sort(F.collect_list("slot_id")).alias("expected"))
    at = expected.join(read, "batch", "left")
    same = F.array_sort(F.transform("proposals", lambda r: r["slot_id"])) == F.col("expected")
    error = F.when(F.col("proposals").isNull(), "generation_malformed_output").when(~same, "generation_slot_mismatch")
    judged = at.select("batch", error.alias("error"), F.map_from_entries(F.when(error.isNull(), F.col("proposals"))).alias("by_slot"))
    return slots.join(judged, "batch").select("batch", "sequence", "slot_id", F.try_element_at("by_slot", F.col("slot_id")).alias("content"), "error")


def bounded_slots(slots: DataFrame, limit: int) -> DataFrame:
    """PRD-30: the first ``limit`` slots by sequence; an id that repeats among them is an error."""
    first = slots.orderBy("sequence").limit(limit)
    if found := first.groupBy("slot_id").count().where("count > 1").limit(3).collect():
        raise ValueError(f"slot ids repeat: {[r['slot_id'] for r in found]}")
    return first


def unsafe_identifiers(configuration: DataFrame, *names: str) -> DataFrame:
    """PRD-17: the fields of a configuration (a row for each) whose identifiers may not be public: field, value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in names])).alias("p")
    return configuration.select(pairs).select("p.*").where(F.col("value").isNotNull() & ~F.coalesce(safe_identifier(F.col("value")), F.lit(False)))


# What a dimension may be faulted for, and why a judgment may be missing.
REASON_CODES = (
    "instruction_mismatch", "unnecessary_action", "unnecessary_repetition", "ungrounded_observation", "ungrounded_final_response", "unsafe_action", "critical_safety_failure", "ambiguous_observable_evidence",
    "insufficient_observable_evidence", "deterministic_result_conflict",
)
UNAVAILABLE = ("not_requested", "judge_identity_missing", "judge_not_registered", "judge_identity_matches_generator", "judge_identity_matches_agent", "provider_failed", "request_budget_exhausted", "invalid_judgment")


def aggregate_verdict(dimensions: Column) -> Column:
    """AG-12 of an array of dimensions: fail over uncertain over pass."""
    has = lambda v: F.exists(dimensions, lambda d: d["verdict"] == v)
    return F.when(has("fail"), "fail").when(has("uncertain"), "uncertain").otherwise("pass")


def judgment_errors(judgments: DataFrame) -> DataFrame:
    """PRD-31: the first error of each judgment, null if it is sound.

    ``judgments``: availability, verdict, unavailable_reason, judge_id,
    event_count and dimensions (dimension, verdict, reason_codes,
    event_indexes).
    """
    d, here = F.coalesce("dimensions", F.array().cast(judgments.schema["dimensions"].dataType)), F.col("availability") == "available"
    indexes = lambda x: F.coalesce(x["event_indexes"], F.array().cast("array<int>"))
    codes = lambda x: F.coalesce(x["reason_codes"], F.array().cast("array<string>"))
    covers = F.array_sort(F.transform(d, lambda x: x["dimension"])) == F.array(*[F.lit(n) for n in sorted(DIMENSIONS)])
    error = first_reason([
        (F.exists(d, lambda x: F.size(F.array_distinct(indexes(x))) != F.size(indexes(x))), "event_references_repeat"), (F.exists(d, lambda x: (x["verdict"] == "pass") & (F.size(codes(x)) > 0)), "pass_with_reasons"),
        (F.exists(d, lambda x: (x["verdict"] != "pass") & (F.size(codes(x)) == 0)), "no_reason"), (F.exists(d, lambda x: F.exists(codes(x), lambda c: ~c.isin(*REASON_CODES))), "unknown_reason"),
        (here & ((F.col("verdict") == "unavailable") | F.col("unavailable_reason").isNotNull()), "verdict_missing"), (here & ~covers, "dimensions_incomplete"), (here & (aggregate_verdict(d) != F.col("verdict")), "verdict_mismatch"),
        (here & F.col("judge_id").isNull(), "judge_identity_missing"), (here & F.exists(d, lambda x: F.exists(indexes(x), lambda k: (k < 0) | (k >= F.col("event_count")))), "unknown_event"),
        (here & (F.col("event_count") > 0) & F.exists(d, lambda x: F.size(indexes(x)) == 0), "no_event_reference"),
        (~here & ((F.col("verdict") != "unavailable") | (F.size(d) > 0) | ~F.coalesce(F.col("unavailable_reason").isin(*UNAVAILABLE), F.lit(False))), "unavailable_with_dimensions"),
    ])
    return judgments.withColumn("error", error)


def judge_availability(requests: DataFrame) -> DataFrame:
    """PRD-33, HP-22: why each run has no shadow judge, null if it has: requested, judge, registered, generator and agent (identities: structs, or null)."""
    reason = first_reason([
        (~F.coalesce("requested", F.lit(False)), "not_requested"), (F.col("judge").isNull(), "judge_identity_missing"), (~F.coalesce("registered", F.lit(False)), "judge_not_registered"),
        (F.col("judge").eqNullSafe(F.col("generator")), "judge_identity_matches_generator"), (F.col("judge").eqNullSafe(F.col("agent")), "judge_identity_matches_agent"),
    ])
    return requests.withColumn("unavailable_reason", reason)
