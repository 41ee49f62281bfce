"""What is exchanged as JSON: model requests and their contracts, public records with fields that may be left out, private cases in base64 (PRD-35, 2.8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.canon import json_string
from .admission import GATES

# The output that each role is asked for, as JSON schemas.
GENERATION_CONTRACT = {
    "type": "object", "additionalProperties": False, "required": ["proposals"],
    "properties": {"proposals": {"type": "array", "items": {"type": "object", "additionalProperties": False, "required": ["slot_id", "content"], "properties": {"slot_id": {"type": "string"}, "content": {"type": "string"}}}}},
}
AGENT_CONTRACT = {
    "oneOf": [
        {"type": "object", "additionalProperties": False, "required": ["type", "tool_name", "arguments"], "properties": {"type": {"const": "tool_call"}, "tool_name": {"type": "string"}, "arguments": {"type": "object"}}},
        {"type": "object", "additionalProperties": False, "required": ["type", "content"], "properties": {"type": {"const": "final_response"}, "content": {"type": "string"}}},
    ]
}


def joined(fields: dict[str, Column]) -> Column:
    """A JSON object of values that are JSON text already, keys sorted; a null value leaves its field out."""
    parts = [F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value)) for name, value in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def flag(condition: Column) -> Column:
    return F.when(condition, "true").otherwise("false")


def strings(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, json_string), ","), F.lit("]"))


def shown_event(e: Column) -> Column:
    """An event of rollout.EVENT without the fields that it lacks; ``arguments`` are JSON text, payloads maps of text."""
    texts = {n: F.when(e[n].isNotNull(), json_string(e[n])) for n in ("event_type", "tool_name", "content", "error_code")}
    payload = lambda m: F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat(json_string(x["key"]), F.lit(":"), json_string(x["value"]))), ","), F.lit("}"))
    return joined(texts | {"arguments": e["arguments"], "observation": payload(e["observation"]), "change": payload(e["change"])})


def agent_context(instruction: Column, tools: Column, events: Column, remaining: Column) -> Column:
    """The data that an agent's request shows: the task with its ``tools`` (JSON text), the events so far, and the steps left."""
    history = F.concat(F.lit("["), F.array_join(F.transform(events, shown_event), ","), F.lit("]"))
    return joined({"task": joined({"instruction": json_string(instruction), "tools": tools}), "observable_history": history, "remaining_step_budget": remaining.cast("string")})


def generation_context(slots: Column) -> Column:
    """The data that a generation request shows: its slots (slot_id, proposal_prompt)."""
    each = lambda s: joined({"slot_id": json_string(s["slot_id"]), "proposal_prompt": json_string(s["proposal_prompt"])})
    return joined({"slots": F.concat(F.lit("["), F.array_join(F.transform(slots, each), ","), F.lit("]"))})


def assessment_record(a: Column) -> Column:
    """An assessment as public JSON; its review stratification only where the domain has one."""
    checks = F.concat(F.lit("["), F.array_join(F.transform(a["checks"], lambda c: joined({"name": json_string(c["name"]), "passed": flag(c["passed"])})), ","), F.lit("]"))
    axes = F.when(a["task_type"].isNotNull() & a["difficulty"].isNotNull(), joined({"task_type": json_string(a["task_type"]), "difficulty": json_string(a["difficulty"])}))
    return joined({
        "passed": flag(a["passed"]), "checks": checks, "reason_codes": strings(a["reason_codes"]), "coverage_tags": strings(a["coverage_tags"]), "structural_key": json_string(a["structural_key"]),
        "state_change_evidence": json_string(a["state_change_evidence"]), "review_stratification": axes,
    })


def admission_record(mode: Column, admitted: Column, gates: Column, judgment: Column, policy_id: Column) -> Column:
    """An admission as public JSON; what enforcement adds only in its mode."""
    enforced = lambda value: F.when(mode == "enforced", json_string(value))
    return joined({
        "mode": json_string(mode), "status": F.when(admitted, F.lit('"admitted"')).otherwise('"rejected"'), "gates": joined({g: flag(gates[g]) for g in GATES}), "human_review_status": F.lit('"unreviewed"'),
        "semantic_judgment": enforced(judgment), "semantic_policy_id": enforced(policy_id),
    })


def stored(text: Column) -> Column:
    """2.8: a private case as the ledger keeps it, base64 of its UTF-8 bytes in one line."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\\r\\n]", "")


def unstored(encoded: Column) -> Column:
    """The text of a stored case; null where it isn't base64 of UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(encoded, F.lit("base64")).cast("string"))
