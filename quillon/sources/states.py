"""Frozen states of the three domains: canonical sections in ordered parts, their fingerprint, and back (DM-14, SNK-8, SRC-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import canonical
from .files import read_state, write_state

# Each section's fields; the first is what its rows are sorted by.
SECTIONS = {
    "contacts": ("name", "email"), "followups": ("name", "note"), "messages": ("message_id", "sender", "body"), "reminders": ("message_id", "reminder_text", "remind_at"), "drafts": ("message_id", "content"), "items": ("item_id", "kind", "project_id", "query", "summary"),
}
DOMAINS = {"contacts": ("contacts", "followups"), "mobile_messages": ("messages", "reminders", "drafts"), "workspace_tasks": ("items",)}


def freeze(spark: SparkSession, domain: str, relations: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write a domain's state to ``folder``; its fingerprint and byte_count, those of the state as one canonical JSON object.

    A relation that isn't given is an empty section.
    """
    sections = {}
    for name in DOMAINS[domain]:
        key, *_ = fields = SECTIONS[name]
        rows = relations.get(name, spark.createDataFrame([], ", ".join(f"{f} string" for f in fields)))
        sections[name] = rows.select(canonical({f: F.col(f) for f in fields}).alias("row"), F.col(key).alias("key")), "key"
    return write_state(spark, sections, folder)


def thaw(spark: SparkSession, domain: str, folder: str) -> dict[str, DataFrame]:
    """The relations of a state that freeze() wrote."""
    return {name: read_state(spark, folder, name, ", ".join(f"{f} string" for f in SECTIONS[name])) for name in DOMAINS[domain]}
