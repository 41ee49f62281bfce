"""Readers of domain sources and of the engine's record files (SRC-1 to SRC-6, SRC-8 to SRC-10, SRC-12 to SRC-19, PRD-12).

Every reader has an explicit schema.  A source that breaks a rule is refused
whole: the rules' violations are looked for in one job, and SourceError tells
the first rules that are broken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import casefold, stripped
from ..functions.payload import Payload
from ..functions.text import note_allowed, reply_allowed, safe_identifier
from .files import digests, listed, numbered_lines

CONTACTS = "contacts array<struct<name:string,email:string>>, followups array<struct<name:string,note:string>>"
MESSAGES = "messages array<struct<message_id:string,sender:string,body:string>>, reminders array<struct<message_id:string,reminder_text:string,remind_at:string>>, drafts array<struct<message_id:string,content:string>>"
WORKSPACE = "projects array<struct<project_id:string,name:string>>, tasks array<struct<task_id:string,project_id:string,title:string>>, documents array<struct<document_id:string,project_id:string,title:string>>, comments array<struct<comment_id:string,task_id:string,body:string>>"
EVENT = "struct<event_type:string,tool_name:string,arguments:map<string,string>,observation:map<string,string>,change:map<string,string>,content:string,error_code:string>"
TOOL = "struct<name:string,description:string,input_schema:string,output_schema:string>"
VERIFICATION = "struct<passed:boolean,checks:array<struct<name:string,passed:boolean>>,reason_codes:array<string>,coverage_tags:array<string>,structural_key:string,state_change_evidence:string,review_stratification:struct<task_type:string,difficulty:string>>"
GATES = "struct<execution:boolean,mutation_authorization:boolean,assessment:boolean,final_grounding:boolean,unsafe_material:boolean,semantic_key:boolean>"
ADMISSION = f"struct<mode:string,status:string,gates:{GATES},human_review_status:string,semantic_judgment:string,semantic_policy_id:string>"
ROLE = "struct<role:string,provider_id:string,model_id:string,model_version:string,physical_request_count:int,retry_count:int,response_hashes:array<string>,known_input_tokens:bigint,known_output_tokens:bigint,known_total_tokens:bigint,unknown_usage_count:int>"
EPISODE = (
    f"schema_version string, episode_id string, candidate_id string, sequence int, domain_id string, domain_version string, task struct<instruction:string,tools:array<{TOOL}>>, events array<{EVENT}>, mutation_authorization string, "
    f"outcome struct<collection:string,status:string,reason_code:string>, verification {VERIFICATION}, admission {ADMISSION}, lineage struct<model_id:string,model_version:string,roles:array<{ROLE}>>"
)
COHORT = "schema_version string, cohort_id string, purpose string, membership_hash string, episode_ids array<string>, candidate_count int, nonpass_or_unavailable_count int, stratified_pass_count int, selection_method string, stratified_pass_stratum_count int, campaign_id string, quality_policy_id string, quality_policy_fingerprint string"
CONFIGURATION = (
    "run_id string, domain_id string, model_id string, slot_limit int, accepted_target int, generation_batch_size int, max_concurrency int, step_limit int, total_request_limit int, generation_request_limit int, agent_request_limit int, transport_retry_limit int, "
    "decision_repair_limit int, timeout_seconds double, max_response_bytes int, max_output_tokens int, admission_mode string"
)
REQUEST = "request_id int, role string, logical_request_id string, attempt int, sequence int, related_sequences array<int>, request_kind string, status string, response_hash string, usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>, error_code string"
DIMENSION = "struct<dimension:string,verdict:string,reason_codes:array<string>,event_references:array<struct<event_index:int>>>"
LABEL = f"schema_version string, episode_id string, cohort_id string, purpose string, dimensions array<{DIMENSION}>, reviewer_provenance struct<reviewer_id:string,review_method:string,human_review_attestation:string>"
# What an event of each type may carry; the bounds and defaults of a configuration's numbers.
EVENT_FIELDS = {"action": ("tool_name", "arguments"), "observation": ("tool_name", "observation"), "state_change": ("tool_name", "change"), "final_response": ("content",), "error": ("tool_name", "error_code")}
BOUNDS = {
    "slot_limit": (1, 10_000, None), "accepted_target": (1, 10_000, None), "generation_batch_size": (1, 64, 8), "max_concurrency": (1, 16, 4), "step_limit": (1, 64, 12), "total_request_limit": (1, 100_000, 256), "generation_request_limit": (1, 100_000, 64),
    "agent_request_limit": (1, 100_000, 192), "transport_retry_limit": (0, 2, 2), "decision_repair_limit": (0, 1, 1), "max_response_bytes": (256, 1_000_000, 64_000), "max_output_tokens": (1, 32_768, 1_024),
}
#: The tables of a run and the keys that order them (1.6).
TABLES = {"allocated_slots": "sequence", "work_items": "sequence", "task_cases": "sequence", "terminal_outcomes": "sequence", "quality_judgments": "sequence", "provider_requests": "request_id"}


class SourceError(ValueError):
    """A source that breaks a rule, with the rule and the first rows that do."""


def checked(frame: DataFrame, rules: dict[str, DataFrame]) -> DataFrame:
    """``frame``, if there are no violations of any of ``rules``; else SourceError.  One job looks for all."""
    rows = [violations.select(F.lit(rule).alias("rule"), F.to_json(F.struct(*violations.columns)).alias("row")) for rule, violations in rules.items()]
    if found := reduce(DataFrame.unionByName, rows).limit(3).collect():
        raise SourceError("; ".join(f"{r['rule']}: {r['row']}" for r in found))
    return frame


def blank(column: Column) -> Column:
    return column.isNull() | (stripped(column) == "")


def repeats(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _rows(source: DataFrame, name: str) -> DataFrame:
    return source.select(F.explode(F.col(name)).alias("r")).select("r.*")


def none_of(frame: DataFrame) -> DataFrame:
    """A row if the frame is empty."""
    return frame.agg(F.count(F.lit(1)).alias("n")).where("n = 0")


def read_contacts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-1: contacts (name, email) and followups (name, note), trimmed."""
    source = spark.read.schema(CONTACTS).json(path, multiLine=True)
    strip = lambda c: stripped(F.col(c)).alias(c)
    contacts = _rows(source, "contacts").select(strip("name"), strip("email"))
    followups = _rows(source, "followups").select(strip("name"), "note")
    wrong = blank(F.col("name")) | blank(F.col("email")) | (F.length("name") > 160) | (F.length("email") > 320)
    rules = {
        "a name and an address": contacts.where(wrong), "names are unique": repeats(contacts, "name"), "at least one contact": none_of(contacts), "allowed notes": followups.where(~F.coalesce(note_allowed(F.col("note")), F.lit(False))),
        "one followup for a contact": repeats(followups, "name"), "known contacts": followups.join(contacts, "name", "left_anti"),
    }
    return checked(contacts, rules), followups


def read_messages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """SRC-2, SRC-3: messages, reminders and drafts; texts are not trimmed."""
    source = spark.read.schema(MESSAGES).json(path, multiLine=True)
    messages, reminders, drafts = (_rows(source, n) for n in ("messages", "reminders", "drafts"))
    wrong = reduce(lambda a, b: a | b, [blank(F.col(c)) | (F.length(c) > 1000) for c in ("message_id", "sender", "body")])
    rules = {
        "an id, a sender and a body": messages.where(wrong), "ids are unique": repeats(messages, "message_id"), "at least one message": none_of(messages), "reminders have texts": reminders.where(blank(F.col("reminder_text")) | blank(F.col("remind_at"))),
        "allowed replies": drafts.where(~F.coalesce(reply_allowed(F.col("content")), F.lit(False))), "one reminder for a message": repeats(reminders, "message_id"), "one draft for a message": repeats(drafts, "message_id"),
        "reminders of known messages": reminders.join(messages, "message_id", "left_anti"), "drafts of known messages": drafts.join(messages, "message_id", "left_anti"),
    }
    return checked(messages, rules), reminders, drafts


# Fixed value: the verbs that a task's query leaves out.
OPENING_VERB = r"^(complete|finalize|prepare|review|schedule|summarize)\s+"


def workspace_query(kind: Column, summary: Column) -> Column:
    """DM-10: the case-folded summary; a task's without its opening verb."""
    low = casefold(summary)
    return F.when(kind == "task", F.regexp_replace(low, OPENING_VERB, "")).otherwise(low)


def read_workspace(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4 to SRC-6: all items (item_id, kind, query, summary, project_id), their parents known and their ids unique over all kinds."""
    source = spark.read.schema(WORKSPACE).json(path, multiLine=True)
    part = lambda name, kind, key, summary, parent: _rows(source, name).select(F.col(key).alias("item_id"), F.lit(kind).alias("kind"), F.col(summary).alias("summary"), (F.col(parent) if parent else F.lit(None).cast("string")).alias("project_id"))
    projects, tasks = part("projects", "project", "project_id", "name", None), part("tasks", "task", "task_id", "title", "project_id")
    documents, comments = part("documents", "document", "document_id", "title", "project_id"), part("comments", "comment", "comment_id", "body", "task_id")
    rules = {rule: child.join(parent.select(F.col("item_id").alias("project_id")), "project_id", "left_anti") for child, parent, rule in ((tasks, projects, "tasks of known projects"), (documents, projects, "documents of known projects"), (comments, tasks, "comments of known tasks"))}
    items = projects.unionByName(tasks).unionByName(documents).unionByName(comments)
    wrong = blank(F.col("item_id")) | blank(F.col("summary")) | (F.length("item_id") > 1000) | (F.length("summary") > 1000)
    rules |= {"an id and a summary": items.where(wrong), "ids are unique over all kinds": repeats(items, "item_id"), "at least one item": none_of(items)}
    return checked(items, rules).withColumn("query", workspace_query(F.col("kind"), F.col("summary")))


def fixtures(spark: SparkSession) -> dict[str, DataFrame]:
    """SRC-8: the built-in sources, by domain and relation."""
    contacts = spark.createDataFrame(FIXTURE_CONTACTS, "name string, email string")
    messages = spark.createDataFrame(FIXTURE_MESSAGES, "message_id string, sender string, body string")
    items = spark.createDataFrame(FIXTURE_ITEMS, "item_id string, kind string, summary string, project_id string")
    empty = lambda schema: spark.createDataFrame([], schema)
    return {
        "contacts": contacts, "followups": empty("name string, note string"), "messages": messages, "reminders": empty("message_id string, reminder_text string, remind_at string"), "drafts": empty("message_id string, content string"),
        "items": items.withColumn("query", workspace_query(F.col("kind"), F.col("summary"))),
    }


# The built-in contacts, messages and workspace items.
FIXTURE_CONTACTS = [("Alice Zhang", "alice.zhang@example.test"), ("Ben Carter", "ben.carter@example.test")]
FIXTURE_MESSAGES = [("message-aurora-001", "Alex Kim", "Please review the launch checklist before Friday."), ("message-invoice-002", "Bella Chen", "Could you check the invoice before Monday?")]
FIXTURE_ITEMS = [
    ("project-alpha-001", "project", "Alpha Launch", None), ("project-beta-002", "project", "Beta Research", None), ("task-launch-plan-001", "task", "Finalize launch plan", "project-alpha-001"),
    ("task-research-notes-002", "task", "Summarize research notes", "project-beta-002"), ("task-metrics-review-003", "task", "Review metrics dashboard", "project-alpha-001"), ("document-launch-brief-001", "document", "Launch Brief", "project-alpha-001"),
]


def event_error(e: Column) -> Column:
    """PRD-12: whether an event has an unknown type, a field that its type may not carry, or lacks what it needs."""
    stray = F.lit(False)
    for kind, allowed in EVENT_FIELDS.items():
        for field in ("tool_name", "arguments", "observation", "change", "content", "error_code"):
            if field not in allowed:
                stray = stray | ((e["event_type"] == kind) & e[field].isNotNull())
    lacks = ((e["event_type"] == "final_response") & e["content"].isNull()) | ((e["event_type"] == "error") & e["error_code"].isNull())
    code = e["error_code"].isNotNull() & ~e["error_code"].rlike(r"^[a-z][a-z0-9_]*\z")
    return ~F.coalesce(e["event_type"].isin(*EVENT_FIELDS), F.lit(False)) | F.coalesce(stray | lacks | code | (F.length(e["content"]) > 8000), F.lit(False))


def read_episodes(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-12, PRD-12: episodes of both collections, by sequence; a line that isn't JSON, a row without an id, or a malformed event refuses the file."""
    rows = spark.read.schema(EPISODE + ", __broken string").option("columnNameOfCorruptRecord", "__broken").json(list(paths))
    broken = rows.where(F.col("__broken").isNotNull() | F.col("episode_id").isNull()).select("sequence", "__broken")
    episodes = rows.drop("__broken")
    wrong = rows.where(F.exists("events", event_error)).select("episode_id")
    return checked(episodes, {"lines of JSON with an id": broken, "well-formed events": wrong}).orderBy("sequence")


def read_cohorts(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: review cohorts; each has a version, an id and a purpose of its own, and no episode is in two."""
    cohorts = spark.read.schema(COHORT).json(path)
    members = cohorts.select("cohort_id", F.explode("episode_ids").alias("episode_id"))
    wrong = ~F.col("schema_version").eqNullSafe(F.lit("agent_review_cohort_v1")) | F.col("cohort_id").isNull() | ~F.coalesce(F.col("purpose").isin("diagnostic-development", "held-out-evaluation"), F.lit(False))
    bound = (F.col("nonpass_or_unavailable_count") + F.col("stratified_pass_count") != F.size("episode_ids")) | (F.col("quality_policy_id").isNull() != F.col("quality_policy_fingerprint").isNull())
    rules = {"a version, an id and a purpose": cohorts.where(wrong).select("cohort_id"), "ids are unique": repeats(cohorts, "cohort_id"), "an episode is in one cohort": repeats(members, "episode_id"), "counts bind the members": cohorts.where(bound).select("cohort_id")}
    return checked(cohorts, rules)


def read_responses(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-10: scripted responses (position, content) in the order of dispatch, which is that of the lines, file after file by name."""
    rows = numbered_lines(spark, *paths)
    return checked(rows, {"lines are JSON objects": rows.where(~F.coalesce(Payload(F.col("content")).object, F.lit(False)))})


def read_configuration(spark: SparkSession, path: str) -> DataFrame:
    """SRC-16, PRD-17, HP-1: one row of a run's configuration with its defaults; one that breaks a bound is refused."""
    given = spark.read.schema(CONFIGURATION).json(path, multiLine=True)
    filled = given.select(*[F.coalesce(c, F.lit(BOUNDS[c][2])).cast("int").alias(c) if c in BOUNDS else F.coalesce(c, F.lit(30.0)).alias(c) if c == "timeout_seconds" else F.coalesce(c, F.lit("deterministic")).alias(c) if c == "admission_mode" else F.col(c) for c in given.columns])
    outside = reduce(lambda a, b: a | b, [F.coalesce(~F.col(c).between(low, high), F.lit(c == "slot_limit")) for c, (low, high, _) in BOUNDS.items()])
    ids = reduce(lambda a, b: a | b, [~F.coalesce(F.col(c).rlike(r"^[a-z0-9][a-z0-9_-]{0,127}\z") & safe_identifier(F.col(c)), F.lit(False)) for c in ("run_id", "domain_id", "model_id")])
    wrong = outside | ids | (F.col("accepted_target") > F.col("slot_limit")) | (F.col("timeout_seconds") <= 0) | (F.col("timeout_seconds") > 300) | ~F.col("admission_mode").isin("deterministic", "enforced")
    return checked(filled, {"identifiers and bounds": filled.where(F.coalesce(wrong, F.lit(False))), "one configuration": none_of(filled)})


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """SRC-17: one of a run's TABLES, by its key."""
    return spark.read.parquet(f"{folder}/{name}").orderBy(TABLES[name])


def looked_up(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """SRC-18, HP-26: the rows of ``keys`` in ``table``, any number of lookups in one join; a key that isn't there fails the query when it is read."""
    found = keys.select(key).join(table.withColumn("__found", F.lit(True)), key, "left")
    there = F.when(F.col("__found"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no such row: "), F.col(key).cast("string"))).cast(keys.schema[key].dataType))
    return found.select(there.alias(key), *[c for c in table.columns if c != key])


def with_status(work_items: DataFrame, status: str, limit: int) -> DataFrame:
    """SRC-19: the first ``limit`` work items of a status by sequence."""
    return work_items.where(F.col("status") == status).orderBy("sequence").limit(limit)


def resumable(run: DataFrame, configuration: DataFrame, snapshot: DataFrame) -> DataFrame:
    """SF-11: the first reason not to resume a run (configuration, domain_version, fingerprint: as it began), null if it may be.

    ``configuration``: configuration and domain_version as they are now;
    ``snapshot``: contents and fingerprint of the frozen state.
    """
    now = configuration.select(F.col("configuration").alias("c"), F.col("domain_version").alias("v")).crossJoin(snapshot.select("contents", F.col("fingerprint").alias("f")))
    at = run.crossJoin(F.broadcast(now))
    bound = F.concat(F.lit("sha256:"), F.sha2("contents", 256)) == F.col("f")
    reason = F.when(F.col("configuration") != F.col("c"), "configuration_changed").when(F.col("domain_version") != F.col("v"), "domain_version_changed").when(~bound | (F.col("f") != F.col("fingerprint")), "frozen_state_changed")
    return at.select(*run.columns, reason.alias("reason"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """SRC-17, JN-12, JN-13: provider requests with all sequences they count for."""
    rows = spark.read.schema(REQUEST).json(path)
    own = F.when(F.col("sequence").isNotNull(), F.array("sequence")).otherwise(F.array().cast("array<int>"))
    return rows.withColumn("sequences", F.array_union(own, F.coalesce("related_sequences", F.array().cast("array<int>"))))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14: human labels, one for a cohort and an episode."""
    labels = spark.read.schema(LABEL).json(path)
    return checked(labels, {"one label for a cohort's episode": repeats(labels, "cohort_id", "episode_id")})


def read_snapshot(spark: SparkSession, path: str, digest: str) -> DataFrame:
    """SRC-15: the digest of a frozen state file of any size (streamed), which must be the given one (``sha256:``)."""
    found = digests(listed(spark, path)).select(F.concat(F.lit("sha256:"), "sha256").alias("digest"), "path", "byte_count")
    return checked(found, {"the snapshot is the frozen one": found.where(F.col("digest") != digest).select("digest")})
