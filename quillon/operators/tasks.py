"""Task spaces of the three domains: slots, selectors, keys and compilation (DM-1 to DM-10, JN-17 to JN-23, PRD-24, PRD-25, SRC-4 to SRC-6, ST-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.canon import casefold
from ..functions.phrases import holding, phrases
from ..sources.records import workspace_query

# Fixed value: the most slots that a run has.
SLOT_LIMIT = 10_000
# Kinds of task by domain, in their order, and whether each changes state.
CONTACT_SPECS = (("lookup-direct", False), ("lookup-directory", False), ("lookup-recovery", False), ("followup-open", True), ("followup-exact", True), ("followup-directory", True), ("followup-recovery", True), ("followup-verified", True))


def contact_slots(contacts: DataFrame, followups: DataFrame) -> DataFrame:
    """JN-17, PRD-24, DM-1, DM-2: every contact's applicable tasks; contacts with a followup keep the lookups.

    The specs are a constant of eight rows, so each contact is exploded in
    place; the slot id takes a hash where a slug (the case-folded name with
    dashes for spaces) isn't unique.
    """
    specs = F.array(*[F.struct(F.lit(k).cast("int").alias("position"), F.lit(kind).alias("kind"), F.lit(changes).alias("changes")) for k, (kind, changes) in enumerate(CONTACT_SPECS)])
    slug = F.replace(casefold(F.col("name")), F.lit(" "), F.lit("-"))
    slugged = contacts.withColumn("slug", slug)
    shared = slugged.groupBy("slug").agg(F.count(F.lit(1)).alias("same"))
    has = followups.select("name").distinct().withColumn("has_followup", F.lit(True))
    at = slugged.join(shared, "slug").join(has, "name", "left").withColumn("spec", F.explode(specs)).where(F.col("has_followup").isNull() | ~F.col("spec.changes"))
    tail = F.when(F.col("same") > 1, F.concat(F.lit("-"), F.substring(F.sha2("name", 256), 1, 12))).otherwise("")
    return at.select("name", F.col("spec.position").alias("position"), F.col("spec.kind").alias("kind"), F.concat(F.lit("contacts-"), F.col("spec.kind"), F.lit("-"), F.col("slug"), tail).alias("slot_id"))


def capacity(slots: DataFrame, limit: int) -> DataFrame:
    """AG-17: known capacity, what a limit emits, and whether it exhausts the space."""
    n = slots.agg(F.count(F.lit(1)).alias("capacity"))
    return n.select("capacity", F.least("capacity", F.lit(limit).cast("long")).alias("emitted"), (F.lit(limit) >= F.col("capacity")).alias("exhausted"))


def unique_queries(items: DataFrame) -> DataFrame:
    """PRD-25: items whose kind and query (DM-10) no other item has; the count is an aggregate, joined back."""
    asked = items.withColumn("query", workspace_query(F.col("kind"), F.col("summary")))
    once = asked.groupBy("kind", "query").agg(F.count(F.lit(1)).alias("same")).where("same = 1").select("kind", "query")
    return asked.join(once, ["kind", "query"], "left_semi")


PHRASE = ["length", "head", "tail"]


def containment_pairs(messages: DataFrame, queries: DataFrame) -> DataFrame:
    """JN-21: query_id and message_id of every query (message_id, query; not empty) and body that holds it, whatever their case; one row for each, and no others are compared."""
    asked = phrases(queries, "message_id", "query")
    return holding(messages, "message_id", "body", asked).join(asked, PHRASE).select("query_id", "message_id")


def counted(messages: DataFrame, asked: DataFrame) -> DataFrame:
    """For each of ``asked`` (as of phrases()), how many bodies hold it; equal phrases are counted once."""
    counts = holding(messages, "message_id", "body", asked).groupBy(*PHRASE).agg(F.count(F.lit(1)).alias("bodies"))
    return asked.join(counts, PHRASE).select("query_id", "bodies")


def containment_counts(messages: DataFrame, queries: DataFrame) -> DataFrame:
    """JN-21, PRD-25: for each query, how many bodies hold it."""
    return counted(messages, phrases(queries, "message_id", "query"))


def interleaved(items: DataFrame, kinds: list[str], limit: int = SLOT_LIMIT) -> DataFrame:
    """JN-19: the first ``limit`` targets of each kind by id, dealt round-robin over the kinds; a run has no more slots, so no task sorts more."""
    order = F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))])
    by = Window.partitionBy("kind").orderBy("item_id")
    # The filter is on the row number itself, so each task sorts and keeps no more than ``limit`` rows of a kind.
    first = items.where(F.col("kind").isin(*kinds)).withColumn("__n", F.row_number().over(by)).where(F.col("__n") <= limit)
    return first.withColumn("target_index", F.col("__n") - 1).drop("__n").withColumn("spec_position", order[F.col("kind")])


def slots_by_id(asked: DataFrame, slots: DataFrame) -> DataFrame:
    """JN-23: ``asked`` (slot_id and what else) with the slot that each id names; ``known`` tells whether there is one.  Any number of ids is one join, whatever a slot's id says."""
    return asked.join(slots.withColumn("known", F.lit(True)), "slot_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def foreign_key_violations(items: DataFrame, kind: str, parent: str) -> DataFrame:
    """SRC-6, JN-14: items of ``kind`` whose parent isn't there."""
    parents = items.where(F.col("kind") == parent).select(F.col("item_id").alias("project_id"))
    return items.where(F.col("kind") == kind).join(parents, "project_id", "left_anti").select("kind", "item_id", "project_id")


# The message tasks (kind, action, constraint), and the workspace tasks (kind, action, route, target kind, whether any item may stand in, target index).
MESSAGE_SPECS = (
    ("search-direct", "search", None), ("search-directory", "search", None), ("search-recovery", "search", None), ("reminder-direct", "reminder", None), ("reminder-directory", "reminder", None), ("reminder-recovery", "reminder", None),
    ("reminder-verified", "reminder", None), ("draft-direct", "draft", "open"), ("draft-directory", "draft", "open"), ("draft-recovery", "draft", "open"), ("draft-exact", "draft", "exact"), ("draft-verified", "draft", "open"),
)
WORKSPACE_SPECS = (
    ("search-direct", "direct", "document", True, 0), ("search-directory", "directory", "project", False, 0), ("search-recovery", "recovery", "task", True, 0), ("search-missing", "missing", None, False, 0), ("task-direct", "direct", "project", False, 0),
    ("task-verified", "verify", "project", False, 1), ("comment-direct", "direct", "task", False, 0), ("comment-recovery", "recovery", "task", False, 2), ("comment-verified", "verify", "task", False, 1),
)


# The phrases that stand for a message that holds them, in order.
QUERY_NAMES = ("launch checklist", "invoice")


def message_query(body):
    """DM-10: the phrase that stands for a message."""
    low, out = casefold(body), body
    for name in reversed(QUERY_NAMES):
        out = F.when(low.contains(name), name).otherwise(out)
    return out


def message_query_counts(messages: DataFrame) -> DataFrame:
    """PRD-25, DM-10: for every message (message_id, body; null bodies have no query), how many bodies hold its whole query.

    Equal queries are counted once; every body holds an empty one.
    """
    # message_query() of the body, made where it is folded.
    asked = phrases(messages, "message_id", "body", QUERY_NAMES)
    all_bodies = messages.where("body is not null").agg(F.count(F.lit(1)).alias("bodies"))
    return counted(messages, asked).unionByName(asked.where("length = 0").select("query_id").crossJoin(all_bodies))


def message_slots(messages: DataFrame, reminders: DataFrame, drafts: DataFrame) -> DataFrame:
    """PRD-24, PRD-25, DM-1, DM-2 for messages: the tasks of messages whose query one body alone holds, without those that would overwrite state."""
    from ..functions.text import reply_allowed

    asked = messages.withColumn("query", message_query(F.col("body")))
    counts = containment_counts(messages, asked.select("message_id", "query"))
    once = counts.where("bodies = 1").select(F.col("query_id").alias("message_id"))
    specs = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(kind).alias("kind"), F.lit(action).alias("action"), F.lit(rule).cast("string").alias("rule")) for k, (kind, action, rule) in enumerate(MESSAGE_SPECS)])
    at = asked.join(once, "message_id", "left_semi").join(reminders.select("message_id", F.lit(True).alias("reminded")), "message_id", "left").join(drafts.select("message_id", F.lit(True).alias("drafted")), "message_id", "left")
    at = at.withColumn("spec", F.explode(specs))
    exact = F.concat(F.lit("Thanks, I will review the "), "query", F.lit("."))
    keep = ~((F.col("spec.action") == "reminder") & F.col("reminded").isNotNull()) & ~((F.col("spec.action") == "draft") & F.col("drafted").isNotNull()) & ~(F.coalesce(F.col("spec.rule") == "exact", F.lit(False)) & ~reply_allowed(exact))
    slot = F.concat(F.lit("mobile-"), F.col("spec.kind"), F.lit("-message-"), F.substring(F.sha2("message_id", 256), 1, 24))
    return at.where(keep).select("message_id", F.col("spec.position").alias("position"), F.col("spec.kind").alias("kind"), slot.alias("slot_id"))


def workspace_slots(items: DataFrame, every: bool, limit: int = SLOT_LIMIT) -> DataFrame:
    """JN-18 to JN-20, DM-1 for workspace items (item_id, kind, query): the first ``limit`` slots: kind of task, its position, target and target index.

    ``every`` takes all targets, dealt round-robin over the specs; otherwise
    each spec has one.  A spec whose kind has no item at all may fall back to
    any item: documents first, then projects, tasks and comments.
    """
    once = items.groupBy("kind", "query").agg(F.count(F.lit(1)).alias("same")).where("same = 1").select("kind", "query")
    unique = items.join(once, ["kind", "query"], "left_semi")
    kinds = {r["kind"] for r in items.select("kind").distinct().collect()}
    preference = F.array_position(F.array(*[F.lit(k) for k in ("document", "project", "task", "comment")]), F.col("kind"))
    out = items.sparkSession.createDataFrame([("search-missing", 3, None, 0)], "spec string, position int, item_id string, target_index int")
    for position, (spec, route, kind, fallback, index) in enumerate(WORKSPACE_SPECS):
        if route == "missing" or (kind not in kinds and not fallback):
            continue
        held = unique.where(F.col("kind") == kind) if kind in kinds else unique
        order = [F.col("item_id")] if kind in kinds else [preference, F.col("item_id")]
        # The first ``limit`` targets, or up to the spec's own, are a top-k; only they are numbered in one task.
        top = held.orderBy(*order).limit(limit if every else index + 1)
        numbered = top.withColumn("target_index", F.row_number().over(Window.orderBy(*order)) - 1)
        if not every:
            numbered = numbered.orderBy(F.desc("target_index")).limit(1).withColumn("target_index", F.lit(0))
        out = out.unionByName(numbered.select(F.lit(spec).alias("spec"), F.lit(position).alias("position"), "item_id", "target_index"))
    return out.orderBy("target_index", "position").limit(limit)
