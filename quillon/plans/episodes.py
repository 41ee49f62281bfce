"""Registered queries of the three domains: cases, compilation, assessment, rollouts and runs, over the views of whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..functions.payload import once
from ..operators import activation, admission, assessment, campaign, cases, compilation, decisions, evidence, exchange, reports, review, rollout, sequence, tasks, usage
from ..session import shared_dir
from ..sources import records, states
from .queries import TARGET, admitted, cohort_members, gated, query
from .views import view

EVENT = "event_type", "tool_name", "arguments", "observation", "change", "content", "error_code"


def with_events(cases_: DataFrame, events: DataFrame, *keys: str) -> DataFrame:
    """``cases_`` with their events in order, payloads parsed."""
    maps = lambda e, c: F.from_json(e[c], "map<string,string>").alias(c) if c in ("arguments", "observation", "change") else e[c].alias(c)
    held = events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", *EVENT))).alias("events"))
    return cases_.join(held.withColumn("events", F.transform("events", lambda e: F.struct(*[maps(e, c) for c in EVENT]))), list(keys), "left")


def held(s, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, for what reads it several times."""
    path = f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return s.read.schema(df.schema).parquet(path)


def told(assessed: DataFrame, *keys: str) -> DataFrame:
    a = F.col("assessment")
    return assessed.select(*keys, a["passed"].alias("passed"), F.array_join(a["reason_codes"], ",").alias("reasons"), a["structural_key"].alias("structural_key"), F.array_join(a["coverage_tags"], ",").alias("tags"), a["state_change_evidence"].alias("evidence"))


@query
def contact_assessment(s, d):
    return told(assessment.assess_contacts(with_events(view(s, d, "contact_cases_v"), view(s, d, "contact_events_v"), "contact_key", "position")), "contact_key", "position")


@query
def message_assessment(s, d):
    return told(assessment.assess_messages(with_events(view(s, d, "message_cases_v"), view(s, d, "message_events_v"), "message_id", "position")), "message_id", "position")


@query
def workspace_assessment(s, d):
    return told(assessment.assess_workspace(with_events(view(s, d, "workspace_texts_v"), view(s, d, "workspace_events_v"), "item_id", "position")), "item_id", "position")


def call(tool: str, **given: Column | str) -> Column:
    """An agent's decision to call ``tool``, as JSON text."""
    arguments = cases.spaced({n: F.lit(v) if isinstance(v, str) else v for n, v in given.items()})
    return F.concat(F.lit(f'{{"type":"tool_call","tool_name":"{tool}","arguments":'), arguments, F.lit("}"))


def final(text: Column | str) -> Column:
    return F.concat(F.lit('{"type":"final_response","content":'), cases.json_string(F.lit(text) if isinstance(text, str) else text), F.lit("}"))


def responded(at: DataFrame, domain: str, keys: list[str], *steps: tuple[Column, Column]) -> DataFrame:
    """``at`` with ``responses``: those of ``steps`` (whether, JSON text) that an agent gave, read as decisions, null where it gave none; an empty text is a request that timed out.

    A text is read once for all rows of the same ``keys``, which are few: the
    episodes of one target say the same again and again.
    """
    given = F.array_compact(F.array(*[F.when(taken, F.coalesce(content, F.lit(""))) for taken, content in steps]))
    # Dealt once, by what responses are gathered by later; by number, since few bytes of cases become many of responses.
    at = at.repartition(int(at.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    texts = at.select(*keys, F.explode(F.array_distinct(given)).alias("content")).where("content <> ''").distinct()
    names = "kind", "tool_name", "arguments", "call_error", "shown", "final_content", "unsafe"
    read = rollout.read_decisions(texts, cases.input_schemas(domain)).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("content", F.struct(*names)))).alias("__read"))

    def response(content: Column, idx: Column) -> Column:
        d = F.try_element_at("__read", content)
        told = {n: d[n] for n in names} | {"kind": F.coalesce(d["kind"], F.lit("failed")), "unsafe": F.coalesce(d["unsafe"], F.lit(False))}
        return F.struct(idx.alias("idx"), *[c.alias(n) for n, c in told.items()], F.when(content == "", "provider_timeout").alias("error_code"), F.lit(None).cast("map<string,string>").alias("found"))

    out = at.withColumn("__given", given).join(read, keys, "left")
    return out.withColumn("responses", F.when(F.size("__given") > 0, F.transform("__given", response))).drop("__given", "__read")


def malformed(v: Column) -> list[tuple[Column, Column]]:
    """One malformed decision, which is repaired, or two, which end the episode."""
    return [(v.isin(9, 10), F.lit("not json")), (v == 10, F.lit('{"type":"dance"}'))]


def endings(v: Column, again: Column) -> list[tuple[Column, Column]]:
    """A request that fails, a final response, or calls until the steps are used up."""
    return [(v == 7, F.lit("")), (v != 11, final("Done")), *[(v == 11, again)] * 8]


STEP_LIMIT = 8
#: Conversations that a task sorts.
SORTED = 50_000


def outcomes(episodes: DataFrame, *keys: str) -> DataFrame:
    codes = F.transform(F.filter("events", lambda e: e["event_type"] != "action"), lambda e: F.coalesce(e["error_code"], e["event_type"]))
    return episodes.select(*keys, F.array_join(codes, ",").alias("results"), F.size(F.filter("events", lambda e: e["event_type"] == "action")).cast("long").alias("actions"), "terminal_reason", "mutation_authorization", "unsafe")


def contact_episodes(s, d, *variants: int) -> DataFrame:
    """Contact cases, each with an agent's responses in twelve ways, or of the ``variants`` alone, and the events that they come to."""
    c, v, yes = F.col, F.col("v"), F.lit(True)
    note = F.when(v == 5, " bad").when(v == 6, "Another note").otherwise("Please follow up by email.")
    far, writes = c("route").isin("directory", "recovery"), c("action") == "record_followup"
    look, write = call("lookup_contact", name=c("target")), call("record_followup", name=c("target"), note=note)
    steps = [
        *malformed(v), (v == 0, F.lit('{"type":"tool_call","tool_name":"lookup_contact","arguments":{"name":5}}')), ((c("route") == "recovery") & (v != 1), call("lookup_contact", name=cases.stale(c("target")))), (far & (v != 2), call("list_contacts")), (v != 3, look),
        (writes | (v == 4), write), (v == 4, write), (yes, call("get_followup", name=c("target"))), (v == 8, call("dance", x="/etc/passwd")), *endings(v, look),
    ]
    cases_ = view(s, d, "contact_cases_v").drop("mutation_authorization")
    at = responded(cases_.where(v.isin(*variants)) if variants else cases_, "contacts", ["contact_key"], *steps)
    at = once(at, contacts=F.create_map("target", "expected_email"))
    state = rollout.looped(c("responses"), cases.contact_tools(), F.lit(None).cast("map<string,string>"), rollout.contact_step(c("contacts")), STEP_LIMIT)
    return rollout.ended(at, state, STEP_LIMIT)


@query
def contact_rollout(s, d):
    return outcomes(contact_episodes(s, d), "contact_key", "position")


@query
def message_rollout(s, d):
    c, v, yes = F.col, F.col("v"), F.lit(True)
    far = c("route").isin("directory", "recovery")
    text, reply = F.when(v == 5, "other").otherwise(c("reminder_text")), F.when(v == 5, "No.").when(v == 6, "Thanks for it").otherwise(F.concat(F.lit("Thanks, I will review the "), c("query"), F.lit(".")))
    remind, draft = c("action") == "create_reminder", c("action") == "create_draft_reply"
    look, other = call("search_messages", query=c("query")), call("create_reminder", message_id="none", reminder_text=text, remind_at=c("remind_at"))
    steps = [
        *malformed(v), (v == 0, F.lit('{"type":"tool_call","tool_name":"search_messages","arguments":{"query":["a"]}}')), ((c("route") == "recovery") & (v != 1), call("search_messages", query=cases.stale(c("query")))), (far & (v != 2), call("list_message_senders")), (v != 3, look),
        (remind, call("create_reminder", message_id=c("message_id"), reminder_text=text, remind_at=c("remind_at"))), (draft, call("create_draft_reply", message_id=c("message_id"), content=reply)), ((v == 4) & remind, other),
        (yes, call("get_reminder", message_id=c("message_id"))), (draft, call("get_draft_reply", message_id=c("message_id"))), (v == 8, call("dance", x="/etc/passwd")), *endings(v, look),
    ]
    # Which message a query finds is a join over all messages, before the fold.
    notes = view(s, d, "notes_v").select("message_id", "sender", "body")
    hits = rollout.searched(notes.select(F.col("message_id").alias("query_id"), F.col("body").alias("query")), notes).select(F.col("query_id").alias("message_id"), F.col("found").alias("hit"))
    at = responded(view(s, d, "message_cases_v").drop("mutation_authorization").join(hits, "message_id", "left"), "mobile_messages", ["message_id"], *steps)
    at = at.withColumn("responses", F.transform("responses", lambda r: r.withField("found", F.when((r["tool_name"] == "search_messages") & (r["arguments"]["query"] == c("query")), F.when(c("hit").isNotNull(), assessment.message_record())))))
    none = F.lit(None).cast("map<string,string>")
    state = rollout.looped(c("responses"), cases.message_tools(), none, rollout.message_step(F.lit('["all"]'), none, none), STEP_LIMIT)
    return outcomes(rollout.ended(at, state, STEP_LIMIT), "message_id", "position")


@query
def workspace_rollout(s, d):
    c, v = F.col, F.col("v")
    adds, comments = c("action") == "create_workspace_task", c("action") == "add_workspace_comment"
    title, text = F.when(v == 5, "Short").otherwise(F.concat(F.lit("Prepare "), c("summary"), F.lit(" retrospective"))), F.when(v == 5, "Done it").when(v == 6, "Status: something else").otherwise(F.concat(F.lit("Status: "), c("query"), F.lit(" is ready for review.")))
    add, look = call("create_workspace_task", project_id=c("item_id"), title=title, priority=F.when(v == 6, "low").otherwise("high"), due_label="next_week"), call("search_workspace_items", query=c("query"), kind=c("kind"))
    steps = [
        *malformed(v), (v == 0, call("search_workspace_items", query=c("query"))), ((c("route") == "recovery") & (v != 1), call("search_workspace_items", query=cases.stale(c("query")), kind=c("kind"))), (c("route") == "directory", call("list_workspace_projects")),
        (v != 3, look), (adds, add), (comments, call("add_workspace_comment", task_id=c("item_id"), comment=text)), (adds & (v == 4), add), (adds, call("get_workspace_task", task_id=assessment.created_id("task", c("item_id"), title))),
        (comments, call("get_workspace_comment", comment_id="none")), (v == 8, call("dance", x="/etc/passwd")), *endings(v, look),
    ]
    at = responded(view(s, d, "workspace_cases_v").where("route <> 'missing'"), "workspace_tasks", ["item_id"], *steps)
    state = rollout.looped(c("responses"), cases.workspace_tools(), F.lit(None).cast("map<string,string>"), rollout.workspace_step(F.lit("[]")), STEP_LIMIT)
    return outcomes(rollout.ended(at, state, STEP_LIMIT), "item_id", "position")


@query
def rollout_replay(s, d):
    """Contact episodes run again from their saved events: as they were, with another observation, with an action whose result is lost or that has no tool, with another assessment, with a case that can't be restored, without a case."""
    v, events = F.col("v"), F.col("events")
    at = contact_episodes(s, d, 1, 2, 6, 8, 9, 10, 11)
    k = F.col("contact_key") % 6
    first = lambda change: F.transform(events, lambda e, i: F.when((e["event_type"] == "observation") & (e["tool_name"] == "lookup_contact"), change(e)).otherwise(e))
    saved = (
        F.when(k == 1, first(lambda e: e.withField("observation", F.create_map(F.lit("name"), F.lit("x"))))).when(k == 2, F.slice(events, 1, F.array_position(F.transform(events, lambda e: e["event_type"]), "action").cast("int")))
        .when(k == 3, F.transform(events, lambda e: F.when(e["event_type"] == "action", e.withField("tool_name", F.lit(None).cast("string"))).otherwise(e))).otherwise(events)
    )
    at = at.withColumns({"saved_authorization": F.col("mutation_authorization"), "saved": saved})
    state = rollout.replayed_events(F.col("saved"), cases.contact_tools(), F.lit(None).cast("map<string,string>"), rollout.contact_step(F.col("contacts")), cases.input_schemas("contacts"))
    judged = F.coalesce(F.col("terminal_reason"), F.lit("none"))
    again = rollout.replayed(at, state, F.col("contact_key") % 9 != 0, F.when(F.col("contact_key") % 7 != 0, True), (judged, F.when(v == 6, "other").otherwise(judged)))
    return again.select("contact_key", "position", "status", "observation_drift", "assessment_drift")


# --- cases


@query
def contact_cases(s, d):
    made = cases.contact_cases(view(s, d, "contacts_v").select("name", "email"), view(s, d, "followups_v"))
    return made.select("slot_id", "payload", cases.contact_instruction().alias("instruction"), F.array_join(cases.contact_tools(), ",").alias("tools"), cases.contact_key().alias("semantic_key"))


@query
def contact_compile(s, d):
    """Proposals of every kind of contact task, well-formed and in twelve ways not, compiled against their slots."""
    at = view(s, d, "contact_cases_v").drop("exact_note")
    v, c = F.col("v"), F.col
    writes = c("action") == "record_followup"
    fields = {
        "action": F.when(v == 4, "dont_lookup").when(v == 5, "dance").otherwise(c("action")), "contact": F.when(v == 6, "Nobody").otherwise(c("target")), "route": F.when(v == 7, "nowhere").otherwise(c("route")),
        "condition": F.when(writes & (v != 8), "after_lookup_match"), "note_constraint": F.when(writes, c("note_constraint")), "note": F.when(c("note_constraint") == "exact", "Please follow up by email.").when(v == 9, "more"), "extra": F.when(v == 10, "x"),
    }
    content = F.when(v == 0, "do not do it").when(v == 1, "{bad}").when(v == 2, '["a"]').when(v == 3, '{"action": 1}').when(v == 11, F.concat(cases.spaced(fields), F.lit(" x"))).otherwise(cases.spaced(fields))
    made = cases.compile_contacts(at.withColumn("content", content))
    return made.select("contact_key", "position", "reason", "semantic_key", "private_case")


def compiled(at: DataFrame, compile_, fields: dict[str, Column], changes: dict[str, Column], rule: Column, *keys: str) -> DataFrame:
    """Proposals of ``fields`` with ``changes``, in twelve ways by ``v``, compiled against slots that expect ``fields``."""
    v = F.col("v")
    expected = F.map_filter(assessment.record(**fields), lambda _, x: x.isNotNull())
    content = F.when(v == 0, "do not do it").when(v == 1, F.concat(cases.spaced(fields), F.lit(" x"))).when(v == 2, '["a"]').otherwise(cases.spaced(fields | changes))
    yes = F.lit(True)
    at = at.withColumns({"expected": expected, "content": content, "known": yes, "unique": yes, "applicable": yes, "rule": rule})
    return compile_(at).select(*keys, "reason")


@query
def message_compile(s, d):
    c, v = F.col, F.col("v")
    searches, draft, exact = c("action") == "search_messages", c("action") == "create_draft_reply", c("reply_constraint") == "exact"
    fields = {
        "action": c("action"), "route": c("route"), "query": F.when(searches, c("query")), "message_query": F.when(~searches, c("query")), "condition": F.when(~searches, "after_message_match"), "reminder_text": c("reminder_text"), "remind_at": c("remind_at"),
        "reply_constraint": F.when(draft, c("reply_constraint")), "reply": c("exact_reply"),
    }
    changes = {
        "action": F.when(v == 3, "dont_do").when(v == 5, "dance").otherwise(c("action")), "message_id": F.when(v == 4, "m"), "route": F.when(v == 6, "nowhere").otherwise(c("route")), "query": F.when(searches, F.when(v == 7, "x").otherwise(c("query"))),
        "message_query": F.when(~searches, F.when(v == 7, "x").otherwise(c("query"))), "condition": F.when(~searches & (v != 8), F.when(v == 9, "x").otherwise("after_message_match")), "remind_at": F.when(v != 10, c("remind_at")),
        "reply": F.when(draft & (v == 10), "No.").otherwise(c("exact_reply")), "extra": F.when(v == 11, "x"),
    }
    return compiled(view(s, d, "message_cases_v"), compilation.compile_messages, fields, changes, F.when(exact, "exact").when(draft, "open"), "message_id", "position")


@query
def workspace_compile(s, d):
    c, v = F.col, F.col("v")
    searches, task, comment = c("action") == "search_workspace_items", c("action") == "create_workspace_task", c("action") == "add_workspace_comment"
    at = view(s, d, "workspace_cases_v").where("route <> 'missing'").withColumns({"case_kind": F.col("kind")})
    fields = {
        "action": c("action"), "route": c("route"), "kind": F.when(searches, c("kind")), "query": F.when(searches, c("query")), "condition": F.when(~searches, "after_item_match"), "due_label": c("due_label"), "priority": c("priority"), "project_kind": F.when(task, c("kind")),
        "project_query": F.when(task, c("query")), "title": c("title"), "task_constraint": F.when(task & c("title").isNull(), c("task_constraint")), "comment_constraint": F.when(comment, c("comment_constraint")), "task_kind": F.when(comment, c("kind")),
        "task_query": F.when(comment, c("query")), "comment": c("exact_comment"),
    }
    changes = {
        "action": F.when(v == 3, "dont_do").when(v == 5, "dance").otherwise(c("action")), "task_id": F.when(v == 4, "t"), "route": F.when(v == 6, "nowhere").otherwise(c("route")), "query": F.when(searches, F.when(v == 7, "x").otherwise(c("query"))),
        "project_query": F.when(task, F.when(v == 7, "x").otherwise(c("query"))), "task_query": F.when(comment, F.when(v == 7, "x").otherwise(c("query"))), "condition": F.when(~searches & (v != 8), F.when(v == 9, "x").otherwise("after_item_match")),
        "priority": F.when(v != 10, c("priority")), "comment": F.when(comment & (v == 10), "Status: other").otherwise(c("exact_comment")), "extra": F.when(v == 11, "x"),
    }
    rule = F.when((c("task_constraint") == "exact") | (c("comment_constraint") == "exact"), "exact").when(~searches, "open")
    return compiled(at, compilation.compile_workspace, fields, changes, rule, "item_id", "position")


@query
def restored_cases(s, d):
    at = view(s, d, "contact_cases_v").withColumn("semantic_key", cases.contact_key()).withColumn("private_case", cases.contact_record())
    changed = F.when(F.col("v") == 1, F.replace("private_case", F.lit('"route":"'), F.lit('"route":"x'))).when(F.col("v") == 2, F.lit("[]")).when(F.col("v") == 3, F.replace("private_case", F.lit("@"), F.lit("#"))).otherwise(F.col("private_case"))
    return cases.restored_contacts(at.select("contact_key", "position", "v", "semantic_key", changed.alias("private_case"))).groupBy("v").agg(F.count_if("valid").alias("valid"), F.count(F.lit(1)).alias("n"))


def tampered(v: Column, record: Column, key: Column) -> dict[str, Column]:
    """A private record with its key: as made, with another route, no object, a number for a text, another key, or with nothing in it."""
    route = F.replace(record, F.lit('"route":"'), F.lit('"route":"x'))
    return {"private_case": F.when(v == 1, route).when(v == 2, "[]").when(v == 3, F.regexp_replace(record, '"action":"[a-z_]*"', '"action":5')).when(v == 5, "{}").otherwise(record), "semantic_key": F.when(v == 4, F.concat(key, F.lit("x"))).otherwise(key)}


@query
def restored_messages(s, d):
    made = view(s, d, "message_cases_v").withColumn("private", cases.message_private())
    at = made.select("message_id", "position", "v", *[c.alias(n) for n, c in tampered(F.col("v"), F.col("private"), cases.semantic_key("mobile_messages", F.col("private"))).items()])
    return cases.restored_messages(at.withColumnRenamed("message_id", "asked")).groupBy("v").agg(F.count_if("valid").alias("valid"), F.count(F.lit(1)).alias("n"))


@query
def restored_workspace(s, d):
    items = view(s, d, "items_v").withColumn("query", records.workspace_query(F.col("kind"), F.col("summary")))
    made = cases.workspace_cases(tasks.workspace_slots(items, True), items).withColumn("v", F.col("target_index") % 6)
    at = made.select("slot_id", "v", *[c.alias(n) for n, c in tampered(F.col("v"), F.col("private_case"), F.col("semantic_key")).items()])
    return cases.restored_workspace(at).groupBy("v").agg(F.count_if("valid").alias("valid"), F.count(F.lit(1)).alias("n"))


@query
def slot_lookup(s, d):
    """The slots that ids name: those of every contact's tasks, and ids that no slot has."""
    slots = tasks.contact_slots(view(s, d, "contacts_v").select("name"), view(s, d, "followups_v"))
    asked = slots.select(F.when(F.sha2("slot_id", 256) < "4", F.concat("slot_id", F.lit("-x"))).otherwise(F.col("slot_id")).alias("slot_id"))
    return tasks.slots_by_id(asked, slots).select("slot_id", "name", "position", "known")


def frozen(s, domain: str, relations: dict[str, DataFrame]) -> DataFrame:
    return states.freeze(s, domain, relations, f"{shared_dir(s)}/state-{uuid.uuid4().hex}")


@query
def contact_snapshot(s, d):
    return frozen(s, "contacts", {"contacts": view(s, d, "contacts_v").select("name", "email"), "followups": view(s, d, "followups_v").withColumn("note", F.lit("a note"))})


@query
def message_snapshot(s, d):
    notes = view(s, d, "notes_v")
    return frozen(s, "mobile_messages", {"messages": notes, "drafts": notes.where("s_suppkey % 5 = 0").select("message_id", F.lit("Thanks, noted.").alias("content"))})


@query
def workspace_snapshot(s, d):
    items = view(s, d, "items_v")
    return frozen(s, "workspace_tasks", {"items": items.withColumn("query", records.workspace_query(F.col("kind"), F.col("summary")))})


@query
def pilot_rehearsal(s, d):
    slots = tasks.contact_slots(view(s, d, "contacts_v").select("name"), view(s, d, "followups_v")).withColumnRenamed("name", "target")
    got = cases.pilot_rehearsal(slots, F.lit("sha256:x"), 8, 16)
    return got.select("known_task_capacity", "capacity_status", F.array_join("semantic_groups", ",").alias("semantic_groups"), F.array_join("grounding_groups", ",").alias("grounding_groups"))


@query
def message_slots(s, d):
    notes = view(s, d, "notes_v")
    reminders, drafts = notes.where("s_suppkey % 5 = 0").select("message_id"), notes.where("s_suppkey % 7 = 0").select("message_id")
    return tasks.message_slots(notes.select("message_id", "sender", "body"), reminders, drafts)


@query
def message_cases(s, d):
    notes = view(s, d, "notes_v").select("message_id", "sender", "body")
    slots = tasks.message_slots(notes, notes.limit(0).select("message_id"), notes.limit(0).select("message_id"))
    return cases.message_cases(slots, notes).select("slot_id", "payload", "instruction", F.array_join("tools", ",").alias("tools"), "semantic_key")


@query
def workspace_slots(s, d):
    items = view(s, d, "items_v")
    return tasks.workspace_slots(items.withColumn("query", records.workspace_query(F.col("kind"), F.col("summary"))), False)


@query
def workspace_cases(s, d):
    items = view(s, d, "items_v").withColumn("query", records.workspace_query(F.col("kind"), F.col("summary")))
    return cases.workspace_cases(tasks.workspace_slots(items, False), items).select("spec", "slot_id", "payload", "instruction", F.array_join("tools", ",").alias("tools"), "semantic_key")


@query
def tool_definitions(s, d):
    """The public tools of every contact task, with their schemas."""
    return view(s, d, "contact_cases_v").select("contact_key", "position", cases.public_tools(cases.contact_tools()).alias("tools"))


# --- JSON of any depth


def nested(s, d) -> DataFrame:
    return view(s, d, "payloads_v")


@query
def canonical_payloads(s, d):
    """Every order's payload with a key that repeats, in canonical form."""
    return nested(s, d).select("k", jsontext.canonical_json(F.replace("payload", F.lit('"n": 2.50'), F.lit('"n": {"x": 1}, "n": 2.50'))).alias("canonical"))


@query
def nested_redaction(s, d):
    """What every order's payload may show: each value with its path."""
    leaves = nested(s, d).select("k", F.explode(jsontext.json_leaves(jsontext.sanitized_json("payload"))).alias("leaf"))
    return leaves.select("k", "leaf.path", "leaf.value")


@query
def unsafe_payloads(s, d):
    return nested(s, d).select("k", jsontext.unsafe_json("payload").alias("unsafe"), jsontext.unsafe_json(F.to_json(F.struct(F.col("k").alias("name")))).alias("plain"))


@query
def public_events(s, d):
    """The events of every contact episode with the fields that its tools declare, value by value."""
    fields = [c for c in EVENT if c not in ("arguments", "observation", "change")]
    event = F.concat(F.lit("{"), F.concat_ws(",", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{c}":'), cases.json_string(F.col(c)))) for c in fields], *[F.concat(F.lit(f'"{c}":'), F.col(c)) for c in ("arguments", "observation", "change")]), F.lit("}"))
    keys = ["contact_key", "position"]
    # By number: few bytes of events become many leaves.
    events = view(s, d, "contact_events_v").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), *keys)
    held = events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", event.alias("event")))).alias("events"))
    shown = held.select(*keys, F.concat(F.lit("["), F.array_join(F.transform("events", lambda e: e["event"]), ","), F.lit("]")).alias("events"))
    # What a case shows is a few names: definitions would be shuffled and sent to Python with every episode.
    tools = view(s, d, "contact_cases_v").select(*keys, "action", "route")
    at = shown.join(tools, keys).withColumn("tools", cases.contact_tools())
    return jsontext.public_leaves(at, "events", "tools", cases.tool_schemas(), *keys)


# --- requests and records as JSON


@query
def agent_contexts(s, d):
    """What an agent is shown of every contact task before its first step, and in the middle of it."""
    keys = ["contact_key", "position"]
    event = lambda e: F.struct(*[(F.from_json(e[c], "map<string,string>") if c in ("observation", "change") else e[c]).alias(c) for c in EVENT])
    events = view(s, d, "contact_events_v").where("tool_name = 'lookup_contact' or event_type = 'final_response'")
    held = events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", *EVENT))).alias("events"))
    at = view(s, d, "contact_cases_v").join(held, keys).withColumn("history", F.transform("events", event))
    shown = lambda history, left: exchange.agent_context(cases.contact_instruction(), cases.public_tools(cases.contact_tools()), history, F.lit(left))
    return at.select(*keys, shown(F.slice("history", 1, 0), 12).alias("first"), F.sha2(shown(F.col("history"), 10), 256).alias("later"))


@query
def admission_records(s, d):
    enforced = F.col("sequence") % 3 == 0
    rows = admitted(s, d).select("sequence", exchange.admission_record(F.when(enforced, "enforced").otherwise("deterministic"), F.col("admitted"), F.col("gates"), F.when(F.col("admitted"), "pass").otherwise("fail"), F.lit("policy-1")).alias("record"))
    return rows


@query
def stored_cases(s, d):
    """Private contact cases as the ledger keeps them, and read back; every seventh is damaged."""
    made = view(s, d, "contact_cases_v").select("contact_key", "position", cases.contact_record().alias("private_case")).withColumn("stored", exchange.stored(F.col("private_case")))
    read = exchange.unstored(F.when(F.col("contact_key") % 7 == 0, F.concat("stored", F.lit("*"))).otherwise(F.col("stored")))
    return made.select("contact_key", "position", "stored", read.eqNullSafe(F.col("private_case")).alias("same"))


# --- model output


def call_texts(s, d) -> DataFrame:
    v = F.col("v")
    call = lambda arguments: F.concat(F.lit('{"type":"tool_call","tool_name":"'), F.when(v == 9, "dance").otherwise("lookup_contact"), F.lit('","arguments":'), arguments, F.lit("}"))
    content = (
        F.when(v == 0, "not json").when(v == 1, '{"type":"tool_call"}').when(v == 2, '{"type":"final_response","content":"done"}').when(v == 3, '{"type":"final_response","content":"done","why":"x"}').when(v == 4, call(F.lit('{"name":1}')))
        .when(v == 5, call(F.lit("{}"))).when(v == 6, call(F.lit('{"name":"a","more":true}'))).when(v == 7, call(F.lit("[]"))).otherwise(call(F.concat(F.lit('{"name":"'), F.col("target"), F.lit('"}'))))
    )
    return view(s, d, "contact_cases_v").select("contact_key", "position", "v", content.alias("content"))


@query
def agent_decisions(s, d):
    return decisions.agent_decisions(call_texts(s, d)).select("contact_key", "position", "decision", "tool_name", "final_content")


@query
def checked_calls(s, d):
    calls = decisions.agent_decisions(call_texts(s, d)).where("decision = 'tool_call'").select("contact_key", "position", "tool_name", "arguments")
    return decisions.checked_calls(calls, cases.input_schemas("contacts")).select("contact_key", "position", "error_code")


@query
def mapped_proposals(s, d):
    slots = view(s, d, "episodes_v").select(F.floor((F.col("sequence") - 1) / 8).alias("batch"), "sequence", F.concat(F.lit("slot-"), F.col("sequence").cast("string")).alias("slot_id"))
    proposal = F.concat(F.lit('{"slot_id":"'), F.when((F.col("batch") % 5 == 1) & (F.col("sequence") % 8 == 1), "slot-x").otherwise(F.col("slot_id")), F.lit('","content":"do '), F.col("sequence").cast("string"), F.lit('"}'))
    joined = slots.select("batch", "sequence", proposal.alias("p")).groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sequence", "p"))), lambda r: r["p"]), ",").alias("all"))
    content = F.when(F.col("batch") % 5 == 2, "{}").when(F.col("batch") % 5 == 3, F.concat(F.lit('{"proposals":['), "all", F.lit('],"note":"x"}'))).otherwise(F.concat(F.lit('{"proposals":['), "all", F.lit("]}")))
    return decisions.mapped_proposals(joined.select("batch", content.alias("content")), slots)


@query
def judge_availability(s, d):
    k = F.col("run_id")
    one = lambda condition, value: F.when(condition, F.lit(value))
    rows = view(s, d, "runs_v").select("run_id", (k % 2 != 0).alias("requested"), one(k % 3 != 0, "j").alias("judge"), (k % 5 != 0).alias("registered"), F.when(k % 7 == 0, "j").otherwise("g").alias("generator"), F.when(k % 11 == 0, "j").otherwise("a").alias("agent"))
    return decisions.judge_availability(rows).select("run_id", "unavailable_reason")


# --- reports, runs and campaigns


@query
def pre_execution_negatives(s, d):
    rows = view(s, d, "episodes_v").where("terminal_reason is not null").select("sequence", "domain_id", F.when(F.col("sequence") % 3 == 0, "unauthorized_mutation").otherwise("wrong_contact_binding").alias("reason_code"), F.when(F.col("sequence") % 5 == 0, "read /tmp/x").when(F.col("sequence") % 5 != 1, "do it").alias("instruction"), F.lit(None).cast("array<string>").alias("tools"))
    made = admission.pre_execution_negatives(rows, F.lit("r1"))
    return made.select("episode_id", "instruction", F.array_join("tools", ",").alias("tools"), F.col("gates.mutation_authorization").alias("authorized"), F.col("gates.unsafe_material").alias("safe"), "reason_code")


@query
def work_states(s, d):
    rows = view(s, d, "episodes_v")
    k = F.col("sequence")
    claims = rows.where(k % 7 == 0).select("sequence", F.when(k % 2 == 0, "generating").otherwise("running").alias("status"))
    return admission.work_states(rows, claims, rows.where(k % 3 == 0), rows.where(k % 4 == 0)).groupBy("status", "has_case").agg(F.count(F.lit(1)).alias("n"))


@query
def run_attempts(s, d):
    slots = view(s, d, "episodes_v").select("domain_id", "sequence")
    return admission.run_report(admitted(s, d).where("sequence % 6 <> 0"), slots)


@query
def quality_counts(s, d):
    judgments = view(s, d, "evidence_v").select(F.when(F.col("judge_verdict") == "unavailable", "unavailable").otherwise("available").alias("availability"), F.col("judge_verdict").alias("verdict"))
    roles = usage.usage_summary(view(s, d, "requests_v"), "role")
    members = cohort_members(s, d).withColumn("purpose", F.when(F.col("cohort_id") == "cohort0", "held-out-evaluation").otherwise("diagnostic-development"))
    labels = members.join(review.dimension_verdict(view(s, d, "labels_long_v")), "episode_id")
    episodes = held(s, admitted(s, d).select("collection", "reason_code", "structural_key", "coverage_tags", "gates"), "admitted")
    return reports.quality_counts(episodes, judgments, capacity=10_000, usage=roles, members=members, labels=labels)


def campaign_episodes(s, d) -> DataFrame:
    """The admitted episodes, a table: results and decisions count them in many ways."""
    at = admitted(s, d).withColumns({"episode_id": F.col("sequence"), "agent_requests": F.when(F.col("sequence") % 89 != 0, 2)})
    return held(s, at.select("domain_id", "sequence", "episode_id", "admitted", "reason_code", "structural_key", "gates_passed", "mutation_authorization", "agent_requests"), "admitted")


def campaign_results(s, d, episodes: DataFrame) -> DataFrame:
    runs = view(s, d, "episodes_v").groupBy("domain_id").agg(F.lit("completed").alias("run_status"), F.count(F.lit(1)).alias("task_attempt_count"), (F.count(F.lit(1)) / 8.0).cast("double").alias("elapsed_seconds"), (F.max("domain_id") != "contacts").alias("replay_aligned"))
    usage_ = view(s, d, "episodes_v").groupBy("domain_id").agg(F.sum("sequence").alias("known_total_tokens"), F.max(F.when(F.col("domain_id") == "contacts", 1).otherwise(0)).alias("unknown_usage_count"))
    return campaign.domain_results(episodes, usage_, runs, TARGET)


@query
def domain_results(s, d):
    return campaign_results(s, d, campaign_episodes(s, d))


def decided(s, d) -> DataFrame:
    """The decision on four domains: all labelled, one label short, all labelled, and one that didn't run."""
    domains = [(x, TARGET, 1_000_000, 3) for x in ("contacts", "mobile_messages", "other", "workspace_tasks")]
    plan = s.createDataFrame(domains, "domain_id string, target int, slot_limit int, family_floor int")
    episodes = campaign_episodes(s, d)
    first = admission.first_admitted(episodes, TARGET)
    expected = first.select("domain_id", F.col("ordinal").alias("position"), "episode_id")
    cohorts = expected.withColumns({"cohort_id": F.concat(F.lit("c-"), "domain_id"), "membership_hash": F.concat(F.lit("h-"), "domain_id")})
    labels = cohorts.where("domain_id <> 'mobile_messages' or position > 1").select("domain_id", "cohort_id", F.lit("held-out-evaluation").alias("purpose"), "episode_id", F.when(F.col("episode_id") % 13 == 0, "fail").when(F.col("episode_id") % 31 == 0, "uncertain").otherwise("pass").alias("verdict"), (F.col("episode_id") % 97 == 0).alias("critical"))
    imports = cohorts.groupBy("domain_id", "cohort_id", "membership_hash").agg(F.count(F.lit(1)).cast("int").alias("imported_label_count")).withColumns({"schema_version": F.lit(campaign.IMPORT_SCHEMA), "complete": F.lit(True)})
    results = campaign_results(s, d, episodes).withColumn("cohort_membership_hash", F.concat(F.lit("h-"), "domain_id"))
    return campaign.domain_decisions(plan, results, episodes.where("admitted"), expected, cohorts, labels, imports)


@query
def domain_decisions(s, d):
    return decided(s, d)


@query
def campaign_decision(s, d):
    checks = view(s, d, "runs_v").where("run_id < 8").select(F.element_at(F.array(*[F.lit(x) for x in campaign.ENGINEERING_CHECKS]), (F.col("run_id") + 1).cast("int")).alias("name"), F.lit("passed").alias("status"), F.lit("log").alias("evidence"))
    return campaign.campaign_decision(decided(s, d), campaign.readiness(checks))


@query
def engineering_readiness(s, d):
    checks = view(s, d, "runs_v").where("run_id between 1 and 8").select(F.element_at(F.array(*[F.lit(x) for x in campaign.ENGINEERING_CHECKS]), F.col("run_id").cast("int")).alias("name"), F.when(F.col("run_id") % 5 == 0, "failed").otherwise("passed").alias("status"), F.when(F.col("run_id") % 3 != 0, "log").alias("evidence"))
    return campaign.readiness(checks.where("name <> 'docs'")).select("status", F.array_join("missing_checks", ",").alias("missing_checks"), F.array_join("failed_or_unverified_checks", ",").alias("failed_or_unverified_checks"))


@query
def label_summary(s, d):
    members = cohort_members(s, d).withColumn("purpose", F.when(F.col("cohort_id") == "cohort0", "held-out-evaluation").otherwise("diagnostic-development"))
    labels = members.join(review.dimension_verdict(view(s, d, "labels_long_v")), "episode_id")
    got = review.label_summary(members, labels)
    return got.withColumn("approved_ids", F.sha2(F.array_join("approved_ids", ","), 256))


@query
def campaign_evidence(s, d):
    """The evidence of a campaign over runs of a hundred documents each, of which every third isn't completed."""
    rows = view(s, d, "evidence_v").withColumn("run_id", F.floor(F.col("evidence_id") / 100))
    runs = rows.select("run_id").distinct().withColumn("status", F.when(F.col("run_id") % 3 == 2, "partial").otherwise("completed"))
    members = rows.where("human_verdict is not null").select("run_id", F.col("cohort").alias("cohort_id"), F.col("evidence_id").alias("episode_id"), F.lit("held-out-evaluation").alias("purpose"), F.when(F.col("cohort") == 0, "c1").otherwise("c0").alias("campaign_id"))
    terminals = rows.select("run_id", F.col("evidence_id").alias("sequence"), F.col("evidence_id").alias("episode_id"), "domain_id", F.lit("v1").alias("domain_version"), F.col("eligible").alias("gates_passed"), F.lit("t").alias("task_type"), F.lit("easy").alias("difficulty"), F.col("source_group").alias("structural_key"))
    labels = rows.where("human_verdict is not null").select("run_id", F.col("cohort").alias("cohort_id"), F.col("evidence_id").alias("episode_id"), F.col("human_verdict").alias("verdict"), "critical")
    judgments = rows.where("judge_verdict <> 'unavailable'").select("run_id", F.col("evidence_id").alias("episode_id"), F.col("judge_verdict").alias("verdict"))
    made = rows.where("evidence_id % 4 <> 0").select("run_id", F.col("evidence_id").alias("sequence"), F.concat(F.lit("key"), F.col("evidence_id").cast("string")).alias("semantic_key"))
    got, _ = evidence.campaign_evidence(runs, members, terminals, labels, judgments, made, "c1", "held-out-evaluation")
    return got.select("evidence_id", "episode_id", "semantic_task_group", "judge_verdict", "human_verdict", "critical", "reviewed")


@query
def scope_reasons(s, d):
    k = F.col("evidence_id")
    policy = s.createDataFrame([tuple(["i"] * 3 + ["p"] * 6 + ["s"] * 2)], ", ".join(f"{c} string" for c in (*evidence.IDENTITIES, *evidence.SETTINGS, *evidence.SCOPES)))
    other = lambda condition, value: F.when(condition, "other").otherwise(value)
    rows = view(s, d, "evidence_v").select(
        k.alias("position"), F.col("eligible").alias("deterministic_eligible"), F.when(k % 4 != 0, "g").alias("semantic_task_group"), F.lit("g").alias("grounding_group"),
        *[other((k % 50 == 49) if c == "agent_identity" else F.lit(False), "i").alias(c) for c in evidence.IDENTITIES], *[other((k % 40 == 39) if c == "judge_prompt_id" else F.lit(False), "p").alias(c) for c in evidence.SETTINGS], *[F.lit("s").alias(c) for c in evidence.SCOPES],
    )
    return evidence.scope_reasons(rows, policy)


@query
def eligibility_report(s, d):
    from .queries import QUERIES

    got = reports.eligibility_report(QUERIES["development_reasons"](s, d))
    return got.select(F.array_join("reasons", ",").alias("reasons"), "eligible")


@query
def pilot_report(s, d):
    """What the contact episodes of even variants showed."""
    assessed = assessment.assess_contacts(with_events(view(s, d, "contact_cases_v"), view(s, d, "contact_events_v"), "contact_key", "position"))
    rows = assessed.withColumn("admitted", F.col("assessment.passed") & (F.col("v") % 2 == 0)).withColumn("collection", F.when(F.col("admitted"), "demonstrations").otherwise("negatives"))
    return reports.pilot_report(rows, True, 8, 1_000_000)


def identity(name: str | Column) -> Column:
    return F.struct(F.lit("p").alias("provider_id"), (F.lit(name) if isinstance(name, str) else name).alias("model_id"), F.lit("1").alias("model_version"))


@query
def enforcement_preflight(s, d):
    """Runs that may enforce a policy, and runs with one thing wrong each."""
    k = F.col("run_id") % 16
    other = lambda n, value: F.when(k == n, "other").otherwise(value)
    settings = {n: "x" for n in evidence.SETTINGS} | {n: "s" for n in evidence.SCOPES}
    scopes = F.array(F.struct(F.lit("contacts").alias("domain_id"), F.lit("v1").alias("domain_version")))
    policy = F.struct(F.lit("pol").alias("policy_id"), F.lit("fp").alias("fingerprint"), F.lit("rubric").alias("rubric_id"), F.when(k != 6, scopes).alias("domain_scopes"), *[F.when(F.lit(n != "judge_identity") | (k != 7), identity("judge" if n == "judge_identity" else "model")).alias(n) for n in evidence.IDENTITIES], *[F.lit(v).alias(n) for n, v in settings.items()])
    made = lambda eligibility, bound, reasons: F.struct(eligibility.alias("eligibility"), F.lit("pol").alias("policy_id"), bound.alias("policy_fingerprint"), reasons.alias("ineligibility_reasons"))
    none = F.array().cast("array<string>")
    rows = view(s, d, "runs_v").select(
        "run_id", F.when(k == 0, "deterministic").otherwise("enforced").alias("admission_mode"), F.when(k != 2, policy).alias("policy"), made(F.when(k == 3, "ineligible").otherwise("eligible"), other(4, "fp"), none).alias("activation"),
        made(F.lit("eligible"), other(4, "fp"), F.when(k == 5, F.array(F.lit("evaluation_review_quota_not_met"))).otherwise(none)).alias("recomputed"), F.lit("contacts").alias("domain_id"), F.when(k == 8, None).when(k == 9, "v2").otherwise("v1").alias("domain_version"),
        F.when(k != 10, identity(other(11, "model"))).alias("model_identity"), F.struct(*[(other(12, v) if n == "agent_prompt_id" else F.lit(v)).alias(n) for n, v in settings.items() if not n.startswith("judge")]).alias("configuration"),
        F.struct(other(13, "shadow").alias("mode"), F.lit("judge").alias("judge_model_id"), F.lit("rubric").alias("rubric_id"), other(14, "x").alias("judge_prompt_id"), F.lit("x").alias("judge_decoding_id")).alias("quality"), F.when(k != 15, identity("judge")).alias("judge_identity"),
    )
    return evidence.enforcement_preflight(rows).select("run_id", "reason")


@query
def activation_reasons(s, d):
    """The evaluation of a policy over all labelled documents: two thirds for development, of which some aren't reviewed, a third held out."""
    k = F.col("evidence_id")
    names = (*evidence.IDENTITIES, *evidence.SETTINGS, *evidence.SCOPES)
    policy = s.createDataFrame([("pol", "fp", ["en"], *["i", "i", "j"], *["x"] * 6, *["s"] * 2)], "policy_id string, fingerprint string, domain_scopes array<string>, " + ", ".join(f"{n} string" for n in names))
    scopes = s.createDataFrame([(x, "v1") for x in ("en", "de", "fr", "es")], "domain_id string, domain_version string")
    rows = view(s, d, "evidence_v").select(
        "evidence_id", k.alias("episode_id"), "domain_id", F.lit("v1").alias("domain_version"), F.col("eligible").alias("deterministic_eligible"), F.concat(F.lit("g"), k.cast("string")).alias("semantic_task_group"), F.concat(F.lit("g"), k.cast("string")).alias("grounding_group"), F.lit("t").alias("task_type"),
        F.lit("easy").alias("difficulty"), F.when(k % 100 != 7, F.col("source_group")).alias("structural_family"), "judge_verdict", "human_verdict", F.coalesce("critical", F.lit(False)).alias("critical"), "cohort",
        *[F.when((k % 250 == 3) & F.lit(n == "agent_identity"), "other").otherwise("j" if n == "judge_identity" else "i").alias(n) for n in evidence.IDENTITIES], *[F.lit("x").alias(n) for n in evidence.SETTINGS], *[F.when((k % 500 == 6) & F.lit(n == "source_scope_id"), "other").otherwise("s").alias(n) for n in evidence.SCOPES],
    )
    cohort = lambda name, method, bound: s.createDataFrame([(name, method, "pol" if bound else None, "fp" if bound else None, 3)], "cohort_id string, selection_method string, policy_id string, policy_fingerprint string, stratum_count int")
    member = lambda at: at.where("human_verdict is not null").select(F.col("evidence_id").alias("position"), "evidence_id")
    dev, held = rows.where("cohort <> 0").drop("cohort"), rows.where("cohort = 0 and human_verdict is not null").drop("cohort")
    got = activation.activation(policy, scopes, activation.Campaign("diagnostic-development", 0, cohort("a", activation.STRATIFIED, False), member(dev), dev), activation.Campaign("held-out-evaluation", 0, cohort("b", activation.HELD_OUT, True), member(held), held))
    return got.select("policy_id", "policy_fingerprint", "eligibility", F.array_join("ineligibility_reasons", ",").alias("reasons"))


@query
def gate_reasons(s, d):
    return gated(s, d).select("sequence", "gates_passed", "gate_reason")


@query
def review_strata(s, d):
    rows = admitted(s, d).where("admitted").select("sequence", "domain_id", F.when(F.col("sequence") % 3 != 0, F.col("task_type")).alias("task_type"), F.lit(None).cast("string").alias("difficulty"), F.when(F.col("sequence") % 5 != 0, F.col("structural_key")).alias("structural_key"))
    return review.strata(rows).groupBy("domain_id", "task_type", "difficulty", "structural_key").agg(F.count(F.lit(1)).alias("n"))


@query
def generation_requests_by_episode(s, d):
    rows = usage.with_sequences(view(s, d, "requests_v").withColumn("related_sequences", F.when(F.col("related_sequence").isNotNull(), F.array("related_sequence", "sequence"))))
    return rows.groupBy("sequence").agg(F.count(F.lit(1)).alias("n"))


@query
def replay_aligned(s, d):
    from .queries import QUERIES

    return QUERIES["replay_status"](s, d).agg(F.every(F.col("status").isin("aligned", "not_executed")).alias("aligned"), F.count(F.lit(1)).alias("n"))


@query
def final_grounding(s, d):
    """Whether the final response of every contact episode names its target."""
    events = view(s, d, "contact_events_v").where("event_type = 'final_response'").select(F.concat_ws(":", "contact_key", "position").alias("conv_id"), "idx", "event_type", "content")
    values = view(s, d, "contact_cases_v").select(F.concat_ws(":", "contact_key", "position").alias("conv_id"), F.col("target").alias("value"))
    # Tasks sort their conversations, so their number follows the conversations.
    parts = max(int(s.conf.get("spark.sql.shuffle.partitions")), values.count() // SORTED + 1)
    return sequence.grounded(sequence.final_response(events.repartition(parts, "conv_id")), values.repartition(parts, "conv_id"))
