"""Task cases of the three domains: payloads, public tasks, tools, compilation, keys and private records (DM-3 to DM-15, HP-5, HP-9, HP-12, HP-13, HP-15).

A case is a row: the slot's kind, action and route, what it acts on, and the
arguments that it allows.  Public texts, tool lists, keys and records are
expressions over these columns, so a task space of any size is one projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import canonical, group_id, json_string, semantic_key, sha, spaced
from ..functions.jsontext import dumped
from ..functions.payload import Payload, first_reason
from ..functions.schemas import definition, tools_json
from ..functions.text import comment_allowed, negated_action, negated_text, note_allowed, reply_allowed
from .tasks import WORKSPACE_SPECS, contact_slots

# By kind of contact task its action, route and note constraint; the note of an exact one.
CONTACT_CASES = {
    "lookup-direct": ("lookup_email", "direct", "none"), "lookup-directory": ("lookup_email", "directory", "none"), "lookup-recovery": ("lookup_email", "recovery", "none"), "followup-open": ("record_followup", "direct", "open"),
    "followup-exact": ("record_followup", "direct", "exact"), "followup-directory": ("record_followup", "directory", "open"), "followup-recovery": ("record_followup", "recovery", "open"), "followup-verified": ("record_followup", "verify", "open"),
}
EXACT_NOTE = "Please follow up by email."
# By kind of message task its action, route and reply constraint; the time of a reminder.
MESSAGE_CASES = {
    "search-direct": ("search_messages", "direct", "none"), "search-directory": ("search_messages", "directory", "none"), "search-recovery": ("search_messages", "recovery", "none"), "reminder-direct": ("create_reminder", "direct", "none"),
    "reminder-directory": ("create_reminder", "directory", "none"), "reminder-recovery": ("create_reminder", "recovery", "none"), "reminder-verified": ("create_reminder", "verify", "none"), "draft-direct": ("create_draft_reply", "direct", "open"),
    "draft-directory": ("create_draft_reply", "directory", "open"), "draft-recovery": ("create_draft_reply", "recovery", "open"), "draft-exact": ("create_draft_reply", "direct", "exact"), "draft-verified": ("create_draft_reply", "verify", "open"),
}
REMIND_AT = "2026-10-04T09:00:00Z"
# By kind of workspace task its action, route, task constraint and comment constraint; the query of what isn't there.
WORKSPACE_CASES = {
    "search-direct": ("search_workspace_items", "direct", "none", "none"), "search-directory": ("search_workspace_items", "directory", "none", "none"), "search-recovery": ("search_workspace_items", "recovery", "none", "none"),
    "search-missing": ("search_workspace_items", "missing", "none", "none"), "task-direct": ("create_workspace_task", "direct", "exact", "none"), "task-verified": ("create_workspace_task", "verify", "open", "none"),
    "comment-direct": ("add_workspace_comment", "direct", "none", "open"), "comment-recovery": ("add_workspace_comment", "recovery", "none", "exact"), "comment-verified": ("add_workspace_comment", "verify", "none", "open"),
}
MISSING_QUERY, MISSING_KIND = "archived roadmap", "document"
# Every tool with its description, its arguments (all required, all text) and its results.
TOOLS = (
    ("lookup_contact", "Look up one contact's email address by name.", "name", "name email"),
    ("list_contacts", "List the available contact names.", "", "contacts"),
    ("record_followup", "Record one follow-up note for a confirmed contact.", "name note", "name note"),
    ("get_followup", "Retrieve the saved follow-up note for one contact.", "name", "name note"),
    ("search_messages", "Find one message by a public text query.", "query", "message_id sender body"),
    ("list_message_senders", "List senders represented in the local message collection.", "", "senders"),
    ("create_reminder", "Create one reminder for a message observed in this Episode.", "message_id reminder_text remind_at", "message_id reminder_text remind_at"),
    ("get_reminder", "Retrieve the saved reminder for one message.", "message_id", "message_id reminder_text remind_at"),
    ("create_draft_reply", "Create one reply draft for a message observed in this Episode.", "message_id content", "message_id content"),
    ("get_draft_reply", "Retrieve the saved reply draft for one message.", "message_id", "message_id content"),
    ("search_workspace_items", "Find one workspace item by a public query and kind.", "query kind", "item_id kind summary"),
    ("list_workspace_projects", "List projects represented in this isolated workspace.", "", "projects"),
    ("create_workspace_task", "Create one task in a project observed in this Episode.", "project_id title priority due_label", "task_id project_id title priority due_label"),
    ("get_workspace_task", "Retrieve a task created in this Episode.", "task_id", "task_id project_id title priority due_label"),
    ("add_workspace_comment", "Add one comment to a task observed in this Episode.", "task_id comment", "comment_id task_id comment"),
    ("get_workspace_comment", "Retrieve a comment created in this Episode.", "comment_id", "comment_id task_id comment"),
)


def tool_schemas() -> dict[str, dict]:
    """DM-6, HP-13: every tool's public definition with its JSON schemas by name; lists are arrays, all else is text."""
    kind = lambda n: {"type": "array" if n in ("contacts", "senders", "projects") else "string"}
    return {n: definition(n, d, {x: kind(x) for x in i.split()}, {x: kind(x) for x in o.split()}) for n, d, i, o in TOOLS}


#: How many of TOOLS, in order, each domain has.
DOMAIN_TOOLS = {"contacts": slice(0, 4), "mobile_messages": slice(4, 10), "workspace_tasks": slice(10, 16)}


def input_schemas(domain: str) -> dict[str, dict]:
    """The input schemas of a domain's tools by name."""
    return {n: t["input_schema"] for n, t in list(tool_schemas().items())[DOMAIN_TOOLS[domain]]}


def public_tools(names: Column) -> Column:
    """DM-5, DM-6: the definitions of the tools in ``names`` (an array), in their order, as canonical JSON."""
    return tools_json(names, {n: dumped(t) for n, t in tool_schemas().items()})


def _of(table: dict[str, tuple], kind: Column, k: int) -> Column:
    return F.create_map(*[F.lit(x) for name, row in table.items() for x in (name, row[k])])[kind]


def stale(query: Column) -> Column:
    """DM-11: the query of a recovery's first try."""
    return F.concat(query, F.lit(" (stale)"))


def prompt(payload: Column) -> Column:
    return F.concat(F.lit("Return exactly this JSON proposal: "), payload)


# --- contacts


def contact_cases(contacts: DataFrame, followups: DataFrame) -> DataFrame:
    """DM-1, DM-3, DM-12: the slots of contacts (name, email) with their cases, payloads and prompts."""
    at = contact_slots(contacts.select("name"), followups).join(contacts.select("name", F.col("email").alias("expected_email")), "name").withColumnRenamed("name", "target")
    kind = F.col("kind")
    at = at.withColumns({"action": _of(CONTACT_CASES, kind, 0), "route": _of(CONTACT_CASES, kind, 1), "note_constraint": _of(CONTACT_CASES, kind, 2)})
    at = at.withColumn("exact_note", F.when(F.col("note_constraint") == "exact", EXACT_NOTE))
    writes = F.col("action") == "record_followup"
    payload = spaced({"action": F.col("action"), "contact": F.col("target"), "route": F.col("route"), "condition": F.when(writes, "after_lookup_match"), "note_constraint": F.when(writes, F.col("note_constraint")), "note": F.col("exact_note")})
    return at.withColumn("payload", payload).withColumn("proposal_prompt", prompt(payload))


def contact_record() -> Column:
    """DM-8: a contact case's private record."""
    return canonical({c: F.col(c) for c in ("action", "expected_email", "exact_note", "note_constraint", "route", "target")})


def contact_key() -> Column:
    """DM-7."""
    note = F.when(F.col("note_constraint") == "exact", F.col("exact_note"))
    return semantic_key("contacts", canonical({"action": F.col("action"), "exact_note": note, "grounding_email": F.col("expected_email"), "note_constraint": F.col("note_constraint"), "route": F.col("route"), "target": F.col("target")}))


def contact_instruction() -> Column:
    """DM-5: the public text of a contact case."""
    target, route = F.col("target"), F.col("route")
    find = F.concat(F.lit("ind the email address for "), target, F.lit("."))
    lookup = (
        F.when(route == "directory", F.concat(F.lit("Use the contact directory to identify "), target, F.lit(", then f"), find))
        .when(route == "recovery", F.concat(F.lit("A stale contact label may fail. First look up '"), stale(target), F.lit("'. If it reports no contact, use the contact directory to identify "), target, F.lit(", then f"), find))
        .otherwise(F.concat(F.lit("F"), find))
    )
    note = F.when(F.col("note_constraint") == "exact", F.concat(F.lit('Record exactly this follow-up note: "'), F.col("exact_note"), F.lit('".'))).otherwise("Record a brief follow-up note.")
    more = F.when(route == "verify", " Then retrieve the saved follow-up and report the recorded note.").otherwise("")
    return F.when(F.col("action") == "lookup_email", lookup).otherwise(F.concat(lookup, F.lit(" After the lookup confirms "), target, F.lit(", "), note, more))


def _tool_list(*named: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(condition, F.lit(False)), name) for condition, name in named]))


def contact_tools() -> Column:
    """DM-5: the tools that a contact task shows, in order."""
    route, writes = F.col("route"), F.col("action") == "record_followup"
    return _tool_list((F.lit(True), "lookup_contact"), (route.isin("directory", "recovery"), "list_contacts"), (writes, "record_followup"), (writes & (route == "verify"), "get_followup"))


def compile_contacts(proposals: DataFrame) -> DataFrame:
    """DM-4: ``proposals`` (content, and the slot's target, expected_email, action, route and note_constraint; a null action is an unknown slot) with ``reason``, and of what compiles exact_note, semantic_key and private_case.

    An exact note is any allowed one of the proposal.
    """
    proposals, p, names = Payload.read(proposals, F.col("content"))
    action, note, exact = p.text("action"), p.text("note"), F.col("note_constraint") == "exact"
    writes = F.col("action") == "record_followup"
    base = ("action", "contact", "route")
    written = (*base, "condition", "note_constraint")
    reason = first_reason([
        (F.col("action").isNull(), "unsupported_task_slot"), (p.broken & negated_text(F.col("content")), "negated_action"), (p.broken, "proposal_not_json"), (~p.object, "proposal_not_object"), (action.isNull(), "unsupported_requested_action"),
        (p.true("negated") | negated_action(action), "negated_action"), (~p.text("contact").eqNullSafe(F.col("target")), "wrong_contact_binding"), (action != F.col("action"), "unsupported_requested_action"),
        (~p.text("route").eqNullSafe(F.col("route")), "uncheckable_condition"), (writes & ~p.text("condition").eqNullSafe(F.lit("after_lookup_match")), "uncheckable_condition"),
        (writes & ~p.text("note_constraint").eqNullSafe(F.col("note_constraint")), "unsupported_note"), (writes & exact & ~F.coalesce(note_allowed(note), F.lit(False)), "unsupported_note"), (writes & ~exact & p.has("note"), "unsupported_note"),
        (writes & exact & ~p.only(*written, "note"), "unsupported_requested_action"), (writes & ~exact & ~p.only(*written), "unsupported_requested_action"), (~writes & ~p.only(*base), "unsupported_requested_action"),
    ])
    out = proposals.withColumn("reason", reason).withColumn("exact_note", F.when(F.col("reason").isNull() & exact, note)).drop(*names)
    return out.withColumn("semantic_key", F.when(F.col("reason").isNull(), contact_key())).withColumn("private_case", F.when(F.col("reason").isNull(), contact_record()))


def restored_contacts(cases: DataFrame) -> DataFrame:
    """DM-8: whether each ``private_case`` has a shape that some task has, and the key that it is stored with (``semantic_key``)."""
    cases, p, names = Payload.read(cases, F.col("private_case"))
    fields = {"target": p.text("target"), "expected_email": p.text("expected_email"), "action": F.coalesce(p.text("action"), F.lit("lookup_email")), "route": F.coalesce(p.text("route"), F.lit("direct")), "note_constraint": F.coalesce(p.text("note_constraint"), F.lit("none")), "exact_note": p.text("exact_note")}
    at = cases.select(*[F.col(c) for c in cases.columns if c not in (*fields, *names)], *[v.alias(k) for k, v in fields.items()], p.object.alias("__object"))
    shape = reduce(lambda a, b: a | b, [(F.col("action") == a) & (F.col("route") == r) & (F.col("note_constraint") == n) for a, r, n in CONTACT_CASES.values()])
    exact = F.col("note_constraint") == "exact"
    note = F.when(exact, note_allowed(F.coalesce("exact_note", F.lit("")))).otherwise(F.col("exact_note").isNull())
    valid = F.col("__object") & F.col("target").isNotNull() & F.col("expected_email").isNotNull() & shape & note & (contact_key() == F.col("semantic_key"))
    return at.withColumn("valid", F.coalesce(valid, F.lit(False))).drop("__object")


def pilot_rehearsal(slots: DataFrame, fingerprint: Column, target: int, attempts: int) -> DataFrame:
    """AG-25, SNK-11: capacity, whether it suffices, and the groups of the first ``attempts`` slots (slot_id, target, in the order of target and position), which show neither slots nor targets."""
    first = slots.orderBy("target", "position").limit(attempts)
    total = slots.agg(F.count(F.lit(1)).alias("known_task_capacity"))
    marked = first.withColumns({"semantic": group_id("semantic", fingerprint, F.col("slot_id")), "grounding": group_id("grounding", fingerprint, F.col("target"))})
    groups = marked.agg(F.transform(F.array_sort(F.collect_list(F.struct("target", "position", "semantic"))), lambda r: r["semantic"]).alias("semantic_groups"), F.array_sort(F.collect_set("grounding")).alias("grounding_groups"))
    status = F.when(F.col("known_task_capacity") >= target, "sufficient").otherwise("insufficient")
    return total.crossJoin(groups).select("known_task_capacity", status.alias("capacity_status"), "semantic_groups", "grounding_groups")


# --- messages


def message_cases(slots: DataFrame, messages: DataFrame) -> DataFrame:
    """DM-1, DM-3, DM-12: ``slots`` (as of message_slots) with their cases, payloads, prompts, instructions, tools, private records and keys."""
    from .tasks import message_query

    kind = F.col("kind")
    at = slots.join(messages.select("message_id", "sender", "body"), "message_id").withColumn("query", message_query(F.col("body")))
    at = at.withColumns({"action": _of(MESSAGE_CASES, kind, 0), "route": _of(MESSAGE_CASES, kind, 1), "reply_constraint": _of(MESSAGE_CASES, kind, 2)})
    review = lambda opening: F.concat(F.lit(opening), F.col("query"), F.lit("."))
    reminds, exact = F.col("action") == "create_reminder", F.col("reply_constraint") == "exact"
    at = at.withColumns({"reminder_text": F.when(reminds, review("Review the ")), "remind_at": F.when(reminds, F.lit(REMIND_AT)), "exact_reply": F.when(exact, review("Thanks, I will review the "))})
    searches, drafts = F.col("action") == "search_messages", F.col("action") == "create_draft_reply"
    payload = spaced({
        "action": F.col("action"), "route": F.col("route"), "query": F.when(searches, F.col("query")), "message_query": F.when(~searches, F.col("query")), "condition": F.when(~searches, "after_message_match"), "reminder_text": F.col("reminder_text"), "remind_at": F.col("remind_at"),
        "reply_constraint": F.when(drafts, F.col("reply_constraint")), "reply": F.col("exact_reply"),
    })
    private = message_private()
    return at.withColumns({"payload": payload, "proposal_prompt": prompt(payload), "instruction": message_instruction(), "tools": message_tools(), "private_case": private, "semantic_key": semantic_key("mobile_messages", private)})


MESSAGE_FIELDS = ("action", "body", "exact_reply", "message_id", "remind_at", "reminder_text", "reply_constraint", "route", "sender")


def message_private() -> Column:
    """DM-8: a message case's private record, of which the key is made too."""
    return canonical({c: F.col(c).cast("string") for c in MESSAGE_FIELDS})


def optional_text(p: Payload, *names: str) -> Column:
    """Whether each field is a string, null or missing."""
    return reduce(lambda a, b: a & b, [F.coalesce(p.type_of(n).isin("STRING", "VOID"), F.lit(True)) for n in names])


def restored(cases: DataFrame, fields: dict[str, Column], parsed: Column, valid: Column, names: list[str]) -> DataFrame:
    """``cases`` with the ``fields`` of their private_case, and whether it is ``valid`` (a condition over these and ``__ok``, which ``parsed`` fills); without the payload's columns ``names``."""
    at = cases.select(*[F.col(c) for c in cases.columns if c not in (*fields, *names)], *[v.alias(k) for k, v in fields.items()], F.coalesce(parsed, F.lit(False)).alias("__ok"))
    return at.withColumn("valid", F.col("__ok") & F.coalesce(valid, F.lit(False))).drop("__ok")


def restored_messages(cases: DataFrame) -> DataFrame:
    """DM-8: whether each message case's ``private_case`` has a shape that some task has, and the key that it is stored with (``semantic_key``)."""
    cases, p, names = Payload.read(cases, F.col("private_case"))
    fields = {n: p.text(n) for n in MESSAGE_FIELDS}
    action, rule, reply, text, when = (F.col(c) for c in ("action", "reply_constraint", "exact_reply", "reminder_text", "remind_at"))
    shape = reduce(lambda a, b: a | b, [(action == a) & (F.col("route") == r) & (rule == n) for a, r, n in MESSAGE_CASES.values()])
    named = F.col("message_id").isNotNull() & F.col("sender").isNotNull() & F.col("body").isNotNull()
    told = F.when(action == "create_reminder", text.isNotNull() & when.isNotNull()).otherwise(text.isNull() & when.isNull())
    said = F.when(rule == "exact", reply_allowed(reply)).otherwise(reply.isNull())
    key = semantic_key("mobile_messages", message_private()) == F.col("semantic_key")
    return restored(cases, fields, p.object & optional_text(p, "reminder_text", "remind_at", "exact_reply"), named & shape & told & said & key, names)


def message_instruction() -> Column:
    query, sender, route = F.col("query"), F.col("sender"), F.col("route")
    found = F.concat(F.lit('the message that mentions "'), query, F.lit('".'))
    search = (
        F.when(route == "directory", F.concat(F.lit("Use the sender list to identify "), sender, F.lit(", then find "), found))
        .when(route == "recovery", F.concat(F.lit('A stale message query may fail. First search for "'), stale(query), F.lit('". If it reports no message, use the sender list to identify '), sender, F.lit(", then find "), found))
        .otherwise(F.concat(F.lit("Find the message from "), sender, F.lit(' that mentions "'), query, F.lit('".')))
    )
    verify = lambda text: F.when(route == "verify", text).otherwise("")
    reminder = F.concat(F.lit("create a reminder for "), F.col("remind_at"), F.lit(' that says "'), F.col("reminder_text"), F.lit('".'), verify(" Then retrieve the saved reminder and report its text and time."))
    reply = F.when(F.col("reply_constraint") == "exact", F.concat(F.lit('Draft exactly this reply: "'), F.col("exact_reply"), F.lit('".'))).otherwise("Draft a brief courteous reply.")
    draft = F.concat(reply, verify(" Then retrieve the saved draft and report its content."))
    after = F.concat(search, F.lit(" After finding the selected message, "))
    return F.when(F.col("action") == "create_reminder", F.concat(after, reminder)).when(F.col("action") == "create_draft_reply", F.concat(after, draft)).otherwise(search)


def message_tools() -> Column:
    action, route = F.col("action"), F.col("route")
    named = [(F.lit(True), "search_messages"), (route.isin("directory", "recovery"), "list_message_senders")]
    for tool, read in (("create_reminder", "get_reminder"), ("create_draft_reply", "get_draft_reply")):
        named += [(action == tool, tool), ((action == tool) & (route == "verify"), read)]
    return _tool_list(*named)


# --- workspace


def missing_query(items: DataFrame) -> DataFrame:
    """DM-13: one row with the first query of the series that no document has.

    The series has a member more than there are documents in it, so only
    documents in the series are looked at.
    """
    taken = items.where((F.col("kind") == MISSING_KIND) & F.col("query").startswith(MISSING_QUERY)).select("query").distinct()
    spaced_out = taken.select(F.when(F.col("query") == MISSING_QUERY, 0).otherwise(F.regexp_extract("query", f"^{MISSING_QUERY} unavailable ([1-9][0-9]{{0,8}})\\z", 1).try_cast("int")).alias("k")).where("k is not null")
    n = spaced_out.agg(F.count(F.lit(1)).alias("n"))
    free = n.select(F.explode(F.sequence(F.lit(0), F.col("n").cast("int"))).alias("k")).join(spaced_out, "k", "left_anti").agg(F.min("k").alias("k"))
    return free.select(F.when(F.col("k") == 0, MISSING_QUERY).otherwise(F.format_string(f"{MISSING_QUERY} unavailable %d", "k")).alias("missing_query"))


def workspace_cases(slots: DataFrame, items: DataFrame) -> DataFrame:
    """DM-1, DM-3, DM-7, DM-12, HP-12: ``slots`` (as of workspace_slots: spec, position, item_id, target_index) with cases, payloads, prompts, instructions, tools, slot ids, private records and keys."""
    spec = F.col("spec")
    at = slots.join(items.select("item_id", "kind", "query", "summary", "project_id"), "item_id", "left").crossJoin(F.broadcast(missing_query(items)))
    at = at.withColumns({"action": _of(WORKSPACE_CASES, spec, 0), "route": _of(WORKSPACE_CASES, spec, 1), "task_constraint": _of(WORKSPACE_CASES, spec, 2), "comment_constraint": _of(WORKSPACE_CASES, spec, 3)})
    missing, tasks, direct = F.col("route") == "missing", F.col("action") == "create_workspace_task", F.col("route") == "direct"
    title = F.concat(F.lit("Prepare "), F.col("summary"), F.when(direct, " retrospective").otherwise(" review"))
    at = at.withColumns({
        "missing_query": F.when(missing, F.col("missing_query")), "missing_kind": F.when(missing, MISSING_KIND), "title": F.when(tasks & (F.col("task_constraint") == "exact"), title), "priority": F.when(tasks, F.when(direct, "high").otherwise("medium")),
        "due_label": F.when(tasks, F.when(direct, "next_week").otherwise("later")), "exact_comment": F.when(F.col("comment_constraint") == "exact", F.concat(F.lit("Status: "), F.col("query"), F.lit(" is ready for review."))),
    })
    searches, comments = F.col("action") == "search_workspace_items", F.col("action") == "add_workspace_comment"
    payload = spaced({
        "action": F.col("action"), "route": F.col("route"), "kind": F.when(searches, F.coalesce("missing_kind", "kind")), "query": F.when(searches, F.coalesce("missing_query", "query")), "condition": F.when(~searches, "after_item_match"), "due_label": F.col("due_label"),
        "priority": F.col("priority"), "project_kind": F.when(tasks, F.col("kind")), "project_query": F.when(tasks, F.col("query")), "title": F.col("title"), "task_constraint": F.when(tasks & F.col("title").isNull(), F.col("task_constraint")),
        "comment_constraint": F.when(comments, F.col("comment_constraint")), "task_kind": F.when(comments, F.col("kind")), "task_query": F.when(comments, F.col("query")), "comment": F.col("exact_comment"),
    })
    target, private = workspace_target(), workspace_private()
    component = F.coalesce(target, canonical({"kind": F.lit(MISSING_KIND), "query": F.col("missing_query")}))
    slot = F.concat(F.lit("workspace-"), spec, F.lit("-item-"), F.substring(sha(component), 1, 24))
    at = at.withColumn("private_case", private).withColumns({"payload": payload, "proposal_prompt": prompt(payload), "instruction": workspace_instruction(), "tools": workspace_tools(), "semantic_key": semantic_key("workspace_tasks", F.col("private_case"))})
    return at.withColumn("slot_id", slot)


ITEM_FIELDS = ("item_id", "kind", "project_id", "query", "summary")
WORKSPACE_FIELDS = ("action", "comment_constraint", "due_label", "exact_comment", "missing_kind", "missing_query", "priority", "route", "task_constraint", "title")


def workspace_target() -> Column:
    return F.when(F.col("item_id").isNotNull(), canonical({c: F.col(c) for c in ITEM_FIELDS}))


def workspace_private() -> Column:
    """DM-8: a workspace case's private record, of which the key is made too."""
    return canonical({c: F.col(c) for c in WORKSPACE_FIELDS} | {"target": workspace_target()}, nested=("target",))


def restored_workspace(cases: DataFrame) -> DataFrame:
    """DM-8: whether each workspace case's ``private_case`` is one that a task makes of its target, and has the key that it is stored with (``semantic_key``)."""
    cases, p, names = Payload.read(cases, F.col("private_case"))
    cases, q, inner = Payload.read(cases, F.lit(None), "__q", p.get("target"))
    fields = {n: p.text(n) for n in WORKSPACE_FIELDS} | {n: q.text(n) for n in ITEM_FIELDS}
    parsed = p.object & optional_text(p, "due_label", "exact_comment", "missing_kind", "missing_query", "priority", "title") & (q.object | F.coalesce(p.type_of("target") == "VOID", F.lit(True))) & optional_text(q, "project_id")
    c, missing, direct = F.col, F.col("route") == "missing", F.col("route") == "direct"
    item = c("item_id").isNotNull() & c("kind").isNotNull() & c("query").isNotNull() & c("summary").isNotNull()
    kinds = {spec: (kind, fallback) for spec, _, kind, fallback, _ in WORKSPACE_SPECS}
    spec = lambda n, a, r, t, m: (c("action") == a) & (c("route") == r) & (c("task_constraint") == t) & (c("comment_constraint") == m) & (F.lit(True) if kinds[n][1] or kinds[n][0] is None else c("kind") == kinds[n][0])
    shape = reduce(lambda a, b: a | b, [spec(n, *row) for n, row in WORKSPACE_CASES.items()])
    same = lambda name, value: c(name).eqNullSafe(value)
    tasks, none = c("action") == "create_workspace_task", F.lit(None).cast("string")
    title = F.concat(F.lit("Prepare "), c("summary"), F.when(direct, " retrospective").otherwise(" review"))
    made = (
        same("title", F.when(tasks & (c("task_constraint") == "exact"), title)) & same("priority", F.when(tasks, F.when(direct, "high").otherwise("medium"))) & same("due_label", F.when(tasks, F.when(direct, "next_week").otherwise("later")))
        & same("exact_comment", F.when(c("comment_constraint") == "exact", F.concat(F.lit("Status: "), c("query"), F.lit(" is ready for review.")))) & same("missing_kind", F.when(missing, MISSING_KIND)) & F.when(missing, c("missing_query").isNotNull() & c("item_id").isNull()).otherwise(same("missing_query", none) & item)
    )
    return restored(cases, fields, parsed, shape & made & (semantic_key("workspace_tasks", workspace_private()) == c("semantic_key")), [*names, *inner])


def workspace_instruction() -> Column:
    kind, query, route = F.col("kind"), F.col("query"), F.col("route")
    found = F.concat(F.lit("workspace "), kind, F.lit(' that matches "'), query, F.lit('".'))
    recovers = (route == "recovery") & (F.col("action") != "create_workspace_task")
    search = (
        F.when(route == "missing", F.concat(F.lit("Search for the workspace "), F.col("missing_kind"), F.lit(' that matches "'), F.col("missing_query"), F.lit('". If it is not found, report that safely and make no changes.')))
        .when((route == "directory") & (F.col("action") == "search_workspace_items"), F.concat(F.lit("Use the project directory to identify "), F.col("summary"), F.lit(", then find the "), found))
        .when(recovers, F.concat(F.lit('A stale workspace query may fail. First search for "'), stale(query), F.lit('". If it reports no item, find the '), found))
        .otherwise(F.concat(F.lit("Find the "), found))
    )
    verify = lambda text: F.when(route == "verify", text).otherwise("")
    named = F.when(F.col("task_constraint") == "exact", F.concat(F.lit('create a task titled "'), F.col("title"), F.lit('"'))).otherwise("create a concise planning task")
    task = F.concat(search, F.lit(" After finding the selected project, "), named, F.lit(" with "), F.col("priority"), F.lit(" priority and due "), F.col("due_label"), F.lit("."), verify(" Then retrieve the saved task and report its details."))
    said = F.when(F.col("comment_constraint") == "exact", F.concat(F.lit('Add exactly this comment: "'), F.col("exact_comment"), F.lit('".'))).otherwise("Add a concise status comment.")
    comment = F.concat(search, F.lit(" After finding the selected task, "), said, verify(" Then retrieve the saved comment and report its text."))
    return F.when(F.col("action") == "create_workspace_task", task).when(F.col("action") == "add_workspace_comment", comment).otherwise(search)


def workspace_tools() -> Column:
    action, route = F.col("action"), F.col("route")
    named = [(F.lit(True), "search_workspace_items"), ((action == "search_workspace_items") & (route == "directory"), "list_workspace_projects")]
    for tool, read in (("create_workspace_task", "get_workspace_task"), ("add_workspace_comment", "get_workspace_comment")):
        named += [(action == tool, tool), ((action == tool) & (route == "verify"), read)]
    return _tool_list(*named)


def bound_cases(restored: DataFrame, cases: DataFrame) -> DataFrame:
    """DM-8, DM-9, HP-15: the restored rows whose ``private_case`` is the record of a case that the frozen state gives."""
    return restored.join(cases.select("private_case").distinct(), "private_case", "left_semi")


def valid_arguments() -> Column:
    """DM-8: whether a message case's own arguments fit its action and constraint."""
    draft, exact = F.col("action") == "create_draft_reply", F.col("reply_constraint") == "exact"
    times = F.col("reminder_text").isNotNull() & F.col("remind_at").isNotNull()
    none = F.col("reminder_text").isNull() & F.col("remind_at").isNull()
    reply = F.when(exact, F.coalesce(reply_allowed(F.col("exact_reply")), F.lit(False))).otherwise(F.col("exact_reply").isNull())
    return F.when(F.col("action") == "create_reminder", times & ~exact & F.col("exact_reply").isNull()).when(draft, none & reply & (F.col("reply_constraint") != "none")).otherwise(none & F.col("exact_reply").isNull())


def examples(spark: SparkSession) -> DataFrame:
    """DM-15: the structural families of each domain, as its tasks' routes and constraints give them."""
    rows = [("contacts", f"contacts.{'lookup' if a == 'lookup_email' else 'followup'}.{'verified' if r == 'verify' else r}") for a, r, _ in CONTACT_CASES.values()]
    rows += [("mobile_messages", f"mobile_messages.{k.split('-')[0]}.{'exact' if c == 'exact' else 'verified' if r == 'verify' else r}") for k, (_, r, c) in MESSAGE_CASES.items()]
    rows += [("workspace_tasks", f"workspace_tasks.{k.split('-')[0]}.{'verified' if r == 'verify' else r}") for k, (_, r, *_) in WORKSPACE_CASES.items()]
    return spark.createDataFrame(sorted(set(rows)), "domain_id string, structural_key string")


def rejection(domain: str, reason: Column) -> Column:
    """HP-5: the public task and the reason of a proposal that doesn't compile."""
    names = {"contacts": ("Contacts", "lookup_contact"), "mobile_messages": ("Mobile Messages", "search_messages"), "workspace_tasks": ("Workspace Tasks", "search_workspace_items")}
    title, tool = names[domain]
    return F.struct(F.lit(f"The {title} request could not be compiled.").alias("instruction"), F.array(F.lit(tool)).alias("tools"), reason.alias("reason_code"))
