"""Assessment of episodes from their events (SQ-1 to SQ-14, PRD-6, HP-11), in higher-order functions.

An event is a struct with event_type, tool_name, arguments, observation,
change (maps of text; a list is JSON text), content and error_code, in order.
An episode has ``events``, ``mutation_authorization`` and the columns of its case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import canonical, canonical_array, casefold, evidence, sha
from ..functions.payload import once
from ..functions.text import comment_allowed, note_allowed, reply_allowed, title_allowed

Test = Callable[[Column], Column]
EVENTS = "array<struct<event_type:string,tool_name:string,arguments:map<string,string>,observation:map<string,string>,change:map<string,string>,content:string,error_code:string>>"
# What a response may say of an item that isn't there.
MISSING = ("not found", "unavailable", "no matching")


def yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def read(episodes: DataFrame, **more: Callable[[Column], Column]) -> DataFrame:
    """``episodes`` with __events (as EVENTS, none where it is null), __final (the case-folded final response) and ``more`` over the events, each made once."""
    events = F.col("__events")
    at = once(episodes, __events=F.coalesce(F.col("events").cast(EVENTS), F.array().cast(EVENTS)))
    return once(at, __final=casefold(final_response(events)), **{n: make(events) for n, make in more.items()})


#: The columns that read() makes for an assessment.
MADE = ("__events", "__final", "__found")


def says(value: Column) -> Column:
    """holds() of the final response as read() folds it."""
    return F.coalesce(F.contains(F.col("__final"), casefold(value)), F.lit(False))


def is_event(kind: str, tool: str) -> Test:
    return lambda e: (e["event_type"] == kind) & (e["tool_name"] == tool)


def same_map(a: Column, b: Column) -> Column:
    entries = lambda m: F.sort_array(F.map_entries(m))
    return yes(entries(a) == entries(b))


def is_record(a: Column, **fields: Column) -> Column:
    """same_map() with the record of ``fields``."""
    out = F.size(a) == len(fields)
    for name, value in fields.items():
        out = out & F.map_contains_key(a, name) & F.try_element_at(a, F.lit(name)).eqNullSafe(value)
    return yes(out)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it, for each event too."""
    return F.transform(F.array(value), body)[0]


def record(**fields: Column) -> Column:
    return F.create_map(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def first_place(events: Column, test: Test, after: Column | None = None) -> Column:
    """The place (from 0) of the first event that passes, of those behind ``after``; null if there is none."""
    places = F.filter(F.transform(events, lambda e, k: F.when(yes(test(e)) & (yes(k > after) if after is not None else F.lit(True)), k)), lambda k: k.isNotNull())
    return F.array_min(places)


def route_completed(events: Column, route: Column, target: Test, directory: Test, stale: Test, failure: Test, recovery_by_directory: bool = True) -> Column:
    """SQ-10: whether the target was observed by its route.

    A recovery is a stale action, its failure, a directory (where the domain
    asks for it) and the first target, in this order; the earliest event of
    each step finds it wherever it is, as each step only needs some later one.
    """
    recovered = let(first_place(events, stale), lambda asked: first_place(events, failure, asked))
    if recovery_by_directory:
        recovered = let(recovered, lambda failed: first_place(events, directory, failed))
    return let(
        first_place(events, target),
        lambda at: at.isNotNull() & F.when(route.isin("direct", "verify"), True).when(route == "directory", yes(first_place(events, directory) < at)).when(route == "recovery", yes(recovered < at)).otherwise(False),
    )


def final_response(events: Column) -> Column:
    """WN-8: the content of the last final response."""
    return F.try_element_at(F.transform(F.filter(events, lambda e: e["event_type"] == "final_response"), lambda e: e["content"]), F.lit(-1))


def single_change(events: Column, tool: str) -> tuple[Column, Column]:
    """The change of the only event that changed state by ``tool`` (null if there isn't just one), and whether it is the only change at all."""
    changes = F.filter(events, lambda e: e["event_type"] == "state_change")
    mine = F.filter(changes, lambda e: yes(e["tool_name"] == tool))
    return F.when(F.size(mine) == 1, F.try_element_at(mine, F.lit(1))["change"]), (F.size(changes) == 1) & (F.size(mine) == 1)


def unchanged(events: Column) -> Column:
    return ~F.exists(events, lambda e: yes(e["event_type"] == "state_change"))


def assessed(checks: list[tuple[str, Column, str]], tags: list[Column], family: Column, task_type: Column, difficulty: Column, proof: Column | None = None) -> Column:
    """SQ-12: the assessment of ``checks`` (name, passed, reason where it isn't)."""
    rows = F.array(*[F.struct(F.lit(name).alias("name"), yes(passed).alias("passed")) for name, passed, _ in checks])
    reasons = F.array_compact(F.array(*[F.when(~yes(passed), F.lit(reason)) for _, passed, reason in checks]))
    return F.struct(
        F.forall(rows, lambda c: c["passed"]).alias("passed"), rows.alias("checks"), reasons.alias("reason_codes"), F.array(*tags).alias("coverage_tags"), family.alias("structural_key"),
        (proof if proof is not None else F.lit(None).cast("string")).alias("state_change_evidence"), task_type.alias("task_type"), difficulty.alias("difficulty"),
    )


def by_route(prefix: str, route: Column, *special: tuple[Column, str]) -> Column:
    """``{prefix}.verified`` for the verify route, then ``special`` endings, else the route."""
    out = F.concat(F.lit(f"{prefix}."), route)
    for condition, ending in reversed(special):
        out = F.when(condition, F.lit(f"{prefix}.{ending}")).otherwise(out)
    return F.when(route == "verify", F.lit(f"{prefix}.verified")).otherwise(out)


def assess_contacts(episodes: DataFrame) -> DataFrame:
    """SQ-1, SQ-2: ``assessment`` of contact episodes: action (lookup_email or record_followup), route, note_constraint, exact_note, target, expected_email."""
    events, route, target, email = F.col("__events"), F.col("route"), F.col("target"), F.col("expected_email")
    seen = lambda e: is_event("observation", "lookup_contact")(e) & is_record(e["observation"], name=target, email=email)
    listed = lambda e: is_event("observation", "list_contacts")(e) & F.array_contains(F.from_json(e["observation"]["contacts"], "array<string>"), target)
    stale = lambda e: is_event("action", "lookup_contact")(e) & is_record(e["arguments"], name=F.concat(target, F.lit(" (stale)")))
    failure = lambda e: is_event("error", "lookup_contact")(e) & (e["error_code"] == "contact_not_found")
    looked_up = F.col("__found")
    change, only = single_change(events, "record_followup")
    note = change["note"]
    effect = (change["name"] == target) & note.isNotNull() & F.when(F.col("note_constraint") == "exact", note == F.col("exact_note")).otherwise(note_allowed(note))
    saved = (route != "verify") | F.exists(events, lambda e: yes(is_event("observation", "get_followup")(e) & (e["observation"]["name"] == target) & e["observation"]["note"].eqNullSafe(note)))
    reading = assessed(
        [
            ("requested_lookup_observed", looked_up, "requested_lookup_not_observed"), ("no_unintended_state_changes", unchanged(events), "unintended_state_change"),
            ("final_response_grounded", says(target) & says(email), "final_response_not_grounded"),
        ],
        [F.lit("lookup"), route], F.concat(F.lit("contacts.lookup."), route), F.col("action"), route,
    )
    writing = assessed(
        [
            ("lookup_condition_observed", looked_up, "lookup_condition_not_observed"), ("authorized_mutation", F.col("mutation_authorization") == "authorized", "mutation_not_authorized"),
            ("requested_followup_recorded", effect, "requested_followup_not_recorded"), ("no_unintended_state_changes", only, "unintended_state_change"),
            ("saved_followup_observed", saved, "saved_followup_not_observed"), ("final_response_grounded", says(target) & says(note), "final_response_not_grounded"),
        ],
        [F.lit("followup"), route, F.col("note_constraint")], by_route("contacts.followup", route), F.col("action"), route,
        F.concat(F.lit("followup:"), F.replace(casefold(target), F.lit(" "), F.lit("_"))),
    )
    at = read(episodes, __found=lambda e: route_completed(e, route, seen, listed, stale, failure))
    return at.withColumn("assessment", F.when(F.col("action") == "record_followup", writing).otherwise(reading)).drop(*MADE)


def message_record() -> Column:
    return record(message_id=F.col("message_id"), sender=F.col("sender"), body=F.col("body"))


def assess_messages(episodes: DataFrame) -> DataFrame:
    """SQ-3 to SQ-5, SQ-13: ``assessment`` of message episodes: action, route, reply_constraint, exact_reply, reminder_text, remind_at, message_id, sender, body, query."""
    events, route, query, sender = F.col("__events"), F.col("route"), F.col("query"), F.col("sender")
    seen = lambda e: is_event("observation", "search_messages")(e) & is_record(e["observation"], message_id=F.col("message_id").cast("string"), sender=F.col("sender"), body=F.col("body"))
    listed = lambda e: is_event("observation", "list_message_senders")(e) & F.array_contains(F.from_json(e["observation"]["senders"], "array<string>"), sender)
    stale = lambda e: is_event("action", "search_messages")(e) & is_record(e["arguments"], query=F.concat(query, F.lit(" (stale)")))
    failure = lambda e: is_event("error", "search_messages")(e) & (e["error_code"] == "message_not_found")
    found = F.col("__found")
    named = says(sender) & says(query)
    proof = canonical({"message_id": F.col("message_id"), "sender": sender, "body": F.col("body")})

    def changing(kind: str, tool: str, read: str, effect: Column, grounded: Column, tags: list[Column], family: Column) -> Column:
        change, only = single_change(events, tool)
        saved = (route != "verify") | F.exists(events, lambda e: yes(is_event("observation", read)(e) & same_map(e["observation"], change)))
        return assessed(
            [
                ("message_condition_observed", found, "message_condition_not_observed"), ("authorized_mutation", F.col("mutation_authorization") == "authorized", "mutation_not_authorized"),
                (f"requested_{kind}_recorded", effect, f"requested_{kind}_not_recorded"), ("no_unintended_state_changes", only, "unintended_state_change"),
                (f"saved_{kind}_observed", saved, f"saved_{kind}_not_observed"), ("final_response_grounded", grounded, "final_response_not_grounded"),
            ],
            tags, family, F.col("action"), route, F.when(yes(effect) & found, evidence(kind, proof)),
        )

    change, _ = single_change(events, "create_reminder")
    text, time = F.coalesce("reminder_text", F.lit("")), F.coalesce("remind_at", F.lit(""))
    reminder = changing("reminder", "create_reminder", "get_reminder", is_record(change, message_id=F.col("message_id").cast("string"), reminder_text=text, remind_at=time), named & says(text) & says(time), [F.lit("reminder"), route], by_route("mobile_messages.reminder", route))
    change, _ = single_change(events, "create_draft_reply")
    reply, exact = change["content"], F.col("reply_constraint") == "exact"
    effect = (change["message_id"] == F.col("message_id")) & reply.isNotNull() & F.when(exact, reply == F.col("exact_reply")).otherwise(reply_allowed(reply))
    draft = changing("draft", "create_draft_reply", "get_draft_reply", effect, named & (reply.isNull() | says(reply)), [F.lit("draft"), route, F.col("reply_constraint")], by_route("mobile_messages.draft", route, (exact, "exact")))
    search = assessed(
        [("requested_message_observed", found, "requested_message_not_observed"), ("no_unintended_state_changes", unchanged(events), "unintended_state_change"), ("final_response_grounded", named, "final_response_not_grounded")],
        [F.lit("search"), route], F.concat(F.lit("mobile_messages.search."), route), F.col("action"), route,
    )
    at = read(episodes, __found=lambda e: route_completed(e, route, seen, listed, stale, failure))
    return at.withColumn("assessment", F.when(F.col("action") == "create_reminder", reminder).when(F.col("action") == "create_draft_reply", draft).otherwise(search)).drop(*MADE)


def created_id(kind: str, parent: Column, text: Column) -> Column:
    """1.5: the id of a task or comment that an episode creates."""
    return F.concat(F.lit(f"workspace-{kind}-"), F.substring(sha(canonical_array(parent, text)), 1, 24))


def assess_workspace(episodes: DataFrame) -> DataFrame:
    """SQ-6 to SQ-9, SQ-13: ``assessment`` of workspace episodes: action, route, task_constraint, comment_constraint, title, priority, due_label, exact_comment, missing_query, missing_kind, item_id, kind, query, summary, project_id."""
    events, route, query, kind, item = F.col("__events"), F.col("route"), F.col("query"), F.col("kind"), F.col("item_id")
    seen = lambda e: is_event("observation", "search_workspace_items")(e) & is_record(e["observation"], item_id=item, kind=kind, summary=F.col("summary"))
    listed = is_event("observation", "list_workspace_projects")
    asked = is_event("action", "search_workspace_items")
    failure = lambda e: is_event("error", "search_workspace_items")(e) & (e["error_code"] == "item_not_found")
    stale = lambda e: asked(e) & is_record(e["arguments"], query=F.concat(query, F.lit(" (stale)")), kind=kind)
    found = F.col("__found")
    proof = canonical({"item_id": item, "kind": kind, "project_id": F.col("project_id"), "query": query, "summary": F.col("summary")})

    def changing(name: str, tool: str, read: str, condition: str, verb: str, effect: Column, grounded: Column, tag: str, constraint: Column) -> Column:
        change, only = single_change(events, tool)
        saved = (route != "verify") | F.exists(events, lambda e: yes(is_event("observation", read)(e) & same_map(e["observation"], change)))
        return assessed(
            [
                (f"{condition}_condition_observed", found, f"{condition}_condition_not_observed"), ("authorized_mutation", F.col("mutation_authorization") == "authorized", "mutation_not_authorized"),
                (f"requested_{name}_{verb}", effect, f"requested_{name}_not_{verb}"), ("no_unintended_state_changes", only, "unintended_state_change"),
                (f"saved_{name}_observed", saved, f"saved_{name}_not_observed"), ("final_response_grounded", grounded, "final_response_not_grounded"),
            ],
            [F.lit(tag), route, constraint], by_route(f"workspace_tasks.{name}", route), F.col("action"), route, F.when(yes(effect) & found, evidence(name, proof)),
        )

    change, _ = single_change(events, "create_workspace_task")
    title = change["title"]
    task_id = created_id("task", item, title)
    allowed = F.when(F.col("task_constraint") == "exact", title == F.col("title")).otherwise(title_allowed(title))
    effect = title.isNotNull() & (change["task_id"] == task_id) & (change["project_id"] == item) & (change["priority"] == F.col("priority")) & (change["due_label"] == F.col("due_label")) & allowed
    grounded = says(query) & says(title) & says(F.col("priority")) & says(F.col("due_label")) & title.isNotNull() & says(task_id)
    task = changing("task", "create_workspace_task", "get_workspace_task", "project", "created", effect, grounded, "task_creation", F.col("task_constraint"))
    change, _ = single_change(events, "add_workspace_comment")
    text = change["comment"]
    allowed = F.when(F.col("comment_constraint") == "exact", text == F.col("exact_comment")).otherwise(comment_allowed(text))
    effect = (change["task_id"] == item) & text.isNotNull() & (change["comment_id"] == created_id("comment", item, text)) & allowed
    comment = changing("comment", "add_workspace_comment", "get_workspace_comment", "task", "added", effect, says(query) & says(text), "comment_addition", F.col("comment_constraint"))
    absent = let(first_place(events, lambda e: asked(e) & is_record(e["arguments"], query=F.col("missing_query"), kind=F.col("missing_kind"))), lambda k: first_place(events, failure, k)).isNotNull()
    said = F.lit(False)
    for phrase in MISSING:
        said = said | says(F.lit(phrase))
    looking = lambda check, reason, passed, good, tags, ending: assessed(
        [(check, passed, reason), ("no_unintended_state_changes", unchanged(events), "unintended_state_change"), ("final_response_grounded", good, "final_response_not_grounded")], tags, ending, F.col("action"), route
    )
    missing = looking("missing_item_observed", "missing_item_not_observed", absent, says(F.col("missing_query")) & says(F.col("missing_kind")) & said, [F.lit("missing_item_safe_failure")], F.lit("workspace_tasks.search.missing"))
    search = looking("requested_item_observed", "requested_item_not_observed", found, says(query) & says(kind), [F.lit("item_search"), route], F.concat(F.lit("workspace_tasks.search."), route))
    at = read(episodes, __found=lambda e: item.isNotNull() & route_completed(e, route, seen, listed, stale, failure, recovery_by_directory=False))
    at = at.withColumn("assessment", F.when(F.col("action") == "create_workspace_task", task).when(F.col("action") == "add_workspace_comment", comment).when(route == "missing", missing).otherwise(search))
    return at.drop(*MADE)


def or_incomplete(episodes: DataFrame, terminal: str = "terminal_reason") -> DataFrame:
    """SQ-14, PRD-6, HP-23: an episode that ended early has the incomplete assessment, with its reason."""
    kind = episodes.schema["assessment"].dataType
    early = F.struct(
        F.lit(False).alias("passed"), F.array().cast(kind["checks"].dataType).alias("checks"), F.array(F.col(terminal)).alias("reason_codes"), F.array().cast("array<string>").alias("coverage_tags"), F.lit("incomplete").alias("structural_key"),
        F.lit(None).cast("string").alias("state_change_evidence"), F.lit(None).cast("string").alias("task_type"), F.lit(None).cast("string").alias("difficulty"),
    )
    return episodes.withColumn("assessment", F.when(F.col(terminal).isNotNull(), early).otherwise(F.col("assessment")))
