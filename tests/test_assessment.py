"""Assessment of episodes by their events, domain by domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators.assessment import EVENTS, assess_contacts, assess_messages, assess_workspace, created_id, or_incomplete


def e(kind, tool=None, arguments=None, observation=None, change=None, content=None, error=None):
    return (kind, tool, arguments, observation, change, content, error)


def final(text):
    return e("final_response", content=text)


def judged(spark, assess, schema, rows):
    frame = spark.createDataFrame(rows, f"id int, {schema}, mutation_authorization string, events {EVENTS}")
    return {r["id"]: r["assessment"] for r in assess(frame).collect()}


CONTACT = "action string, route string, note_constraint string, exact_note string, target string, expected_email string"


def test_contacts(spark):
    seen = e("observation", "lookup_contact", observation={"name": "Ann Lee", "email": "a@x"})
    listed = e("observation", "list_contacts", observation={"contacts": '["Ann Lee","Bob"]'})
    stale, failed = e("action", "lookup_contact", {"name": "Ann Lee (stale)"}), e("error", "lookup_contact", error="contact_not_found")
    change = e("state_change", "record_followup", change={"name": "Ann Lee", "note": "call back"})
    read = e("observation", "get_followup", observation={"name": "Ann Lee", "note": "call back"})
    look = lambda k, route, events: (k, "lookup_email", route, "none", None, "Ann Lee", "a@x", "not_applicable", events)
    write = lambda k, route, constraint, note, events, status="authorized": (k, "record_followup", route, constraint, note, "Ann Lee", "a@x", status, events)
    got = judged(spark, assess_contacts, CONTACT, [
        look(1, "direct", [seen, final("ANN LEE has A@X")]), look(2, "direct", [seen, final("ann lee a@x"), final("nothing")]), look(3, "directory", [seen, listed, final("Ann Lee a@x")]), look(4, "directory", [listed, seen, final("Ann Lee a@x")]),
        look(5, "recovery", [stale, failed, listed, seen, final("Ann Lee a@x")]), look(6, "recovery", [failed, stale, listed, seen, final("Ann Lee a@x")]), look(7, "direct", None),
        write(8, "direct", "open", None, [seen, change, final("call back to Ann Lee")]), write(9, "verify", "open", None, [seen, change, read, final("Ann Lee: call back")]), write(10, "verify", "open", None, [seen, change, change, final("Ann Lee: call back")]),
        write(11, "direct", "exact", "other", [seen, change, final("Ann Lee: call back")]), write(12, "direct", "open", None, [change, final("Ann Lee: call back")], "rejected"),
    ])
    reasons = {k: list(a["reason_codes"]) for k, a in got.items()}
    assert all(reasons[k] == [] and got[k]["passed"] for k in (1, 4, 5, 8, 9))
    assert reasons[2] == ["final_response_not_grounded"] and reasons[3] == reasons[6] == ["requested_lookup_not_observed"]
    assert reasons[7] == ["requested_lookup_not_observed", "final_response_not_grounded"]
    assert reasons[10] == ["requested_followup_not_recorded", "unintended_state_change", "saved_followup_not_observed", "final_response_not_grounded"]
    assert reasons[11] == ["requested_followup_not_recorded"] and reasons[12] == ["lookup_condition_not_observed", "mutation_not_authorized"]
    assert got[9]["structural_key"] == "contacts.followup.verified" and got[5]["structural_key"] == "contacts.lookup.recovery"
    assert list(got[8]["coverage_tags"]) == ["followup", "direct", "open"] and got[8]["state_change_evidence"] == "followup:ann_lee" and got[1]["state_change_evidence"] is None
    assert [c["name"] for c in got[8]["checks"]][-1] == "final_response_grounded" and got[8]["difficulty"] == "direct"


MESSAGE = "action string, route string, reply_constraint string, exact_reply string, reminder_text string, remind_at string, message_id string, sender string, body string, query string"


def test_messages(spark):
    base = ("m1", "Kim", "The invoice is here", "invoice")
    seen = e("observation", "search_messages", observation={"message_id": "m1", "sender": "Kim", "body": "The invoice is here"})
    change = e("state_change", "create_reminder", change={"message_id": "m1", "reminder_text": "Review the invoice.", "remind_at": "t"})
    draft = e("state_change", "create_draft_reply", change={"message_id": "m1", "content": "Thanks, will do"})
    remind = lambda k, route, events: (k, "create_reminder", route, "none", None, "Review the invoice.", "t", *base, "authorized", events)
    reply = lambda k, constraint, exact, events: (k, "create_draft_reply", "direct", constraint, exact, None, None, *base, "authorized", events)
    said = final("Kim: invoice, Review the invoice. at t; thanks, will do")
    got = judged(spark, assess_messages, MESSAGE, [
        (1, "search_messages", "direct", "none", None, None, None, *base, "not_applicable", [seen, final("kim INVOICE")]), remind(2, "direct", [seen, change, said]), remind(3, "verify", [seen, change, said]),
        reply(4, "open", None, [seen, draft, said]), reply(5, "exact", "Thanks a lot", [seen, draft, said]), reply(6, "open", None, [seen, said]),
    ])
    reasons = {k: list(a["reason_codes"]) for k, a in got.items()}
    assert reasons[1] == reasons[2] == reasons[4] == [] and reasons[3] == ["saved_reminder_not_observed"] and reasons[5] == ["requested_draft_not_recorded"]
    assert reasons[6] == ["requested_draft_not_recorded", "unintended_state_change"]
    assert got[5]["structural_key"] == "mobile_messages.draft.exact" and got[2]["state_change_evidence"].startswith("reminder:sha256:") and got[5]["state_change_evidence"] is None


WORKSPACE = "action string, route string, task_constraint string, comment_constraint string, title string, priority string, due_label string, exact_comment string, missing_query string, missing_kind string, item_id string, kind string, query string, summary string, project_id string"


def test_workspace(spark):
    task_id = spark.range(1).select(created_id("task", F.lit("p1"), F.lit("Prepare Alpha review"))).first()[0]
    seen = e("observation", "search_workspace_items", observation={"item_id": "p1", "kind": "project", "summary": "Alpha"})
    asked, lost = e("action", "search_workspace_items", {"query": "archived roadmap", "kind": "document"}), e("error", "search_workspace_items", error="item_not_found")
    change = e("state_change", "create_workspace_task", change={"task_id": task_id, "project_id": "p1", "title": "Prepare Alpha review", "priority": "high", "due_label": "later"})
    gone = lambda k, events: (k, "search_workspace_items", "missing", "none", "none", None, None, None, None, "archived roadmap", "document", None, None, None, None, None, "not_applicable", events)
    task = lambda k, priority, events: (k, "create_workspace_task", "direct", "open", "none", None, priority, "later", None, None, None, "p1", "project", "alpha", "Alpha", None, "authorized", events)
    said = final(f"alpha: Prepare Alpha review, high, later, {task_id}")
    got = judged(spark, assess_workspace, WORKSPACE, [gone(1, [asked, lost, final("The document archived roadmap was Not Found.")]), gone(2, [lost, asked, final("archived roadmap document")]), task(3, "high", [seen, change, said]), task(4, "low", [seen, change, said])])
    assert list(got[1]["reason_codes"]) == [] and list(got[2]["reason_codes"]) == ["missing_item_not_observed", "final_response_not_grounded"]
    assert list(got[3]["reason_codes"]) == [] and list(got[4]["reason_codes"]) == ["requested_task_not_created", "final_response_not_grounded"]
    assert got[3]["structural_key"] == "workspace_tasks.task.direct" and list(got[1]["coverage_tags"]) == ["missing_item_safe_failure"]


def test_an_early_end_is_incomplete(spark):
    rows = [(k, "lookup_email", "direct", "none", None, "Ann", "a@x", "not_applicable", [], reason) for k, reason in ((1, "step_budget_exhausted"), (2, None))]
    frame = assess_contacts(spark.createDataFrame(rows, f"id int, {CONTACT}, mutation_authorization string, events {EVENTS}, terminal_reason string"))
    got = {r["id"]: r["assessment"] for r in or_incomplete(frame).collect()}
    assert got[1]["structural_key"] == "incomplete" and list(got[1]["reason_codes"]) == ["step_budget_exhausted"] and got[2]["structural_key"] == "contacts.lookup.direct"
