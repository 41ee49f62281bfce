"""Compilation reasons in their order of precedence."""

from __future__ import annotations

import json

from quillon.operators.compilation import compile_messages, compile_workspace

SCHEMA = "id int, content string, known boolean, unique boolean, applicable boolean, action string, route string, rule string, expected map<string,string>"


def reasons(spark, compiled, expected, rule, cases):
    rows = []
    for k, (change, flags, _) in enumerate(cases):
        content = change if isinstance(change, str) else json.dumps({k: v for k, v in (expected | change).items() if v is not None})
        known, unique, applicable = flags
        rows.append((k, content, known, unique, applicable, expected["action"], expected["route"], rule, expected))
    got = {r["id"]: r["reason"] for r in compiled(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k] for k in range(len(cases))] == [reason for _, _, reason in cases]


FINE = (True, True, True)


def test_messages(spark):
    reminder = {"action": "create_reminder", "condition": "after_message_match", "message_query": "invoice", "route": "direct", "reminder_text": "Review the invoice.", "remind_at": "t"}
    reasons(spark, compile_messages, reminder, None, [
        ({}, FINE, None), ({}, (False, True, True), "unsupported_task_slot"), ({}, (True, False, False), "unresolved_target_ambiguity"), ({}, (True, True, False), "unsupported_task_slot"), ("never do it", FINE, "negated_action"), ("so", FINE, "proposal_not_json"),
        ("[1]", FINE, "proposal_not_object"), ({"action": None}, FINE, "unsupported_requested_action"), ({"action": "do-not-create"}, FINE, "negated_action"), ({"message_id": "m"}, FINE, "unsupported_private_exact_target"), ({"action": "x"}, FINE, "unsupported_requested_action"),
        ({"route": "verify"}, FINE, "uncheckable_condition"), ({"message_query": "x"}, FINE, "wrong_message_binding"), ({"condition": None}, FINE, "missing_mutation_authority"), ({"condition": "x"}, FINE, "uncheckable_condition"),
        ({"remind_at": None}, FINE, "missing_mutation_argument"), ({"remind_at": "x"}, FINE, "unauthorized_reminder_argument"), ({"more": "x"}, FINE, "unsupported_requested_action"),
    ])
    draft = {"action": "create_draft_reply", "condition": "after_message_match", "message_query": "invoice", "route": "direct", "reply_constraint": "exact", "reply": "Thanks, I will."}
    reasons(spark, compile_messages, draft, "exact", [({}, FINE, None), ({"reply": "Hello there"}, FINE, None), ({"reply": "rude"}, FINE, "unsupported_reply"), ({"reply_constraint": "open"}, FINE, "unsupported_reply")])
    search = {"action": "search_messages", "query": "5", "route": "direct"}
    reasons(spark, compile_messages, search, None, [
        ({}, FINE, None), ({"query": "x"}, FINE, "unsupported_requested_action"), ({"query": 5}, FINE, "unsupported_requested_action"), ({"query": {"a": ["5"]}}, FINE, "unsupported_requested_action"), ({"negated": True}, FINE, "negated_action"),
        ({"negated": "true"}, FINE, "unsupported_requested_action"), ('{"query":"x","action":"search_messages","route":"direct","query":"5"}', FINE, None), ('{"action":1,"action":"search_messages","route":"direct","query":"5"}', FINE, None),
    ])
    reasons(spark, compile_messages, reminder | {"remind_at": "5"}, None, [({"remind_at": 5}, FINE, "missing_mutation_argument"), ({"message_query": ["invoice"]}, FINE, "wrong_message_binding")])


def test_workspace(spark):
    task = {"action": "create_workspace_task", "condition": "after_item_match", "due_label": "d", "priority": "p", "project_kind": "project", "project_query": "q", "route": "direct", "title": "Prepare the plan"}
    reasons(spark, compile_workspace, task, "exact", [
        ({}, FINE, None), ({"item_id": "x"}, FINE, "unsupported_private_exact_target"), ({"action": "x"}, FINE, "unsupported_requested_action"), ({"project_kind": "task"}, FINE, "wrong_item_binding"), ({"priority": None}, FINE, "missing_mutation_argument"),
        ({"due_label": "x"}, FINE, "unauthorized_task_argument"), ({"title": None}, FINE, "missing_mutation_argument"), ({"title": "x"}, FINE, "unauthorized_task_argument"), ({"more": "x"}, FINE, "unsupported_requested_action"),
    ])
    reasons(spark, compile_workspace, task, "open", [({"task_constraint": "open"}, FINE, "unsupported_task_title"), ({"task_constraint": True, "title": None}, FINE, "unsupported_task_title")])
    comment = {"action": "add_workspace_comment", "comment_constraint": "open", "condition": "after_item_match", "route": "direct", "task_kind": "task", "task_query": "q"}
    reasons(spark, compile_workspace, comment, "open", [({}, FINE, None), ({"comment": "status: x"}, FINE, "unsupported_comment"), ({"comment_constraint": "exact"}, FINE, "unsupported_comment"), ({"task_query": "x"}, FINE, "wrong_item_binding")])


def test_restored_cases_of_messages_and_workspace(spark):
    """A private case is one that a task makes, under the key that it has."""
    import hashlib

    from quillon.operators import cases

    text = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"))
    key = lambda domain, x: f"{domain}:semantic:sha256:{hashlib.sha256(text(x).encode()).hexdigest()}"

    def judged(domain, restore, base, changes):
        rows = [(k, text(base | c) if isinstance(c, dict) else c, key(domain, base | c) if isinstance(c, dict) else "x") for k, (c, _) in enumerate(changes)]
        got = {r["k"]: r["valid"] for r in restore(spark.createDataFrame(rows, "k int, private_case string, semantic_key string")).collect()}
        assert [got[k] for k in range(len(changes))] == [v for _, v in changes]

    message = {"action": "create_draft_reply", "body": "b", "exact_reply": "Thanks, noted.", "message_id": "m", "remind_at": None, "reminder_text": None, "reply_constraint": "exact", "route": "direct", "sender": "s"}
    reminder = {"action": "create_reminder", "exact_reply": None, "reply_constraint": "none", "remind_at": "t", "reminder_text": "r"}
    judged("mobile_messages", cases.restored_messages, message, [
        ({}, True), ({"exact_reply": None}, False), ({"exact_reply": "No."}, False), ({"reply_constraint": "open"}, False), ({"reply_constraint": "open", "exact_reply": None}, True), ({"remind_at": "t"}, False), (reminder, True), (reminder | {"remind_at": None}, False), ({"body": 5}, False), ({"route": "nowhere"}, False),
        ({"remind_at": 5}, False), ({"action": "search_messages", "reply_constraint": "none", "exact_reply": None}, True), ("[]", False), ("{}", False), (None, False),
    ])
    item = {"item_id": "p", "kind": "project", "project_id": None, "query": "plan", "summary": "Plan"}
    task = {"action": "create_workspace_task", "comment_constraint": "none", "due_label": "next_week", "exact_comment": None, "missing_kind": None, "missing_query": None, "priority": "high", "route": "direct", "target": item, "task_constraint": "exact", "title": "Prepare Plan retrospective"}
    missing = {"action": "search_workspace_items", "due_label": None, "missing_kind": "document", "missing_query": "archived roadmap", "priority": None, "route": "missing", "target": None, "task_constraint": "none", "title": None}
    judged("workspace_tasks", cases.restored_workspace, task, [
        ({}, True), ({"title": "Prepare it"}, False), ({"priority": "low"}, False), ({"target": item | {"kind": "task"}}, False), ({"target": None}, False), ({"target": item | {"project_id": 5}}, False), ({"missing_kind": "document"}, False), ({"due_label": 1}, False), (missing, True), (missing | {"missing_query": None}, False),
        (missing | {"target": item}, False), ({"action": "add_workspace_comment"}, False), ("x", False),
    ])


def test_parsed_columns_are_made_once(spark):
    """A filter on a decision or a reason doesn't parse the text anew: whatever uses them, the plan parses it in one place (an array of it, used twice, and an object)."""
    from quillon.operators import decisions

    rows = spark.createDataFrame([("{}",)], "content string")
    plan = decisions.agent_decisions(rows).where("decision = 'tool_call'").select("tool_name", "arguments")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") <= 3
