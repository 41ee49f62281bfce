"""Compilation of message and workspace proposals: the first reason against each, or null (DM-4, PRD-14).

A proposal row has ``content`` (JSON text) and what its slot expects:
``known`` (whether the slot exists), ``unique`` (whether its selector does),
``action``, ``route``, ``expected`` (the payload the slot offers, a map) and
``rule`` (open, exact or null).  The reasons are one ordered CASE, so a batch of
proposals is one projection.  Values are compared with their types: a number or
a truth value is never the text that looks like it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import Payload, first_reason
from ..functions.text import negated_action, negated_text, reply_allowed

# Payload fields that would name a private target.
MESSAGE_PRIVATE = ("message_id", "target_message_id")
WORKSPACE_PRIVATE = ("item_id", "project_id", "task_id", "document_id", "comment_id", "target_item_id")


class _Payload(Payload):
    """Conditions over the parsed payload, in columns, and the one that the slot expects (a map of text in ``expected``)."""

    def __init__(self) -> None:
        super().__init__(None, *[F.col(n) for n in ("__p", "__p_fields", "__p_texts")])
        self.x = F.col("expected")

    def has_any(self, names: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a | b, [self.has(n) for n in names])

    def other(self, *names: str) -> Column:
        """Any of the fields isn't the text that is expected."""
        return reduce(lambda a, b: a | b, [~self.equals(n, F.try_element_at(self.x, F.lit(n))) for n in names])

    def fields_differ(self) -> Column:
        return ~self.keys().eqNullSafe(F.sort_array(F.map_keys(self.x)))

    def same(self) -> Column:
        """The same fields with the same texts: values of other types differ."""
        texts = F.forall(F.map_values(self.texts), lambda v: v.isNotNull())
        entries = lambda m: F.sort_array(F.map_entries(m))
        return F.coalesce(texts, F.lit(False)) & F.coalesce(entries(self.texts) == entries(self.x), F.lit(False))


def _compiled(proposals: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    parsed, _, names = Payload.read(proposals, F.col("content"))
    return parsed.withColumn("reason", first_reason(checks)).drop(*names)


def _opening(q: _Payload, private: tuple[str, ...]) -> list[tuple[Column, str]]:
    """The checks that both domains begin with, from the slot to the route."""
    action = q.text("action")
    return [
        (q.broken & F.coalesce(negated_text(F.col("content")), F.lit(False)), "negated_action"), (q.broken, "proposal_not_json"), (~q.object, "proposal_not_object"),
        (q.true("negated") | negated_action(action), "negated_action"), (q.has_any(private), "unsupported_private_exact_target"),
        (~action.eqNullSafe(F.col("action")), "unsupported_requested_action"), (~q.text("route").eqNullSafe(F.col("route")), "uncheckable_condition"),
    ]


def compile_messages(proposals: DataFrame) -> DataFrame:
    """``proposals`` with ``reason``: search_messages, create_reminder and create_draft_reply.  ``applicable`` tells whether the slot still applies."""
    q = _Payload()
    search, reminder, draft = (F.col("action") == a for a in ("search_messages", "create_reminder", "create_draft_reply"))
    exact = F.col("rule") == "exact"
    opening = _opening(q, MESSAGE_PRIVATE)
    # A draft's exact reply is any allowed one, so it is compared by its fields alone.
    checks = [
        (~F.col("known"), "unsupported_task_slot"), (~F.col("unique"), "unresolved_target_ambiguity"), (~F.col("applicable"), "unsupported_task_slot"), *opening[:3], (q.text("action").isNull(), "unsupported_requested_action"), *opening[3:],
        (search & ~q.same(), "unsupported_requested_action"), (~search & q.other("message_query"), "wrong_message_binding"), (~search & ~q.has("condition"), "missing_mutation_authority"), (~search & q.other("condition"), "uncheckable_condition"),
        (reminder & (q.text("reminder_text").isNull() | q.text("remind_at").isNull()), "missing_mutation_argument"), (reminder & q.other("reminder_text", "remind_at"), "unauthorized_reminder_argument"),
        (draft & q.other("reply_constraint"), "unsupported_reply"), (draft & exact & ~F.coalesce(reply_allowed(q.text("reply")), F.lit(False)), "unsupported_reply"), (draft & ~exact & q.has("reply"), "unsupported_reply"),
        (~search & q.fields_differ(), "unsupported_requested_action"),
    ]
    return _compiled(proposals, checks)


def compile_workspace(proposals: DataFrame) -> DataFrame:
    """``proposals`` with ``reason``: search_workspace_items, create_workspace_task and add_workspace_comment."""
    q = _Payload()
    search, task, comment = (F.col("action") == a for a in ("search_workspace_items", "create_workspace_task", "add_workspace_comment"))
    exact = F.col("rule") == "exact"
    checks = [
        (~F.col("known"), "unsupported_task_slot"), (~F.col("unique"), "unresolved_target_ambiguity"), *_opening(q, WORKSPACE_PRIVATE), (search & ~q.same(), "unsupported_requested_action"),
        (~search & ~q.has("condition"), "missing_mutation_authority"), (~search & q.other("condition"), "uncheckable_condition"), (task & q.other("project_query", "project_kind"), "wrong_item_binding"),
        (task & (q.text("priority").isNull() | q.text("due_label").isNull()), "missing_mutation_argument"), (task & q.other("priority", "due_label"), "unauthorized_task_argument"),
        (task & exact & q.text("title").isNull(), "missing_mutation_argument"), (task & exact & q.other("title"), "unauthorized_task_argument"), (task & ~exact & (~q.text("task_constraint").eqNullSafe(F.lit("open")) | q.has("title")), "unsupported_task_title"),
        (comment & q.other("task_query", "task_kind"), "wrong_item_binding"), (comment & q.other("comment_constraint"), "unsupported_comment"), (comment & exact & q.other("comment"), "unauthorized_comment_argument"),
        (comment & ~exact & ~q.equals("comment", F.lit(None).cast("string")), "unsupported_comment"), (~search & q.fields_differ(), "unsupported_requested_action"),
    ]
    return _compiled(proposals, checks)
