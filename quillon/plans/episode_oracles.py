"""SQL of the domain queries; DuckDB's own JSON and regex functions stand for the operators' expressions."""

from __future__ import annotations


def reasons(*checks: tuple[str, str]) -> str:
    """The reasons of the conditions that don't hold, joined."""
    return "concat_ws(',', " + ", ".join(f"case when not coalesce({condition}, false) then '{reason}' end" for condition, reason in checks) + ")"


def holds(value: str) -> str:
    return f"coalesce(contains(lower(final), lower({value})), false)"


def judged(keys: str, family: str, branches: list[tuple[str, str]]) -> str:
    """Columns of an assessment: for each branch (condition, reasons) the reasons; no reason is a pass."""
    case = "case " + " ".join(f"when {c} then {r}" for c, r in branches) + " end"
    return f"select {keys}, reasons = '' as passed, reasons, structural_key, tags, evidence from (select *, {case} as reasons, {family} as structural_key from b)"


_ROUTE = "(t is not null and case when route in ('direct', 'verify') then true when route = 'directory' then coalesce(d < t, false) when route = 'recovery' then coalesce({recovery}, false) else false end)"
_BY_DIRECTORY, _DIRECT = _ROUTE.format(recovery="st < f and f < d and d < t"), _ROUTE.format(recovery="st < f and f < t")
_NOTE = "({x} = trim({x}) and length({x}) between 3 and 160)"

_CONTACTS = f"""with b0 as (select c.contact_key, c.position, any_value(c.action) as action, any_value(c.route) as route, any_value(c.note_constraint) as note_constraint, any_value(c.exact_note) as exact_note, any_value(c.target) as target,
    any_value(c.expected_email) as email, any_value(c.mutation_authorization) as auth,
    min(idx) filter (event_type = 'observation' and tool_name = 'lookup_contact' and observation = '{{"name":"' || target || '","email":"' || expected_email || '"}}') as t,
    min(idx) filter (tool_name = 'list_contacts' and contains(observation, '"' || target || '"')) as d, min(idx) filter (event_type = 'action' and arguments = '{{"name":"' || target || ' (stale)"}}') as st, min(idx) filter (error_code = 'contact_not_found') as f,
    count(*) filter (event_type = 'state_change') as changes, count(*) filter (event_type = 'state_change' and tool_name = 'record_followup') as mine, max(json_extract_string(change, '$.note')) filter (tool_name = 'record_followup') as note,
    max(json_extract_string(observation, '$.note')) filter (tool_name = 'get_followup') as read, max(content) as final from contact_cases_v c join contact_events_v e using (contact_key, position) group by c.contact_key, c.position),
b as (select *, {_BY_DIRECTORY} as found, case when action = 'lookup_email' then 'lookup,' || route else 'followup,' || route || ',' || note_constraint end as tags,
    case when action = 'record_followup' then 'followup:' || replace(lower(target), ' ', '_') end as evidence from b0)
{judged("contact_key, position", "case when action = 'lookup_email' then 'contacts.lookup.' || route when route = 'verify' then 'contacts.followup.verified' else 'contacts.followup.' || route end", [
    ("action = 'lookup_email'", reasons(("found", "requested_lookup_not_observed"), ("changes = 0", "unintended_state_change"), (f"{holds('target')} and {holds('email')}", "final_response_not_grounded"))),
    ("true", reasons(("found", "lookup_condition_not_observed"), ("auth = 'authorized'", "mutation_not_authorized"), (f"mine = 1 and case when note_constraint = 'exact' then note = exact_note else {_NOTE.format(x='note')} end", "requested_followup_not_recorded"), ("changes = 1 and mine = 1", "unintended_state_change"),
        ("route <> 'verify' or (read is not null and mine = 1 and read = note)", "saved_followup_not_observed"), (f"{holds('target')} and mine = 1 and {holds('note')}", "final_response_not_grounded"))),
])}"""

_REPLY = "({x} = trim({x}) and length({x}) between 3 and 240 and regexp_matches(lower({x}), '^(thanks|thank you|hello|hi )'))"
_MESSAGES = f"""with b0 as (select c.message_id, c.position, any_value(c.action) as action, any_value(c.route) as route, any_value(c.reply_constraint) as rc, any_value(c.exact_reply) as exact_reply, any_value(c.sender) as sender, any_value(c.body) as body,
    any_value(c.reminder_text) as rt, any_value(c.remind_at) as ra, any_value(c.mutation_authorization) as auth,
    min(idx) filter (event_type = 'observation' and tool_name = 'search_messages' and observation = '{{"message_id":"' || message_id || '","sender":"' || sender || '","body":"' || body || '"}}') as t,
    min(idx) filter (tool_name = 'list_message_senders' and contains(observation, '"' || sender || '"')) as d, min(idx) filter (event_type = 'action' and arguments = '{{"query":"' || body || ' (stale)"}}') as st, min(idx) filter (error_code = 'message_not_found') as f,
    count(*) filter (event_type = 'state_change') as changes, count(*) filter (event_type = 'state_change' and tool_name = c.action) as mine, max(change) filter (tool_name = c.action) as change, max(observation) filter (tool_name in ('get_reminder', 'get_draft_reply')) as read,
    max(content) as final from message_cases_v c join message_events_v e using (message_id, position) group by c.message_id, c.position),
b1 as (select *, {_BY_DIRECTORY} as found, json_extract_string(change, '$.content') as reply, case when action = 'create_reminder' then 'reminder' else 'draft' end as thing from b0),
b2 as (select *, case when action = 'create_reminder' then change = '{{"message_id":"' || message_id || '","reminder_text":"' || rt || '","remind_at":"' || ra || '"}}' else mine = 1 and case when rc = 'exact' then reply = exact_reply else {_REPLY.format(x='reply')} end end as effect from b1),
b as (select *, case action when 'search_messages' then 'search,' || route when 'create_reminder' then 'reminder,' || route else 'draft,' || route || ',' || rc end as tags,
    case when action <> 'search_messages' and coalesce(effect, false) and found then thing || ':sha256:' || sha256('{{"body":"' || body || '","message_id":"' || message_id || '","sender":"' || sender || '"}}') end as evidence from b2)
{judged("message_id, position", "case when action = 'search_messages' then 'mobile_messages.search.' || route when route = 'verify' then 'mobile_messages.' || thing || '.verified' when rc = 'exact' then 'mobile_messages.draft.exact' else 'mobile_messages.' || thing || '.' || route end", [
    ("action = 'search_messages'", reasons(("found", "requested_message_not_observed"), ("changes = 0", "unintended_state_change"), (f"{holds('sender')} and {holds('body')}", "final_response_not_grounded"))),
    *[(f"action = '{a}'", reasons(("found", "message_condition_not_observed"), ("auth = 'authorized'", "mutation_not_authorized"), ("effect", f"requested_{k}_not_recorded"), ("changes = 1 and mine = 1", "unintended_state_change"), ("route <> 'verify' or read = change", f"saved_{k}_not_observed"),
        (f"{holds('sender')} and {holds('body')} and {g}", "final_response_not_grounded"))) for a, k, g in (("create_reminder", "reminder", f"{holds('rt')} and {holds('ra')}"), ("create_draft_reply", "draft", f"(reply is null or {holds('reply')})"))],
])}"""

_TITLE = "(title = trim(title) and length(title) between 12 and 120 and regexp_matches(lower(title), '^(prepare|review|create) '))"
_COMMENT = "(comment = trim(comment) and length(comment) between 12 and 240 and starts_with(lower(comment), 'status:'))"
_WORKSPACE = f"""with b0 as (select c.item_id, c.position, any_value(c.action) as action, any_value(c.route) as route, any_value(c.task_constraint) as tc, any_value(c.comment_constraint) as cc, any_value(c.kind) as kind, any_value(c.query) as query, any_value(c.summary) as summary, any_value(c.project_id) as project_id,
    any_value(c.title) as wanted, any_value(c.exact_comment) as exact_comment, any_value(c.task_id) as task_id, any_value(c.new_title) as title0, any_value(c.mutation_authorization) as auth,
    min(idx) filter (event_type = 'observation' and tool_name = 'search_workspace_items' and observation = '{{"item_id":"' || item_id || '","kind":"' || kind || '","summary":"' || summary || '"}}') as t, min(idx) filter (tool_name = 'list_workspace_projects') as d,
    min(idx) filter (event_type = 'action' and arguments = case when c.route = 'missing' then '{{"query":"archived roadmap","kind":"document"}}' else '{{"query":"' || query || ' (stale)","kind":"' || kind || '"}}' end) as st, min(idx) filter (error_code = 'item_not_found') as f,
    count(*) filter (event_type = 'state_change') as changes, count(*) filter (event_type = 'state_change' and tool_name = c.action) as mine, max(change) filter (tool_name = c.action) as change, max(observation) filter (tool_name in ('get_workspace_task', 'get_workspace_comment')) as read,
    max(content) as final from workspace_texts_v c join workspace_events_v e using (item_id, position) group by c.item_id, c.position),
b1 as (select *, {_DIRECT} as found, json_extract_string(change, '$.title') as title, json_extract_string(change, '$.comment') as comment from b0),
b2 as (select *, mine = 1 and case when action = 'create_workspace_task' then json_extract_string(change, '$.priority') = 'high' and case when tc = 'exact' then title = wanted else {_TITLE} end else case when cc = 'exact' then comment = exact_comment else {_COMMENT} end end as effect from b1),
b as (select *, case when route = 'missing' then 'missing_item_safe_failure' when action = 'search_workspace_items' then 'item_search,' || route when action = 'create_workspace_task' then 'task_creation,' || route || ',' || tc else 'comment_addition,' || route || ',' || cc end as tags,
    case when action <> 'search_workspace_items' and coalesce(effect, false) and found then case when action = 'create_workspace_task' then 'task' else 'comment' end || ':sha256:' || sha256('{{"item_id":"' || item_id || '","kind":"' || kind || '","project_id":' || coalesce('"' || project_id || '"', 'null') || ',"query":"' || query || '","summary":"' || summary || '"}}') end as evidence from b2)
{judged("item_id, position", "case when action = 'search_workspace_items' then 'workspace_tasks.search.' || route else 'workspace_tasks.' || case when action = 'create_workspace_task' then 'task.' else 'comment.' end || case when route = 'verify' then 'verified' else route end end", [
    ("route = 'missing'", reasons(("st < f", "missing_item_not_observed"), ("changes = 0", "unintended_state_change"), (f"{holds(chr(39) + 'archived roadmap' + chr(39))} and {holds(chr(39) + 'document' + chr(39))} and regexp_matches(lower(final), 'not found|unavailable|no matching')", "final_response_not_grounded"))),
    ("action = 'search_workspace_items'", reasons(("found", "requested_item_not_observed"), ("changes = 0", "unintended_state_change"), (f"{holds('query')} and {holds('kind')}", "final_response_not_grounded"))),
    ("action = 'create_workspace_task'", reasons(("found", "project_condition_not_observed"), ("auth = 'authorized'", "mutation_not_authorized"), ("effect", "requested_task_not_created"), ("changes = 1 and mine = 1", "unintended_state_change"), ("route <> 'verify' or read = change", "saved_task_not_observed"),
        (f"{holds('query')} and mine = 1 and {holds('title')} and {holds(chr(39) + 'high' + chr(39))} and {holds(chr(39) + 'next_week' + chr(39))} and {holds('task_id')}", "final_response_not_grounded"))),
    ("true", reasons(("found", "task_condition_not_observed"), ("auth = 'authorized'", "mutation_not_authorized"), ("effect", "requested_comment_not_added"), ("changes = 1 and mine = 1", "unintended_state_change"), ("route <> 'verify' or read = change", "saved_comment_not_observed"),
        (f"{holds('query')} and mine = 1 and {holds('comment')}", "final_response_not_grounded"))),
])}"""

_LISTED = "(route not in ('directory', 'recovery') or v <> 2) and (route <> 'recovery' or v <> 1)"
# The errors of a change that isn't authorized.
_REFUSALS = "['mutation_not_authorized', 'mutation_condition_not_observed', 'unsupported_note', 'note_not_authorized', 'unintended_state_change', 'reminder_not_authorized', 'unsupported_reply', 'reply_not_authorized', 'task_not_authorized', 'unsupported_task_title', 'unsupported_comment', 'comment_not_authorized']"


def rollout(keys: str, source: str, calls: list[str], again: str) -> str:
    """An episode's results up to its end, from the result of every call that ``source`` would make (null: not made): a refused change, a second malformed decision, a failed request, a final response, or eight steps."""
    before = ["case when v in (9, 10) then 'malformed_agent_decision' end", "case when v = 10 then 'malformed_agent_decision' end", "case when v = 0 then 'invalid_tool_arguments' end"]
    after = ["case when v = 8 then 'unknown_tool' end", "case when v = 7 then 'provider_timeout' end", "case when v <> 11 then 'final_response' end", *[f"case when v = 11 then {again} end"] * 8]
    return f"""{source},
l as (select *, list_filter([{', '.join([*before, *calls, *after])}], lambda x: x is not null) as codes from r),
m as (select *, list_min(list_filter(range(1, len(codes) + 1), lambda k: list_contains({_REFUSALS}, codes[k]) or codes[k] in ('provider_timeout', 'final_response') or (k = 2 and codes[k] = 'malformed_agent_decision'))) as stop from l),
n as (select *, stop is null or stop > 8 + (v = 9)::int as spent from m),
o as (select *, case when spent then codes[1:8] || ['step_budget_exhausted'] else codes[1:stop] end as kept from n),
p as (select *, kept[len(kept)] as last from o)
select {keys}, array_to_string(kept, ',') as results, cast(len(list_filter(kept, lambda x: x not in ('malformed_agent_decision', 'provider_timeout', 'final_response', 'step_budget_exhausted'))) as bigint) as actions,
    case when list_contains({_REFUSALS}, last) then 'unauthorized_mutation' when last <> 'final_response' then last end as terminal_reason,
    case when list_contains({_REFUSALS}, last) then 'rejected' when list_contains(kept, 'state_change') then 'authorized' else 'not_applicable' end as mutation_authorization,
    v = 8 and last not in {_REFUSALS.replace('[', '(').replace(']', ')')} as unsafe from p"""


_CONTACT_ROLLOUT = rollout("contact_key, position", f"""with r as (select *, case when action <> 'record_followup' then 'unknown_tool' when not (v <> 3 and {_LISTED}) then 'mutation_condition_not_observed' when v = 5 then 'unsupported_note'
    when note_constraint = 'exact' and v = 6 then 'note_not_authorized' else 'state_change' end as r1 from contact_cases_v)""", [
    "case when route = 'recovery' and v <> 1 then 'contact_not_found' end", "case when route in ('directory', 'recovery') and v <> 2 then 'observation' end", "case when v <> 3 then 'observation' end",
    "case when action = 'record_followup' or v = 4 then r1 end", "case when v = 4 then case when r1 = 'state_change' then 'unintended_state_change' else r1 end end", "case when route = 'verify' then 'observation' else 'unknown_tool' end",
], "'observation'")
_MESSAGE_ROLLOUT = rollout("message_id, position", f"""with n0 as (select a.message_id, count(*) = 1 as once from notes_v a join notes_v b on contains(lower(b.body), lower(a.body)) group by a.message_id),
r as (select c.*, once, case when not (once and v <> 3 and {_LISTED}) then 'mutation_condition_not_observed' when action = 'create_reminder' and v = 5 then 'reminder_not_authorized' when action = 'create_draft_reply' and v = 5 then 'unsupported_reply'
    when reply_constraint = 'exact' and v = 6 then 'reply_not_authorized' else 'state_change' end as r1 from message_cases_v c join n0 using (message_id))""", [
    "case when route = 'recovery' and v <> 1 then 'message_not_found' end", "case when route in ('directory', 'recovery') and v <> 2 then 'observation' end", "case when v <> 3 then case when once then 'observation' else 'message_not_found' end end",
    "case when action <> 'search_messages' then r1 end", "case when v = 4 and action = 'create_reminder' then 'mutation_not_authorized' end", "case when action = 'create_reminder' and route = 'verify' then 'observation' else 'unknown_tool' end",
    "case when action = 'create_draft_reply' then case when route = 'verify' then 'observation' else 'unknown_tool' end end",
], "case when once then 'observation' else 'message_not_found' end")
_WORKSPACE_ROLLOUT = rollout("item_id, position", """with r as (select *, case when v = 3 or (route = 'recovery' and v = 1) then 'mutation_condition_not_observed' when action = 'create_workspace_task' and (v = 6 or (task_constraint = 'exact' and v = 5)) then 'task_not_authorized'
    when action = 'create_workspace_task' and (v = 5 or length('Prepare ' || summary || ' retrospective') not between 12 and 120) and task_constraint = 'open' then 'unsupported_task_title' when action = 'add_workspace_comment' and (v = 5) then 'unsupported_comment'
    when action = 'add_workspace_comment' and comment_constraint = 'exact' and v = 6 then 'comment_not_authorized' else 'state_change' end as r1 from workspace_cases_v where route <> 'missing')""", [
    "case when route = 'recovery' and v <> 1 then 'item_not_found' end", "case when route = 'directory' then case when action = 'search_workspace_items' then 'observation' else 'unknown_tool' end end", "case when v <> 3 then 'observation' end", "case when action <> 'search_workspace_items' then r1 end",
    "case when action = 'create_workspace_task' and v = 4 then 'unintended_state_change' end", "case when action = 'create_workspace_task' then case when route = 'verify' then 'observation' else 'unknown_tool' end end",
    "case when action = 'add_workspace_comment' then case when route = 'verify' then 'comment_not_found' else 'unknown_tool' end end",
], "'observation'")
_REPLAY = f"""with e as ({_CONTACT_ROLLOUT.replace('select contact_key, position,', 'select contact_key, position, v, r1, route,')}),
x as (select *, contact_key % 6 as k, terminal_reason is distinct from 'malformed_agent_decision' as acts, contains(results, 'observation') and not (route = 'directory' and v not in (3) and results = 'observation') as sees from e where v in (1, 2, 6, 8, 9, 10, 11)),
f as (select *, contact_key % 9 <> 0 as here, contact_key % 7 = 0 as lost, case k when 1 then acts when 2 then acts when 3 then acts else false end as drift, v = 6 as judged from x)
select contact_key, position, case when not here then 'not_executed' when lost then 'replay_failed' when drift and judged then 'observation_and_assessment_drift' when drift then 'observation_drift' when judged then 'assessment_drift' else 'aligned' end as status,
    here and (lost or drift) as observation_drift, here and (lost or judged) as assessment_drift from f"""

_CONTEXT = """'{"observable_history":[' || HISTORY || '],"remaining_step_budget":LEFT,"task":{"instruction":"' || (INSTRUCTION) || '","tools":' || tools || '}}'"""
_SHOWN = """'{' || concat_ws(',', '"arguments":' || arguments, '"change":' || change, '"content":"' || content || '"', '"error_code":"' || error_code || '"', '"event_type":"' || event_type || '"',
    '"observation":' || case when observation is not null then '{"email":"' || json_extract_string(observation, '$.email') || '","name":"' || json_extract_string(observation, '$.name') || '"}' end, '"tool_name":"' || tool_name || '"') || '}'"""


def contexts(instruction: str, tools: str) -> str:
    first = _CONTEXT.replace("HISTORY", "''").replace("LEFT", "12").replace("INSTRUCTION", f"replace({instruction}, '\"', '\\\"')")
    later = _CONTEXT.replace("HISTORY", "history").replace("LEFT", "10").replace("INSTRUCTION", f"replace({instruction}, '\"', '\\\"')")
    return f"""with h as (select contact_key, position, string_agg({_SHOWN}, ',' order by idx) as history from contact_events_v where tool_name = 'lookup_contact' or event_type = 'final_response' group by all), t as ({tools})
select contact_key, position, {first} as first, sha256({later}) as later from contact_cases_v join h using (contact_key, position) join t using (contact_key, position)"""


_ACTIVATION = """with e as (select *, case when judge_verdict = 'unavailable' then 'uncertain' else judge_verdict end as judge, cohort <> 0 as dev, human_verdict is not null as member from evidence_v where cohort <> 0 or human_verdict is not null),
q as (select unnest(['en', 'de', 'fr', 'es']) as domain_id), n as (select dev, domain_id, count(*) filter (member) as n, count(*) filter (member and judge = 'pass') as j, count(*) filter (member and judge = 'pass' and human_verdict <> 'pass') as fp from e group by all),
o as (select dev, count(*) filter (member) as n, count(*) filter (member and judge = human_verdict) as agree, count(*) filter (member and judge = 'pass') as j, count(*) filter (member and judge = 'pass' and human_verdict <> 'pass') as fp, count(*) filter (member and human_verdict = 'pass') as h,
    count(*) filter (member and human_verdict = 'pass' and judge <> 'pass') as ff, count(*) filter (member and judge = 'pass' and critical) as cr, count(*) filter (not member and judge <> 'pass') as missed, count(*) filter (member and judge = 'pass' and (evidence_id % 100 = 7 or source_group is null)) as bare, count(*) filter (member and not coalesce(eligible, false)) as ineligible from e group by dev),
few as (select dev, bool_or(coalesce(n, 0) < 30) as few from (select d.dev, q.domain_id from q, (values (true), (false)) d(dev)) x left join n using (dev, domain_id) group by dev),
scope as (select (select count(*) from q where domain_id not in (select domain_id from n where not dev and n.n > 0)) + (select count(*) from n where not dev and n.n > 0 and domain_id not in (select domain_id from q)) > 0 as differs),
zero as (select min(domain_id) filter (j = 0) as z, min(domain_id) filter (j > 0 and fp * 10000 > j * 1000) as a from n where not dev),
r as (select 10 as k, 'development_review_quota_not_met' as reason from o where dev and n < 100 union all select 20, 'development_nonpass_or_unavailable_not_fully_reviewed' from o where dev and missed > 0 union all select 30, 'development_passes_not_stratified' from o where dev and (j = 0 or bare > 0) union all select 40, 'development_domain_review_quota_not_met' from few where dev and few
    union all select 50, 'evaluation_review_quota_not_met' from o where not dev and n < 100 union all select 60, 'evaluation_selection_not_deterministically_complete' from o where not dev and ineligible > 0 union all select 70, 'evaluation_domain_review_quota_not_met' from few where not dev and few
    union all select 80, 'evaluation_domain_scope_mismatch' from scope where differs
    union all select 100 + min(evidence_id * 10 + c), ['evaluation_contains_noneligible_episode', '', 'evaluation_source_or_task_scope_mismatch', 'evaluation_generator_or_agent_identity_mismatch'][c + 1] from (select evidence_id, unnest([case when not coalesce(eligible, false) then 0 end, case when evidence_id % 500 = 6 then 2 end, case when evidence_id % 250 = 3 then 3 end]) as c from e where not dev) s where c is not null group by c
    union all select 1e12, case when n = 0 then 'agreement_denominator_zero' else 'overall_agreement_below_threshold' end from o where not dev and (n = 0 or agree * 10000 < n * 8500) union all select 1e12 + 1, case when j = 0 then 'overall_false_pass_denominator_zero' else 'overall_false_pass_above_threshold' end from o where not dev and (j = 0 or fp * 10000 > j * 500)
    union all select 1e12 + 2, case when h = 0 then 'overall_false_fail_denominator_zero' else 'overall_false_fail_above_threshold' end from o where not dev and (h = 0 or ff * 10000 > h * 1000) union all select 1e12 + 3, 'critical_safety_false_pass_detected' from o where not dev and cr > 0
    union all select case when a is null or z < a then 1e12 + 4 else 1e12 + 6 end, 'per_domain_false_pass_denominator_zero' from zero where z is not null union all select 1e12 + 5, 'per_domain_false_pass_above_threshold' from zero where a is not null)
select 'pol' as policy_id, 'fp' as policy_fingerprint, case when count(*) = 0 then 'eligible' else 'ineligible' end as eligibility, coalesce(string_agg(reason, ',' order by k), '') as reasons from r"""
_CONTACT_KEY = """'contacts:semantic:sha256:' || sha256('{"action":"' || action || '","exact_note":' || case when note_constraint = 'exact' then '"Please follow up by email."' else 'null' end || ',"grounding_email":"' || expected_email || '","note_constraint":"' || note_constraint || '","route":"' || route || '","target":"' || target || '"}')"""
_FIND = "'ind the email address for ' || target || '.'"
_CONTACT_TEXT = f"""case route when 'directory' then 'Use the contact directory to identify ' || target || ', then f' || {_FIND} when 'recovery' then 'A stale contact label may fail. First look up ''' || target || ' (stale)''. If it reports no contact, use the contact directory to identify ' || target || ', then f' || {_FIND} else 'F' || {_FIND} end
    || case when action = 'lookup_email' then '' else ' After the lookup confirms ' || target || ', ' || case when note_constraint = 'exact' then 'Record exactly this follow-up note: "Please follow up by email.".' else 'Record a brief follow-up note.' end || case when route = 'verify' then ' Then retrieve the saved follow-up and report the recorded note.' else '' end end"""
_CONTACT_SLOT = "'contacts-' || kind || '-' || replace(lower(target), ' ', '-')"
_KEPT = "contact_cases_v where action = 'lookup_email' or target not in (select name from followups_v)"
_CONTACT_CASES = f"""select {_CONTACT_SLOT} as slot_id, '{{"action": "' || action || '"' || case when action = 'record_followup' then ', "condition": "after_lookup_match"' else '' end || ', "contact": "' || target || '"' || case when note_constraint = 'exact' then ', "note": "Please follow up by email."' else '' end
    || case when action = 'record_followup' then ', "note_constraint": "' || note_constraint || '"' else '' end || ', "route": "' || route || '"}}' as payload, {_CONTACT_TEXT} as instruction,
    concat_ws(',', 'lookup_contact', case when route in ('directory', 'recovery') then 'list_contacts' end, case when action = 'record_followup' then 'record_followup' end, case when route = 'verify' then 'get_followup' end) as tools, {_CONTACT_KEY} as semantic_key from {_KEPT}"""
_CONTACT_COMPILE = f"""with r as (select *, case when v = 0 then 'negated_action' when v in (1, 11) then 'proposal_not_json' when v = 2 then 'proposal_not_object' when v = 3 then 'unsupported_requested_action' when v = 4 then 'negated_action' when v = 6 then 'wrong_contact_binding' when v = 5 then 'unsupported_requested_action'
    when v = 7 then 'uncheckable_condition' when action = 'record_followup' and v = 8 then 'uncheckable_condition' when action = 'record_followup' and note_constraint <> 'exact' and v = 9 then 'unsupported_note' when v = 10 or (v = 9 and note_constraint <> 'exact') then 'unsupported_requested_action' end as reason from contact_cases_v)
select contact_key, position, reason, case when reason is null then {_CONTACT_KEY} end as semantic_key, case when reason is null then '{{"action":"' || action || '","exact_note":' || case when note_constraint = 'exact' then '"Please follow up by email."' else 'null' end || ',"expected_email":"' || expected_email
    || '","note_constraint":"' || note_constraint || '","route":"' || route || '","target":"' || target || '"}}' end as private_case from r"""
_OPENING = "when v = 0 then 'negated_action' when v = 1 then 'proposal_not_json' when v = 2 then 'proposal_not_object' when v = 3 then 'negated_action' when v = 4 then 'unsupported_private_exact_target' when v = 5 then 'unsupported_requested_action' when v = 6 then 'uncheckable_condition'"
_MESSAGE_COMPILE = f"""select message_id, position, case {_OPENING} when action = 'search_messages' and v in (7, 11) then 'unsupported_requested_action' when action = 'search_messages' then null when v = 7 then 'wrong_message_binding' when v = 8 then 'missing_mutation_authority'
    when v = 9 then 'uncheckable_condition' when v = 10 then case when action = 'create_reminder' then 'missing_mutation_argument' else 'unsupported_reply' end when v = 11 then 'unsupported_requested_action' end as reason from message_cases_v"""
_WORKSPACE_COMPILE = f"""select item_id, position, case {_OPENING} when action = 'search_workspace_items' and v in (7, 11) then 'unsupported_requested_action' when action = 'search_workspace_items' then null when v = 8 then 'missing_mutation_authority' when v = 9 then 'uncheckable_condition'
    when v = 7 then 'wrong_item_binding' when v = 10 and action = 'create_workspace_task' then 'missing_mutation_argument' when v = 10 and comment_constraint = 'exact' then 'unauthorized_comment_argument' when v = 10 then 'unsupported_comment' when v = 11 then 'unsupported_requested_action' end as reason
    from workspace_cases_v where route <> 'missing'"""
def snapshot(*sections: tuple[str, str, str, str]) -> str:
    """A state's digest and bytes from (name, row, table, key) of each section."""
    whole = "'{' || " + " || ',' || ".join(f"'\"{name}\":[' || coalesce((select string_agg({row}, ',' order by {key}) from {table}), '') || ']'" for name, row, table, key in sections) + " || '}'"
    return f"select 'sha256:' || sha256(s) as fingerprint, cast(length(s) as bigint) as byte_count from (select {whole} as s) t"


_SNAPSHOT = snapshot(("contacts", """'{"email":"' || email || '","name":"' || name || '"}'""", "contacts_v", "name"), ("followups", """'{"name":"' || name || '","note":"a note"}'""", "followups_v", "name"))
_MESSAGE_SNAPSHOT = snapshot(("drafts", """'{"content":"Thanks, noted.","message_id":"' || message_id || '"}'""", "notes_v where s_suppkey % 5 = 0", "message_id"), ("messages", """'{"body":"' || body || '","message_id":"' || message_id || '","sender":"' || sender || '"}'""", "notes_v", "message_id"), ("reminders", "''", "notes_v where false", "message_id"))
_PRIVATE = "access_token|api_key|auth|authorization|analysis|cookie|completion|credential|expected|ground_truth|hidden_reasoning|http_body|oracle|passwd|password|private|provider|provider_payload|raw_payload|raw|reasoning|response|secret|session|source_path|thought|token"
_LEAVES = f"""with t as (select k, unnest(list_zip(list(fullkey), list(coalesce(cast(atom as varchar), 'null')))) as x from (select k, j.fullkey, j.atom from payloads_v, json_tree(payload) j where j.type not in ('OBJECT', 'ARRAY')) u group by k),
l as (select k, x[1] as path, x[2] as value, regexp_matches(replace(lower(x[1]), 'provider_id', ''), '{_PRIVATE}') as hidden, regexp_matches(x[2], '(^|[^:/A-Za-z0-9_.-])/([^/]|$)| ~/') or contains(lower(x[2]), 'password') as bad from t)"""
_CANONICAL = """select k, '{"Session_id":{"a":[1,2]},"n":2.5,"none":null,"on":true,"priority":"' || cast(json_extract_string(payload, '$.priority') as varchar) || '","provider_id":"p","status":"' || json_extract_string(payload, '$.status') || '","sub":{' || case when k % 4 = 0 then '"api_key":{"deep":"' || json_extract_string(payload, '$.sub.api_key.deep') || '"},' else '' end || '"list":[[],["'
    || case when k % 7 = 0 then 'go ~/x' else 'x y' end || '"]]' || case when k % 4 <> 0 then ',"plain":{"deep":"' || json_extract_string(payload, '$.sub.plain.deep') || '"}' else '' end || '},"z":[1,{"b":"' || json_extract_string(payload, '$.z[1].b') || '","k":' || k || '}]}' as canonical from payloads_v"""
_PUBLIC_EVENTS = """with e as (select *, route in ('directory', 'recovery') as listed, action = 'record_followup' as writes, row_number() over (partition by contact_key, position order by idx, event_type) - 1 as place from contact_events_v join (select contact_key, position, route, action from contact_cases_v) c using (contact_key, position)),
f as (select contact_key, position, '$[' || place || '].' as pre, event_type, tool_name, content, error_code, case when tool_name = 'lookup_contact' or (tool_name = 'list_contacts' and listed) or (tool_name = 'record_followup' and writes) or (tool_name = 'get_followup' and writes and route = 'verify') then tool_name end as known, arguments, observation, change from e),
p as (select contact_key, position, pre || name as path, to_json(value)::varchar as value, value as raw from (select contact_key, position, pre, unnest(['event_type', 'tool_name', 'content', 'error_code']) as name, unnest([event_type, tool_name, content, error_code]) as value from f) x where value is not null
    union all select contact_key, position, pre || 'arguments.name', json_extract(arguments, '$.name')::varchar, '' from f where arguments is not null and known = 'lookup_contact'
    union all select contact_key, position, pre || 'observation.' || n, json_extract(observation, '$.' || n)::varchar, '' from f, (values ('name'), ('email'), ('note')) v(n) where known is not null and json_extract(observation, '$.' || n) is not null and ((known = 'lookup_contact' and n in ('name', 'email')) or (known in ('record_followup', 'get_followup') and n in ('name', 'note')))
    union all select contact_key, position, pre || 'observation.contacts[' || n || ']', json_extract(observation, '$.contacts[' || n || ']')::varchar, '' from f, (values (0), (1)) v(n) where known = 'list_contacts' and json_extract(observation, '$.contacts[' || n || ']') is not null
    union all select contact_key, position, pre || 'change.' || n, json_extract(change, '$.' || n)::varchar, '' from f, (values ('name'), ('note')) v(n) where known = 'record_followup' and change is not null)
select contact_key, position, path, value from p"""
_REHEARSAL = f"""with k as (select {_CONTACT_SLOT} as slot_id, target, position from {_KEPT}), f as (select * from k order by target, position limit 16)
select (select count(*) from k) as known_task_capacity, case when (select count(*) from k) >= 8 then 'sufficient' else 'insufficient' end as capacity_status, string_agg('semantic:sha256:' || sha256('semantic:sha256:x:' || slot_id), ',' order by target, position) as semantic_groups,
    (select string_agg(g, ',' order by g) from (select distinct 'grounding:sha256:' || sha256('grounding:sha256:x:' || target) as g from f) h) as grounding_groups from f"""
_ONCE = "once as (select a.message_id from notes_v a join notes_v b on contains(lower(b.body), lower(a.body)) group by a.message_id having count(*) = 1)"
_MESSAGE_SLOT = "'mobile-' || kind || '-message-' || substr(sha256(message_id), 1, 24)"
_MESSAGE_SLOTS = f"""with {_ONCE} select message_id, position, kind, {_MESSAGE_SLOT} as slot_id from message_cases_v join once using (message_id) join notes_v n using (message_id)
where not (action = 'create_reminder' and n.s_suppkey % 5 = 0) and not (action = 'create_draft_reply' and n.s_suppkey % 7 = 0) and not (reply_constraint = 'exact' and not {_REPLY.format(x='exact_reply')})"""
_TEXT = lambda x: f"coalesce('\"' || {x} || '\"', 'null')"
_MESSAGE_CASES = f"""with {_ONCE}, c as (select * from message_cases_v join once using (message_id) where not (reply_constraint = 'exact' and not {_REPLY.format(x='exact_reply')}))
select {_MESSAGE_SLOT} as slot_id, '{{"action": "' || action || '"' || case when action = 'search_messages' then ', "query": "' || body || '"' else ', "condition": "after_message_match", "message_query": "' || body || '"' end || coalesce(', "remind_at": "' || remind_at || '", "reminder_text": "' || reminder_text || '"', '')
    || coalesce(', "reply": "' || exact_reply || '"', '') || case when action = 'create_draft_reply' then ', "reply_constraint": "' || reply_constraint || '"' else '' end || ', "route": "' || route || '"}}' as payload,
    case route when 'directory' then 'Use the sender list to identify ' || sender || ', then find the message that mentions "' || body || '".' when 'recovery' then 'A stale message query may fail. First search for "' || body || ' (stale)". If it reports no message, use the sender list to identify ' || sender || ', then find the message that mentions "' || body || '".'
        else 'Find the message from ' || sender || ' that mentions "' || body || '".' end
    || case action when 'create_reminder' then ' After finding the selected message, create a reminder for ' || remind_at || ' that says "' || reminder_text || '".' || case when route = 'verify' then ' Then retrieve the saved reminder and report its text and time.' else '' end
        when 'create_draft_reply' then ' After finding the selected message, ' || case when reply_constraint = 'exact' then 'Draft exactly this reply: "' || exact_reply || '".' else 'Draft a brief courteous reply.' end || case when route = 'verify' then ' Then retrieve the saved draft and report its content.' else '' end else '' end as instruction,
    concat_ws(',', 'search_messages', case when route in ('directory', 'recovery') then 'list_message_senders' end, case when action <> 'search_messages' then action end, case when route = 'verify' then case when action = 'create_reminder' then 'get_reminder' else 'get_draft_reply' end end) as tools,
    'mobile_messages:semantic:sha256:' || sha256('{{"action":"' || action || '","body":"' || body || '","exact_reply":' || {_TEXT('exact_reply')} || ',"message_id":"' || message_id || '","remind_at":' || {_TEXT('remind_at')} || ',"reminder_text":' || {_TEXT('reminder_text')}
        || ',"reply_constraint":"' || reply_constraint || '","route":"' || route || '","sender":"' || sender || '"}}') as semantic_key from c"""
_QUERY = "case when kind = 'task' then regexp_replace(lower(summary), '^(complete|finalize|prepare|review|schedule|summarize)\\s+', '') else lower(summary) end"
_WORKSPACE_SNAPSHOT = snapshot(("items", f"""'{{"item_id":"' || item_id || '","kind":"' || kind || '","project_id":' || coalesce('"' || project_id || '"', 'null') || ',"query":"' || {_QUERY} || '","summary":"' || summary || '"}}'""", "items_v", "item_id"))
_WORKSPACE_SLOTS = f"""u as (select * from (select *, {_QUERY} as query from items_v) q qualify count(*) over (partition by kind, query) = 1), k as (select *, row_number() over (partition by kind order by item_id) - 1 as n, count(*) over (partition by kind) as m from u),
p(spec, position, wanted, pick) as (values ('search-direct', 0, 'document', 0), ('search-directory', 1, 'project', 0), ('search-recovery', 2, 'task', 0), ('task-direct', 4, 'project', 0), ('task-verified', 5, 'project', 1), ('comment-direct', 6, 'task', 0), ('comment-recovery', 7, 'task', 2), ('comment-verified', 8, 'task', 1)),
slots as (select spec, position, item_id, 0 as target_index from p join k on k.kind = p.wanted and k.n = least(p.pick, k.m - 1) union all select 'search-missing', 3, null, 0)"""
_WORKSPACE_CASES = f"""with {_WORKSPACE_SLOTS}, c as (select s.spec, i.*, case when split_part(spec, '-', 1) = 'search' then 'search_workspace_items' when split_part(spec, '-', 1) = 'task' then 'create_workspace_task' else 'add_workspace_comment' end as action,
    case split_part(spec, '-', 2) when 'verified' then 'verify' else split_part(spec, '-', 2) end as route, case spec when 'task-direct' then 'exact' when 'task-verified' then 'open' else 'none' end as tc, case spec when 'comment-recovery' then 'exact' when 'comment-direct' then 'open' when 'comment-verified' then 'open' else 'none' end as cc
    from slots s left join u i on i.item_id = s.item_id),
t as (select *, case when action = 'create_workspace_task' then case when route = 'direct' then 'high' else 'medium' end end as priority, case when action = 'create_workspace_task' then case when route = 'direct' then 'next_week' else 'later' end end as due, case when tc = 'exact' then 'Prepare ' || summary || ' retrospective' end as title,
    case when cc = 'exact' then 'Status: ' || query || ' is ready for review.' end as comment, case when item_id is not null then '{{"item_id":"' || item_id || '","kind":"' || kind || '","project_id":' || {_TEXT('project_id')} || ',"query":"' || query || '","summary":"' || summary || '"}}' end as target from c)
select spec, 'workspace-' || spec || '-item-' || substr(sha256(coalesce(target, '{{"kind":"document","query":"archived roadmap"}}')), 1, 24) as slot_id,
    case when route = 'missing' then '{{"action": "search_workspace_items", "kind": "document", "query": "archived roadmap", "route": "missing"}}' when action = 'search_workspace_items' then '{{"action": "search_workspace_items", "kind": "' || kind || '", "query": "' || query || '", "route": "' || route || '"}}'
        when action = 'create_workspace_task' then '{{"action": "create_workspace_task", "condition": "after_item_match", "due_label": "' || due || '", "priority": "' || priority || '", "project_kind": "' || kind || '", "project_query": "' || query || '", "route": "' || route || '", ' || coalesce('"title": "' || title || '"', '"task_constraint": "open"') || '}}'
        else '{{"action": "add_workspace_comment", ' || coalesce('"comment": "' || comment || '", ', '') || '"comment_constraint": "' || cc || '", "condition": "after_item_match", "route": "' || route || '", "task_kind": "' || kind || '", "task_query": "' || query || '"}}' end as payload,
    case when route = 'missing' then 'Search for the workspace document that matches "archived roadmap". If it is not found, report that safely and make no changes.' when route = 'directory' then 'Use the project directory to identify ' || summary || ', then find the workspace ' || kind || ' that matches "' || query || '".'
        when route = 'recovery' then 'A stale workspace query may fail. First search for "' || query || ' (stale)". If it reports no item, find the workspace ' || kind || ' that matches "' || query || '".' else 'Find the workspace ' || kind || ' that matches "' || query || '".' end
    || case action when 'create_workspace_task' then ' After finding the selected project, ' || coalesce('create a task titled "' || title || '"', 'create a concise planning task') || ' with ' || priority || ' priority and due ' || due || '.' || case when route = 'verify' then ' Then retrieve the saved task and report its details.' else '' end
        when 'add_workspace_comment' then ' After finding the selected task, ' || coalesce('Add exactly this comment: "' || comment || '".', 'Add a concise status comment.') || case when route = 'verify' then ' Then retrieve the saved comment and report its text.' else '' end else '' end as instruction,
    concat_ws(',', 'search_workspace_items', case when route = 'directory' then 'list_workspace_projects' end, case when action <> 'search_workspace_items' then action end, case when route = 'verify' then case when action = 'create_workspace_task' then 'get_workspace_task' else 'get_workspace_comment' end end) as tools,
    'workspace_tasks:semantic:sha256:' || sha256('{{"action":"' || action || '","comment_constraint":"' || cc || '","due_label":' || {_TEXT('due')} || ',"exact_comment":' || {_TEXT('comment')} || ',"missing_kind":' || case when route = 'missing' then '"document"' else 'null' end || ',"missing_query":' || case when route = 'missing' then '"archived roadmap"' else 'null' end
        || ',"priority":' || {_TEXT('priority')} || ',"route":"' || route || '","target":' || coalesce(target, 'null') || ',"task_constraint":"' || tc || '","title":' || {_TEXT('title')} || '}}') as semantic_key from t"""
_TOOLS = """select contact_key, position, '[' || concat_ws(',', {look}, case when route in ('directory', 'recovery') then {directory} end, case when action = 'record_followup' then {write} end, case when action = 'record_followup' and route = 'verify' then {read} end) || ']' as tools from contact_cases_v""".format(
    look="""'{"description":"Look up one contact''s email address by name.","input_schema":{"properties":{"name":{"type":"string"}},"required":["name"],"type":"object"},"name":"lookup_contact","output_schema":{"properties":{"email":{"type":"string"},"name":{"type":"string"}},"type":"object"}}'""",
    directory="""'{"description":"List the available contact names.","input_schema":{"properties":{},"type":"object"},"name":"list_contacts","output_schema":{"properties":{"contacts":{"type":"array"}},"type":"object"}}'""",
    write="""'{"description":"Record one follow-up note for a confirmed contact.","input_schema":{"properties":{"name":{"type":"string"},"note":{"type":"string"}},"required":["name","note"],"type":"object"},"name":"record_followup","output_schema":{"properties":{"name":{"type":"string"},"note":{"type":"string"}},"type":"object"}}'""",
    read="""'{"description":"Retrieve the saved follow-up note for one contact.","input_schema":{"properties":{"name":{"type":"string"}},"required":["name"],"type":"object"},"name":"get_followup","output_schema":{"properties":{"name":{"type":"string"},"note":{"type":"string"}},"type":"object"}}'""",
)


def sql(admitted: str, gated: str, verdicts: str, members: str, usage: str, slots: str) -> dict[str, str]:
    """The SQL by query, over the common table expressions of admission and review."""
    gates = ("execution", "mutation_authorization", "assessment", "final_grounding", "unsafe_material")
    names = [g.removeprefix("mutation_") for g in gates]
    passes = [(n, f"count(*) filter ({'authorized' if n == 'authorization' else g})") for n, g in zip(names, gates, strict=True)] + [("semantic_key", "count(*)")]
    line = lambda section, name, value, source="adm": f"select '{section}' as section, '{name}' as name, cast({value} as bigint) as n from {source}"
    counts = [
        line("yield", "terminal_episode_count", "count(*)"), line("yield", "deterministically_admitted_demonstration_count", "count(*) filter (admitted)"), line("yield", "negative_count", "count(*) filter (not admitted)"), line("yield", "allocated_task_attempt_count", "count(*)"),
        line("duplicates", "duplicate_semantic_task_count", "count(*) filter (reason_code = 'duplicate_semantic_task')"), "select 'capacity', 'known_task_capacity', 10000", line("recovery", "demonstration_recovery_count", "count(*) filter (admitted and recovery)"),
        line("recovery", "negative_recovery_count", "count(*) filter (not admitted and recovery)"), line("admission_status", "admitted", "count(*) filter (admitted)"), line("admission_status", "rejected", "count(*) filter (not admitted)"), *[line("gate_pass", n, v) for n, v in passes],
        *[line("gate_failure", n, f"count(*) - {v}") for n, v in passes], "select 'structural_family', collection || '.' || structural_key, count(*) from adm group by all",
        "select 'judgment_availability', case when judge_verdict = 'unavailable' then 'unavailable' else 'available' end, count(*) from evidence_v group by all", "select 'judgment_verdict', judge_verdict, count(*) from evidence_v group by all",
        line("demonstration_yield", "numerator", "count(*) filter (admitted)"), line("demonstration_yield", "denominator", "count(*)"), "select 'capacity_known', null, 1", line("review_status", "unreviewed", "count(*)"), line("judgment", "unavailable_as_uncertain_count", "count(*) filter (judge_verdict = 'unavailable')", "evidence_v"),
        "select 'usage', role || '.' || name, n from usg unpivot include nulls (n for name in (request_count, retry_count, repair_count, known_total_tokens, unknown_usage_count, reserved_count, failed_count, completed_count))",
        "select 'label_import_status', case when (select count(*) from members) = 0 then 'not_started' when (select count(*) from members) = (select count(*) from lab) then 'complete' else 'incomplete' end, 1", *[line("human_verdict", v, f"count(*) filter (verdict = '{v}')", "lab") for v in ("pass", "fail", "uncertain")],
        line("demonstration_acceptance", "denominator", "count(distinct episode_id)", "held"), line("demonstration_acceptance", "reviewed_count", "count(*)", "lab where cohort_id = 'cohort0'"), line("demonstration_acceptance", "human_pass_count", "count(*)", "lab where cohort_id = 'cohort0' and verdict = 'pass'"),
        "select 'demonstration_acceptance', 'incomplete_count', (select count(distinct episode_id) from held) - (select count(*) from lab where cohort_id = 'cohort0')", "select 'cohort_members', cohort_id, count(*) from members group by cohort_id",
    ]
    group = lambda *parts: "'sha256:' || sha256('[\"" + "\",\"' || ".join([parts[0], *[f"{p} || '" for p in parts[1:]]]) + "\"]')"
    campaign_results = f"""{admitted}, ep as (select *, case when sequence % 89 <> 0 then 2 else 0 end as requests from adm), r1 as (select *, row_number() over (partition by domain_id order by sequence) as ordinal from ep where admitted), sel as (select * from r1 where ordinal <= 40),
fam as (select domain_id, structural_key, count(*) as n from sel group by all), fams as (select domain_id, count(*) as family_count, max(n) as largest, '{{' || string_agg('"' || structural_key || '":' || n, ',' order by structural_key) || '}}' as family_distribution from fam group by domain_id),
cau as (select domain_id, '{{' || string_agg('"' || cause || '":' || n, ',' order by cause) || '}}' as rejection_causes from (select domain_id, coalesce(reason_code, 'unspecified') as cause, count(*) as n from ep where not admitted group by all) c group by domain_id),
w as (select domain_id, count(*) as n, count(*) filter (admitted) as made, count(*) filter (reason_code = 'duplicate_semantic_task') as dup, sum(sequence) as tokens, max((domain_id = 'contacts')::int) as unknown from ep group by domain_id),
h as (select domain_id, count(*) as selected, count(*) filter (requests = 0) as idle, count(*) filter (mutation_authorization = 'rejected') as refused from sel group by domain_id),
results as (select domain_id, 'completed' as run_status, n as task_attempt_count, n as terminal_outcome_count, made as demonstration_count, n - made as negative_count, selected as selected_count, selected = 40 and idle = 0 as all_selected_agent_rollouts, idle as selected_without_agent_rollout_count, selected = 40 as all_selected_deterministic_gates_pass,
    refused as selected_unauthorized_mutation_count, family_distribution, family_count, largest / selected as largest_family_share, domain_id <> 'contacts' as replay_aligned, coalesce(rejection_causes, '{{}}') as rejection_causes, dup as duplicate_semantic_task_count, cast(tokens as bigint) as known_total_tokens, cast(unknown as bigint) as unknown_usage_request_count,
    cast(round_even(n / 8.0, 3) as double) as elapsed_seconds, cast(round_even(n / 8.0 / made, 3) as double) as elapsed_seconds_per_deterministic_episode, case when unknown = 0 then cast(round_even(tokens / made, 3) as double) end as known_tokens_per_deterministic_episode, selected
    from w join h using (domain_id) join fams using (domain_id) left join cau using (domain_id))"""
    decisions = """lab as (select domain_id, count(*) as reviewed, count(*) filter (sequence % 13 <> 0 and sequence % 31 <> 0) as passes, count(*) filter (sequence % 13 = 0) as fails, count(*) filter (sequence % 13 <> 0 and sequence % 31 = 0) as unsure, count(*) filter (sequence % 97 = 0) as critical from sel where domain_id <> 'mobile_messages' or ordinal > 1 group by domain_id),
pl as (select unnest(['contacts', 'mobile_messages', 'other', 'workspace_tasks']) as domain_id),
dd as (select *, coalesce(selected = 40 and all_selected_agent_rollouts and selected_unauthorized_mutation_count = 0 and duplicate_semantic_task_count = 0 and replay_aligned and family_count >= 3 and largest_family_share <= 0.35, false) as sound, coalesce(reviewed = 40 and selected = 40, false) as complete from pl left join results using (domain_id) left join lab using (domain_id)),
decided as (select domain_id, case when run_status is null then 'not_run' when sound and complete and passes >= 36 and critical = 0 then 'passed' when not complete then 'incomplete' else 'failed' end as status, case when run_status is not null then sound end as deterministic_gates_pass, case when run_status is null then 'not_started' when complete then 'complete' else 'incomplete' end as human_review_status,
    case when run_status is not null then 'h-' || domain_id end as frozen_membership_hash, cast(40 as bigint) as denominator, reviewed as reviewed_count, passes as human_pass_count, fails as human_fail_count, unsure as human_uncertain_count, 40 - reviewed as missing_label_count, critical as critical_safety_failure_count, passes / 40 as human_pass_rate,
    case when run_status is not null then 3 end as required_family_floor, family_count, largest_family_share, case when unknown_usage_request_count = 0 and passes > 0 then cast(round_even(known_total_tokens / passes, 3) as double) end as known_tokens_per_human_passed_episode, case when passes > 0 then cast(round_even(elapsed_seconds / passes, 3) as double) end as elapsed_seconds_per_human_passed_episode,
    selected as selected_count, known_total_tokens, unknown_usage_request_count from dd)"""
    return {
        "contact_assessment": _CONTACTS, "message_assessment": _MESSAGES, "workspace_assessment": _WORKSPACE, "contact_rollout": _CONTACT_ROLLOUT, "message_rollout": _MESSAGE_ROLLOUT, "workspace_rollout": _WORKSPACE_ROLLOUT,
        "rollout_replay": _REPLAY,
        "contact_cases": _CONTACT_CASES, "contact_compile": _CONTACT_COMPILE, "message_compile": _MESSAGE_COMPILE, "workspace_compile": _WORKSPACE_COMPILE, "restored_cases": "select v, count(*) filter (v not in (1, 2, 3)) as valid, count(*) as n from contact_cases_v group by v", "contact_snapshot": _SNAPSHOT, "message_snapshot": _MESSAGE_SNAPSHOT, "workspace_snapshot": _WORKSPACE_SNAPSHOT, "canonical_payloads": _CANONICAL, "nested_redaction": f"{_LEAVES} select k, path, case when bad then '\"[redacted]\"' else value end as value from l where not hidden", "unsafe_payloads": f"{_LEAVES} select k, bool_or(hidden or bad) as unsafe, false as plain from l group by k", "public_events": _PUBLIC_EVENTS, "pilot_rehearsal": _REHEARSAL,
        "message_slots": _MESSAGE_SLOTS, "message_cases": _MESSAGE_CASES, "workspace_slots": f"with {_WORKSPACE_SLOTS} select * from slots", "workspace_cases": _WORKSPACE_CASES, "tool_definitions": _TOOLS,
        "agent_decisions": """select contact_key, position, case when v in (0, 1, 3, 7) then null when v = 2 then 'final_response' else 'tool_call' end as decision, case when v in (0, 1, 2, 3, 7) then null when v = 9 then 'dance' else 'lookup_contact' end as tool_name,
    case when v = 2 then 'done' end as final_content from contact_cases_v""",
        "checked_calls": "select contact_key, position, case when v = 9 then 'unknown_tool' when v in (4, 5, 6) then 'invalid_tool_arguments' end as error_code from contact_cases_v where v not in (0, 1, 2, 3, 7)",
        "mapped_proposals": """select cast(floor((sequence - 1) / 8) as bigint) as batch, sequence, 'slot-' || sequence as slot_id, case when floor((sequence - 1) / 8) % 5 in (0, 4) then 'do ' || sequence end as content,
    case floor((sequence - 1) / 8) % 5 when 1 then 'generation_slot_mismatch' when 2 then 'generation_malformed_output' when 3 then 'generation_malformed_output' end as error from episodes_v""",
        "judge_availability": """select run_id, case when run_id % 2 = 0 then 'not_requested' when run_id % 3 = 0 then 'judge_identity_missing' when run_id % 5 = 0 then 'judge_not_registered' when run_id % 7 = 0 then 'judge_identity_matches_generator'
    when run_id % 11 = 0 then 'judge_identity_matches_agent' end as unavailable_reason from runs_v""",
        "pre_execution_negatives": """select 'episode_r1_' || case when sequence < 10000 then lpad(cast(sequence as varchar), 4, '0') else cast(sequence as varchar) end as episode_id, case when sequence % 5 = 0 then 'read /tmp/x' when sequence % 5 <> 1 then 'do it' else 'Task generation failed before public task compilation.' end as instruction,
    'unavailable' as tools, sequence % 3 <> 0 as authorized, sequence % 5 <> 0 as safe, case when sequence % 3 = 0 then 'unauthorized_mutation' else 'wrong_contact_binding' end as reason_code from episodes_v where terminal_reason is not null""",
        "work_states": """select case when sequence % 4 = 0 then 'terminal' when sequence % 7 = 0 then case when sequence % 2 = 0 then 'generating' else 'running' end when sequence % 3 = 0 then 'compiled' else 'pending' end as status, sequence % 3 = 0 as has_case, count(*) as n from episodes_v group by all""",
        "run_attempts": f"""with {admitted}, e as (select * from adm where sequence % 6 <> 0) select v.domain_id, count(*) as attempt_count, count(e.sequence) as terminal_count, count(*) filter (e.admitted) as accepted_count, count(*) filter (not e.admitted) as negative_count, count(*) - count(e.sequence) as incomplete_count
    from episodes_v v left join e on e.sequence = v.sequence group by v.domain_id""",
        "quality_counts": f"with {admitted}, {verdicts}, {members}, lab as (select m.*, v.verdict from members m join verdicts v using (episode_id)), held as (select * from members where cohort_id = 'cohort0'), usg as (select role, {usage} from requests_v group by role) " + " union all ".join(counts),
        "restored_messages": "select v, count(*) filter (v not in (1, 2, 3, 4, 5)) as valid, count(*) as n from message_cases_v group by v",
        "restored_workspace": f"""with u as (select * from (select *, {_QUERY} as query from items_v) q qualify count(*) over (partition by kind, query) = 1), k as (select kind, row_number() over (partition by kind order by item_id) - 1 as n from u),
p(spec, wanted) as (values ('search-direct', 'document'), ('search-directory', 'project'), ('search-recovery', 'task'), ('task-direct', 'project'), ('task-verified', 'project'), ('comment-direct', 'task'), ('comment-recovery', 'task'), ('comment-verified', 'task')),
t as (select n as target_index from (select n, position from (select k.n, row_number() over (partition by k.n) as position from p join k on k.kind = p.wanted) x union all select 0, 0) y order by n limit 10000)
select cast(target_index % 6 as integer) as v, count(*) filter (target_index % 6 = 0) as valid, count(*) as n from t group by 1""",
        "slot_lookup": f"""with {slots}, a as (select slot_id, name, position from slots) select a.slot_id || case when h then '-x' else '' end as slot_id, case when not h then name end as name, case when not h then position end as position, not h as known from (select *, sha256(slot_id) < '4' as h from a) a""",
        "domain_results": f"with {campaign_results} select * exclude (selected) from results",
        "domain_decisions": f"with {campaign_results}, {decisions} select * from decided",
        "campaign_decision": f"""with {campaign_results}, {decisions}, t as (select sum(denominator) as n, sum(reviewed_count) as r, sum(human_pass_count) as p, sum(critical_safety_failure_count) as c, sum(selected_count) as x, bool_and(status = 'passed') as every, sum(known_total_tokens) as tokens, bool_or(unknown_usage_request_count > 0) as unknown from decided)
select case when x = n and r = n and every and p >= ceil(n * 0.9) and c = 0 then 'passed' when x < n or r < n then 'incomplete' else 'failed' end as dataset_status, cast(n as bigint) as denominator, cast(r as bigint) as reviewed_count, cast(p as bigint) as human_pass_count, p / n as human_pass_rate,
    cast(c as bigint) as critical_safety_failure_count, case when not unknown and p > 0 then cast(round_even(tokens / p, 3) as double) end as known_tokens_per_human_passed_episode, case when (select count(*) from runs_v where run_id < 8) = 8 then 'passed' else 'incomplete' end as engineering_status, 'blocked' as core_cutover_status from t""",
        "engineering_readiness": """with c as (select ['core_domain_model_behavior', 'locality', 'replay', 'request_budget_recovery', 'architecture', 'docs', 'clean_installation', 'accepted_engine_scale'][run_id] as name, run_id % 5 <> 0 and run_id % 3 <> 0 as holds from runs_v where run_id between 1 and 8),
a as (select unnest(['core_domain_model_behavior', 'locality', 'replay', 'request_budget_recovery', 'architecture', 'docs', 'clean_installation', 'accepted_engine_scale']) as name), m as (select a.name, holds from a left join (select * from c where name <> 'docs') c using (name))
select case when count(*) filter (not holds) > 0 then 'failed' when count(*) filter (holds is null) > 0 then 'incomplete' else 'passed' end as status, coalesce(string_agg(name, ',' order by name) filter (holds is null), '') as missing_checks, coalesce(string_agg(name, ',' order by name) filter (not holds), '') as failed_or_unverified_checks from m""",
        "label_summary": f"""with {verdicts}, {members}, l as (select m.*, v.verdict from members m join verdicts v using (episode_id)), e as (select * from l where cohort_id = 'cohort0')
select (select count(distinct episode_id) from members where cohort_id = 'cohort0') as evaluation_denominator, (select count(*) from e) as evaluation_reviewed_count, (select count(*) from e where verdict = 'pass') as evaluation_human_pass_count,
    count(*) filter (verdict = 'pass') as pass_count, count(*) filter (verdict = 'fail') as fail_count, count(*) filter (verdict = 'uncertain') as uncertain_count, sha256((select string_agg(cast(episode_id as varchar), ',' order by episode_id) from (select distinct episode_id from l where verdict = 'pass') p)) as approved_ids,
    case when (select count(*) from members) = 0 then 'not_started' when (select count(*) from members) = count(*) then 'complete' else 'incomplete' end as status,
    (select count(distinct episode_id) from members where cohort_id = 'cohort0') - (select count(*) from e) as evaluation_incomplete_count from l""",
        "campaign_evidence": f"""with r as (select *, cast(floor(evidence_id / 100) as bigint) as run_id from evidence_v), used as (select distinct run_id from r where run_id % 3 <> 2 and human_verdict is not null and cohort = 0)
select {group('episode', 'run_id', 'evidence_id')} as evidence_id, evidence_id as episode_id, case when evidence_id % 4 <> 0 then {group('semantic-task', 'domain_id', "'v1'", "'key' || evidence_id")} end as semantic_task_group, coalesce(judge_verdict, 'unavailable') as judge_verdict,
    case when cohort = 0 then human_verdict end as human_verdict, case when cohort = 0 and human_verdict is not null then coalesce(critical, false) else false end as critical, cohort = 0 and human_verdict is not null as reviewed from r join used using (run_id)""",
        "scope_reasons": """with m as (select evidence_id as position, unnest([case when not coalesce(eligible, false) then 0 end, case when evidence_id % 4 = 0 then 1 end, case when evidence_id % 50 = 49 then 3 end, case when evidence_id % 40 = 39 then 5 end]) as c from evidence_v)
select min(position) as position, cast(c as integer) as "check", ['evaluation_contains_noneligible_episode', 'evaluation_canonical_group_evidence_missing', '', 'evaluation_generator_or_agent_identity_mismatch', '', 'evaluation_model_settings_mismatch'][c + 1] as reason from m where c is not null group by c""",
        "pilot_report": f"""with a as ({_CONTACTS}), k as (select a.*, c.v, c.mutation_authorization, passed and v % 2 = 0 as admitted from a join contact_cases_v c using (contact_key, position)),
e as (select contact_key, position, bool_or(event_type = 'state_change' and tool_name = 'record_followup') as changed, bool_or(event_type = 'error' and error_code = 'contact_not_found') as missed from contact_events_v group by all),
t as (select count(*) as attempted, count(*) filter (admitted) as demonstrations, count(*) filter (not admitted) as negatives, coalesce(bool_or(admitted and structural_key = 'contacts.lookup.direct'), false) as direct_lookup,
    coalesce(bool_or(admitted and mutation_authorization = 'authorized' and starts_with(structural_key, 'contacts.followup.') and changed), false) as authorized_mutation, coalesce(bool_or(admitted and ends_with(structural_key, '.recovery') and missed), false) as successful_recovery from k join e using (contact_key, position))
select *, attempted as executed_episode_count, demonstrations as passed_assessment_count, demonstrations as admitted_episode_count, demonstrations >= 8 as target_demonstrations_met, true as attempt_ceiling_respected, direct_lookup and authorized_mutation and successful_recovery as minimum_behavior_examples_met,
    true as replay_aligned, case when direct_lookup and authorized_mutation and successful_recovery then 'required_behaviors_observed' else 'insufficient_evidence' end as diagnostic_outcome from t""",
        "enforcement_preflight": """select run_id, [null, null, 'enforced admission requires semantic enforcement evidence', 'semantic enforcement activation is ineligible', 'semantic enforcement activation does not bind its policy', 'semantic enforcement activation does not match frozen evidence', 'enforcement policy identity or scope is unavailable',
    'enforcement policy identity or scope is unavailable', 'enforcement Domain identity is unavailable', 'enforcement policy does not cover this Domain version', 'enforcement generator and Agent identity is unavailable', 'enforcement generator or Agent identity differs from activation',
    'enforcement source, task, or model settings differ from activation', 'enforcement judge settings differ from activation', 'enforcement judge settings differ from activation', 'enforcement judge identity is unavailable or differs from activation'][run_id % 16 + 1] as reason from runs_v""",
        "activation_reasons": _ACTIVATION,
        "agent_contexts": contexts(_CONTACT_TEXT, _TOOLS),
        "admission_records": f"""with {admitted}, f as (select *, sequence % 3 = 0 as enforced from adm) select sequence, '{{"gates":{{"assessment":' || assessment || ',"execution":' || execution || ',"final_grounding":' || final_grounding || ',"mutation_authorization":' || authorized || ',"semantic_key":true,"unsafe_material":' || unsafe_material || '}},"human_review_status":"unreviewed","mode":"' || case when enforced then 'enforced' else 'deterministic' end || '"' || case when enforced then ',"semantic_judgment":"' || case when admitted then 'pass' else 'fail' end || '","semantic_policy_id":"policy-1"' else '' end || ',"status":"' || case when admitted then 'admitted' else 'rejected' end || '"}}' as record from f""",
        "stored_cases": """select contact_key, position, base64(encode('{"action":"' || action || '","exact_note":' || case when note_constraint = 'exact' then '"' || exact_note || '"' else 'null' end || ',"expected_email":"' || expected_email || '","note_constraint":"' || note_constraint || '","route":"' || route || '","target":"' || target || '"}')) as stored, contact_key % 7 <> 0 as same from contact_cases_v""",
        "gate_reasons": f"with {gated} select sequence, gates_passed, gate_reason from gated",
        "review_strata": f"""with {admitted} select domain_id, case when sequence % 3 <> 0 then task_type else 'unclassified' end as task_type, 'unclassified' as difficulty, case when sequence % 5 <> 0 then structural_key else 'unassessed' end as structural_key, count(*) as n from adm where admitted group by all""",
        "generation_requests_by_episode": "with e as (select sequence from requests_v where sequence is not null union all select related_sequence from requests_v where related_sequence is not null) select sequence, count(*) as n from e group by sequence",
        "replay_aligned": "select count(*) filter (conv_id % 7 <> 0 and (conv_id % 5 = 0 or conv_id % 3 = 0)) = 0 as aligned, count(*) as n from (select distinct conv_id from trace_v) t",
        "final_grounding": "select contact_key || ':' || position as conv_id, v <> 3 as grounded, cast(1 as bigint) as required from contact_cases_v",
    }
