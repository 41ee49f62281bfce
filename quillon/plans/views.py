"""The engine's entities as projections of the test tables, each written once as SQL for Spark and for the oracle.

``SHA(x)`` is the hex SHA-256 and ``JSON(x, path)`` the text at a JSON path;
they are replaced by each engine's function.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "requests_v": """
select request_id, sequence, role, status, request_kind, logical_request_id, case when role = 'task_generation' and k % 2 = 0 then sequence + 1 end as related_sequence,
    case when status = 'completed' then SHA(cast(request_id as varchar(20))) end as response_hash,
    case when (event_type <> 'error' and k % 10 = 0) or k % 5 = 0 then null else cast(floor(value * 10) as bigint) end as total_tokens
from (
    select event_id + 1 as request_id, user_id as sequence, event_type, value, k,
        case event_type when 'signup' then 'task_generation' when 'purchase' then 'quality_judge' else 'agent' end as role,
        case when event_type = 'error' then 'failed' when k % 10 = 0 then 'reserved' else 'completed' end as status,
        case when k % 7 = 0 then 'repair' else 'initial' end as request_kind,
        event_type || ':' || cast(user_id as varchar(20)) || ':' || cast(cast(ts as date) as varchar(10)) as logical_request_id
    from (select *, cast(JSON(props, '$.k') as bigint) as k from events) e
) r""",
    "trace_v": """
select conv_id, turn as idx, text as content,
    case when role = 'system' then 'error' when role = 'user' then 'action'
        when turn = max(case when role = 'assistant' then turn end) over (partition by conv_id) then 'final_response' else 'observation' end as event_type
from conversations""",
    "episodes_v": """
select o_orderkey + 1 as sequence, domain_id, terminal_reason, mutation_authorization, passed, case when not passed and o_custkey % 3 = 0 then 'requested_lookup_not_observed' when not passed and o_custkey % 3 = 1 then 'unintended_state_change' end as first_code,
    grounded, unsafe, recovery, semantic_key, structural_key, task_type
from (
    select o_orderkey, o_custkey,
        case o_custkey % 3 when 0 then 'contacts' when 1 then 'mobile_messages' else 'workspace_tasks' end as domain_id,
        case when o_orderstatus = 'F' and o_orderkey % 4 = 0 then case o_orderkey % 3 when 0 then 'step_budget_exhausted' when 1 then 'agent_response_malformed' else 'operator_cancelled' end end as terminal_reason,
        case when o_orderpriority = '1-URGENT' and o_custkey % 5 = 0 then 'rejected' else 'authorized' end as mutation_authorization,
        cast(floor(o_totalprice) as bigint) % 6 <> 0 as passed,
        o_orderkey % 11 <> 0 as grounded,
        o_orderkey % 13 = 0 as unsafe,
        o_custkey % 7 = 0 as recovery,
        cast(o_custkey % 3 as varchar(2)) || ':semantic:sha256:' || SHA(cast(o_custkey as varchar(20)) || ':' || o_orderpriority) as semantic_key,
        cast(o_custkey % 3 as varchar(2)) || '.' || lower(o_orderpriority) as structural_key,
        cast(o_custkey % 2 as varchar(2)) as task_type
    from orders
) o""",
    "evidence_v": """
select doc_id as evidence_id, domain_id, human_verdict,
    case when m < 6 then human_verdict when m < 8 then 'pass' when m = 8 then 'fail' else 'unavailable' end as judge_verdict,
    human_verdict is not null and toxic = 1 as critical, n_chars % 4 <> 0 as eligible, source as source_group, doc_id % 3 as cohort
from (
    select d.doc_id, d.lang as domain_id, d.n_chars, d.source, l.toxic, (d.doc_id * 7 + d.n_chars) % 10 as m,
        case when l.doc_id is null then null when l.toxic = 1 and l.quality = 1 then 'uncertain' when l.quality = 1 then 'pass' else 'fail' end as human_verdict
    from documents d left join labels l on d.doc_id = l.doc_id
) e""",
    "contacts_v": """
select c_custkey as contact_key, c_name as name, lower(replace(c_name, '#', '.')) || '@example.test' as email from customer""",
    "followups_v": """
select distinct c.c_name as name from customer c join orders o on o.o_custkey = c.c_custkey where o.o_orderpriority = '1-URGENT'""",
    "contact_cases_v": """
select c.contact_key, c.name as target, c.email as expected_email, s.position, s.kind, s.action, s.route, s.note_constraint,
    case when s.note_constraint = 'exact' then 'Please follow up by email.' end as exact_note, (c.contact_key + s.position) % 12 as v,
    case when s.action = 'lookup_email' then 'not_applicable' when (c.contact_key + s.position) % 12 = 2 then 'rejected' else 'authorized' end as mutation_authorization,
    case when (c.contact_key + s.position) % 12 = 8 then 'Another note' when (c.contact_key + s.position) % 12 = 9 then ' bad' else 'Please follow up by email.' end as note
from contacts_v c cross join (values (0, 'lookup-direct', 'lookup_email', 'direct', 'none'), (1, 'lookup-directory', 'lookup_email', 'directory', 'none'), (2, 'lookup-recovery', 'lookup_email', 'recovery', 'none'),
    (3, 'followup-open', 'record_followup', 'direct', 'open'), (4, 'followup-exact', 'record_followup', 'direct', 'exact'), (5, 'followup-directory', 'record_followup', 'directory', 'open'),
    (6, 'followup-recovery', 'record_followup', 'recovery', 'open'), (7, 'followup-verified', 'record_followup', 'verify', 'open')) s(position, kind, action, route, note_constraint)""",
    "contact_events_v": """
select contact_key, position, 1 as idx, 'action' as event_type, 'lookup_contact' as tool_name, '{"name":"' || target || ' (stale)"}' as arguments, null as observation, null as change, null as content, null as error_code from contact_cases_v where route = 'recovery' and v <> 1
union all select contact_key, position, 2, 'error', 'lookup_contact', null, null, null, null, case when v = 5 then 'other_error' else 'contact_not_found' end from contact_cases_v where route = 'recovery'
union all select contact_key, position, case when v = 6 then 9 else 3 end, 'observation', 'list_contacts', null, case when v = 7 then '{"contacts":["Nobody"]}' else '{"contacts":["' || target || '","Nobody"]}' end, null, null, null from contact_cases_v where route in ('directory', 'recovery')
union all select contact_key, position, 4, 'observation', 'lookup_contact', null, '{"name":"' || target || '","email":"' || case when v = 4 then 'x' else '' end || expected_email || '"}', null, null, null from contact_cases_v
union all select contact_key, position, 5, 'state_change', 'record_followup', null, null, '{"name":"' || target || '","note":"' || note || '"}', null, null from contact_cases_v where action = 'record_followup' and v <> 1
union all select contact_key, position, 6, 'state_change', 'other_tool', null, null, '{"name":"x"}', null, null from contact_cases_v where v = 10
union all select contact_key, position, 7, 'observation', 'get_followup', null, '{"name":"' || target || '","note":"' || note || '"}', null, null, null from contact_cases_v where route = 'verify' and v <> 11
union all select contact_key, position, 10, 'final_response', null, null, null, null, case when v = 3 then 'nothing' else 'Done for ' || upper(target) || ' ' || expected_email || ' ' || note end, null from contact_cases_v""",
    "notes_v": """
select 'm' || cast(s_suppkey as varchar(20)) as message_id, s_name as sender, 'Please read the report of ' || s_name || ' about ' || cast(s_nationkey as varchar(20)) as body, s_suppkey from supplier""",
    "message_cases_v": """
select m.message_id, m.sender, m.body, m.body as query, s.position, s.kind, s.action, s.route, s.reply_constraint, case when s.action = 'create_reminder' then 'Review the ' || m.body || '.' end as reminder_text,
    case when s.action = 'create_reminder' then '2026-10-04T09:00:00Z' end as remind_at, case when s.reply_constraint = 'exact' then 'Thanks, I will review the ' || m.body || '.' end as exact_reply, (m.s_suppkey + s.position) % 12 as v,
    case when s.action = 'search_messages' then 'not_applicable' when (m.s_suppkey + s.position) % 12 = 2 then 'rejected' else 'authorized' end as mutation_authorization,
    case when (m.s_suppkey + s.position) % 12 = 8 then 'Thanks for it' when (m.s_suppkey + s.position) % 12 = 9 then 'No.' else 'Thanks, I will review the ' || m.body || '.' end as reply
from notes_v m cross join (values (0, 'search-direct', 'search_messages', 'direct', 'none'), (1, 'search-directory', 'search_messages', 'directory', 'none'), (2, 'search-recovery', 'search_messages', 'recovery', 'none'),
    (3, 'reminder-direct', 'create_reminder', 'direct', 'none'), (4, 'reminder-directory', 'create_reminder', 'directory', 'none'), (5, 'reminder-recovery', 'create_reminder', 'recovery', 'none'), (6, 'reminder-verified', 'create_reminder', 'verify', 'none'),
    (7, 'draft-direct', 'create_draft_reply', 'direct', 'open'), (8, 'draft-directory', 'create_draft_reply', 'directory', 'open'), (9, 'draft-recovery', 'create_draft_reply', 'recovery', 'open'), (10, 'draft-exact', 'create_draft_reply', 'direct', 'exact'),
    (11, 'draft-verified', 'create_draft_reply', 'verify', 'open')) s(position, kind, action, route, reply_constraint)""",
    "message_events_v": """
select message_id, position, 1 as idx, 'action' as event_type, 'search_messages' as tool_name, '{"query":"' || query || ' (stale)"}' as arguments, null as observation, null as change, null as content, null as error_code from message_cases_v where route = 'recovery' and v <> 1
union all select message_id, position, 2, 'error', 'search_messages', null, null, null, null, 'message_not_found' from message_cases_v where route = 'recovery' and v <> 5
union all select message_id, position, case when v = 6 then 9 else 3 end, 'observation', 'list_message_senders', null, case when v = 7 then '{"senders":["Nobody"]}' else '{"senders":["' || sender || '"]}' end, null, null, null from message_cases_v where route in ('directory', 'recovery')
union all select message_id, position, 4, 'observation', 'search_messages', null, '{"message_id":"' || message_id || '","sender":"' || sender || '","body":"' || body || case when v = 4 then '!' else '' end || '"}', null, null, null from message_cases_v
union all select message_id, position, 5, 'state_change', 'create_reminder', null, null, '{"message_id":"' || message_id || '","reminder_text":"' || reminder_text || '","remind_at":"' || case when v = 8 then 'later' else remind_at end || '"}', null, null from message_cases_v where action = 'create_reminder' and v <> 1
union all select message_id, position, 5, 'state_change', 'create_draft_reply', null, null, '{"message_id":"' || message_id || '","content":"' || reply || '"}', null, null from message_cases_v where action = 'create_draft_reply' and v <> 1
union all select message_id, position, 6, 'state_change', 'other_tool', null, null, '{"name":"x"}', null, null from message_cases_v where v = 10
union all select message_id, position, 7, 'observation', 'get_reminder', null, '{"message_id":"' || message_id || '","reminder_text":"' || reminder_text || '","remind_at":"' || remind_at || '"}', null, null, null from message_cases_v where action = 'create_reminder' and route = 'verify' and v <> 11
union all select message_id, position, 7, 'observation', 'get_draft_reply', null, '{"message_id":"' || message_id || '","content":"' || reply || '"}', null, null, null from message_cases_v where action = 'create_draft_reply' and route = 'verify' and v <> 11
union all select message_id, position, 10, 'final_response', null, null, null, null, case when v = 3 then 'nothing' else 'From ' || upper(sender) || ': ' || body || ' ' || coalesce(reminder_text, reply) || ' ' || coalesce(remind_at, '') end, null from message_cases_v""",
    "workspace_cases_v": """
select i.item_id, i.kind, i.summary, i.project_id, lower(i.summary) as query, s.position, s.action, s.route, s.task_constraint, s.comment_constraint, case when s.action = 'create_workspace_task' then 'high' end as priority,
    case when s.action = 'create_workspace_task' then 'next_week' end as due_label, case when s.task_constraint = 'exact' then 'Prepare ' || i.summary || ' retrospective' end as title,
    case when s.comment_constraint = 'exact' then 'Status: ' || lower(i.summary) || ' is ready for review.' end as exact_comment, case when s.route = 'missing' then 'archived roadmap' end as missing_query, case when s.route = 'missing' then 'document' end as missing_kind,
    (length(i.item_id) + length(i.summary) + cast(substr(i.item_id, 2) as bigint) + s.position) % 12 as v
from items_v i cross join (values (0, 'search_workspace_items', 'direct', 'none', 'none'), (1, 'search_workspace_items', 'directory', 'none', 'none'), (2, 'search_workspace_items', 'recovery', 'none', 'none'), (3, 'search_workspace_items', 'missing', 'none', 'none'),
    (4, 'create_workspace_task', 'direct', 'exact', 'none'), (5, 'create_workspace_task', 'verify', 'open', 'none'), (6, 'add_workspace_comment', 'direct', 'none', 'open'), (7, 'add_workspace_comment', 'recovery', 'none', 'exact'), (8, 'add_workspace_comment', 'verify', 'none', 'open')) s(position, action, route, task_constraint, comment_constraint)""",
    "workspace_texts_v": """
select c.*, case when action = 'search_workspace_items' then 'not_applicable' when v = 2 then 'rejected' else 'authorized' end as mutation_authorization, 'workspace-task-' || substr(SHA('["' || item_id || '","' || new_title || '"]'), 1, 24) as task_id,
    'workspace-comment-' || substr(SHA('["' || item_id || '","' || new_comment || '"]'), 1, 24) as comment_id
from (select w.*, case when v = 8 then 'Short' else 'Prepare ' || summary || ' retrospective' end as new_title, case when v = 9 then 'Done it all now' else 'Status: ' || query || ' is ready for review.' end as new_comment from workspace_cases_v w) c""",
    "workspace_events_v": """
select item_id, position, 1 as idx, 'action' as event_type, 'search_workspace_items' as tool_name, case when route = 'missing' then '{"query":"archived roadmap","kind":"document"}' else '{"query":"' || query || ' (stale)","kind":"' || kind || '"}' end as arguments, null as observation, null as change, null as content, null as error_code
    from workspace_texts_v where route in ('recovery', 'missing') and v <> 1
union all select item_id, position, 2, 'error', 'search_workspace_items', null, null, null, null, case when v = 5 then 'other_error' else 'item_not_found' end from workspace_texts_v where route in ('recovery', 'missing')
union all select item_id, position, case when v = 6 then 9 else 3 end, 'observation', 'list_workspace_projects', null, '{"projects":[]}', null, null, null from workspace_texts_v where route = 'directory'
union all select item_id, position, 4, 'observation', 'search_workspace_items', null, '{"item_id":"' || item_id || '","kind":"' || kind || '","summary":"' || summary || case when v = 4 then '!' else '' end || '"}', null, null, null from workspace_texts_v where route <> 'missing'
union all select item_id, position, 5, 'state_change', 'create_workspace_task', null, null, '{"task_id":"' || task_id || '","project_id":"' || item_id || '","title":"' || new_title || '","priority":"' || case when v = 7 then 'low' else 'high' end || '","due_label":"next_week"}', null, null from workspace_texts_v where action = 'create_workspace_task' and v <> 1
union all select item_id, position, 5, 'state_change', 'add_workspace_comment', null, null, '{"comment_id":"' || comment_id || '","task_id":"' || item_id || '","comment":"' || new_comment || '"}', null, null from workspace_texts_v where action = 'add_workspace_comment' and v <> 1
union all select item_id, position, 6, 'state_change', 'other_tool', null, null, '{"name":"x"}', null, null from workspace_texts_v where v = 10
union all select item_id, position, 7, 'observation', 'get_workspace_task', null, '{"task_id":"' || task_id || '","project_id":"' || item_id || '","title":"' || new_title || '","priority":"high","due_label":"next_week"}', null, null, null from workspace_texts_v where action = 'create_workspace_task' and route = 'verify' and v <> 11
union all select item_id, position, 7, 'observation', 'get_workspace_comment', null, '{"comment_id":"' || comment_id || '","task_id":"' || item_id || '","comment":"' || new_comment || '"}', null, null, null from workspace_texts_v where action = 'add_workspace_comment' and route = 'verify' and v <> 11
union all select item_id, position, 10, 'final_response', null, null, null, null, case when v = 3 then 'nothing' when route = 'missing' then 'The document Archived Roadmap is unavailable.' else 'The ' || kind || ' ' || query || ': ' || new_title || ' high next_week ' || task_id || ' ' || new_comment end, null from workspace_texts_v""",
    "payloads_v": """
select o_orderkey as k, '{"z": [1, {"k": ' || cast(o_orderkey as varchar(20)) || ', "b": "' || case when o_orderkey % 3 = 0 then 'see /home/x' else 'fine' end || '"}], "status": "' || o_orderstatus || '", "n": 2.50, "on" : true, "none":null, "Session_id": {"a": [1, 2]}, "provider_id": "p", "sub": {"'
    || case when o_orderkey % 4 = 0 then 'api_key' else 'plain' end || '": {"deep": "' || case when o_orderkey % 5 = 0 then 'my Password' else 'ok' end || '"}, "list": [[], ["' || case when o_orderkey % 7 = 0 then 'go ~/x' else 'x y' end || '"]]}, "priority": "' || o_orderpriority || '"}' as payload from orders""",
    "runs_v": """
select s_suppkey as run_id, s_suppkey % 11 = 0 as cancelled, case s_suppkey % 7 when 0 then 'provider_request_budget_exhausted' when 1 then 'scheduler_no_progress' end as stop_reason, case when s_suppkey % 4 <> 0 then 10 + s_suppkey % 20 end as accepted_target,
    s_suppkey % 30 as accepted_count, s_suppkey % 50 as allocated_count, 25 as slot_limit, case when s_suppkey % 5 <> 0 then s_suppkey % 60 end as known_task_capacity from supplier""",
    "messages_v": """
select doc_id as message_id, source as sender, text as body, length(text) as body_length from documents""",
    "items_v": """
select 'project' as kind, 'p' || cast(r_regionkey as varchar(20)) as item_id, r_name as summary, null as project_id from region
union all select 'task', 't' || cast(n_nationkey as varchar(20)), n_name, 'p' || cast(n_regionkey as varchar(20)) from nation
union all select 'document', 'd' || cast(p_partkey as varchar(20)), p_name, 'p' || cast(p_size % 7 as varchar(20)) from part
union all select 'comment', 'c' || cast(s_suppkey as varchar(20)), s_name, 't' || cast(s_nationkey as varchar(20)) from supplier""",
    "labels_long_v": """
select l.doc_id as episode_id, d.dimension, d.position,
    case when d.position = 5 and l.toxic = 1 then 'fail' when l.quality = 0 and (l.doc_id + d.position) % 3 = 0 then 'fail' when (l.doc_id + d.position) % 11 = 0 then 'uncertain' else 'pass' end as verdict
from labels l cross join (
    select 'instruction_fidelity' as dimension, 1 as position union all select 'action_efficiency', 2 union all select 'observation_grounding', 3
    union all select 'final_response_quality', 4 union all select 'safety', 5) d""",
    "usage_big_v": """
select l_orderkey * 8 + l_linenumber as request_id, l_orderkey as sequence,
    case l_returnflag when 'A' then 'task_generation' when 'R' then 'quality_judge' else 'agent' end as role,
    case l_linestatus when 'O' then 'completed' else 'reserved' end as status,
    case when l_linenumber = 7 then 'repair' else 'initial' end as request_kind,
    cast(l_orderkey as varchar(20)) || ':' || cast(l_linenumber % 4 as varchar(4)) as logical_request_id,
    case when l_linenumber % 5 = 0 then null else cast(floor(l_quantity * 10) as bigint) end as total_tokens
from lineitem""",
}
#: Small tables of whose rows the views make many: a file of theirs is read by one task, so rows are dealt over tasks first.
DEALT = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations")


def _calls(sql: str, name: str, build) -> str:
    """Replace each call NAME(arguments) by build(arguments); parentheses nest."""
    while (m := re.search(rf"\b{name}\(", sql)) is not None:
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[: m.start()] + build(sql[m.end() : end - 1]) + sql[end:]
    return sql


def for_oracle(sql: str) -> str:
    sql = _calls(sql, "SHA", lambda a: f"sha256({a})")
    return _calls(sql, "JSON", lambda a: f"json_extract_string({a})")


def nested(sql: str) -> str:
    """``sql`` with the views that it names, and those that they name, in place."""
    while (m := re.search(r"\b(from|join) (" + "|".join(VIEWS) + r")\b", sql)) is not None:
        sql = f"{sql[: m.start()]}{m[1]} ({VIEWS[m[2]]}){sql[m.end() :]}"
    return sql


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the tables in ``sf_dir``."""
    sql = _calls(nested(VIEWS[name]), "SHA", lambda a: f"sha2({a}, 256)")
    sql = _calls(sql, "JSON", lambda a: f"get_json_object({a})")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b(from|join) {t}\b", sql)}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables |= {t: tables[t].repartition(tasks, key) for t, key in DEALT.items() if t in tables}
    return spark.sql(re.sub(r"\b(from|join) (" + "|".join(tables) + r")\b", r"\1 {\2}", sql.replace("{", "{{").replace("}", "}}")), **tables)


def with_views(sql: str) -> str:
    """An oracle query with the views that it names in front."""
    names = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    views = ",\n".join(f"{v} as ({for_oracle(nested(VIEWS[v]))}\n)" for v in names)
    body = for_oracle(sql.strip())
    if not names:
        return body
    return f"with {views},\n{body[5:]}" if body.lower().startswith("with ") else f"with {views}\n{body}"
