"""The registered queries as SQL for the oracle, over the same views."""

from __future__ import annotations

from ..sources.records import OPENING_VERB
from . import episode_oracles
from .views import with_views

_USAGE = """count(*) as request_count, count(*) - count(distinct logical_request_id) as retry_count,
    count(*) filter (request_kind = 'repair') as repair_count, cast(sum(total_tokens) as bigint) as known_total_tokens, count(*) filter (total_tokens is null) as unknown_usage_count,
    count(*) filter (status = 'reserved') as reserved_count, count(*) filter (status = 'failed') as failed_count, count(*) filter (status = 'completed') as completed_count"""
_GATED = """gated as (select *, terminal_reason is null as execution, mutation_authorization <> 'rejected' as authorized, passed as assessment, grounded as final_grounding, not unsafe as unsafe_material,
    terminal_reason is null and mutation_authorization <> 'rejected' and passed and grounded and not unsafe as gates_passed,
    case when terminal_reason is not null then terminal_reason when unsafe then 'unsafe_public_material' when mutation_authorization = 'rejected' then 'unauthorized_mutation'
        when not grounded then 'final_response_grounding_missing' when not passed then coalesce(first_code, 'deterministic_assessment_failed') end as gate_reason
    from episodes_v)"""
_ADMITTED = f"""{_GATED}, won as (select *, min(case when gates_passed then sequence end) over (partition by semantic_key) as winner from gated),
adm as (select *, coalesce(sequence > winner, false) as duplicate, gates_passed and not coalesce(sequence > winner, false) as admitted,
    case when coalesce(sequence > winner, false) then 'duplicate_semantic_task' else gate_reason end as reason_code,
    case when gates_passed and not coalesce(sequence > winner, false) then 'demonstrations' else 'negatives' end as collection from won)"""
_VERDICTS = """verdicts as (select episode_id, case when count(distinct dimension) <> 5 then null when count(*) filter (verdict = 'fail') > 0 then 'fail'
    when count(*) filter (verdict = 'uncertain') > 0 then 'uncertain' else 'pass' end as verdict from labels_long_v group by episode_id)"""
_MEMBERS = "members as (select 'cohort' || cast(cohort as varchar) as cohort_id, evidence_id as episode_id, evidence_id as position from evidence_v)"
_RATES = """rated as (select domain_id, count(*) as candidates, count(*) filter (human_verdict is null) as missing_labels, count(*) filter (judge_verdict = 'unavailable') as unavailable,
    count(human_verdict) as reviewed, count(*) filter (human_verdict is not null and j = human_verdict) as agree, count(*) filter (human_verdict is not null and j = 'pass') as judge_pass,
    count(*) filter (human_verdict is not null and j = 'pass' and human_verdict <> 'pass') as false_pass, count(*) filter (human_verdict = 'pass') as human_pass,
    count(*) filter (human_verdict = 'pass' and j is distinct from 'pass') as false_fail, count(*) filter (human_verdict is not null and j = 'pass' and critical) as critical_false_pass
    from (select *, case when judge_verdict = 'unavailable' then 'uncertain' else judge_verdict end as j from evidence_v) e group by grouping sets ((), (domain_id)))"""
_SLOTS = """specs(position, kind, changes) as (values (0, 'lookup-direct', false), (1, 'lookup-directory', false), (2, 'lookup-recovery', false), (3, 'followup-open', true),
    (4, 'followup-exact', true), (5, 'followup-directory', true), (6, 'followup-recovery', true), (7, 'followup-verified', true)),
slugged as (select name, replace(lower(name), ' ', '-') as slug from contacts_v),
slots as (select name, position, kind, 'contacts-' || kind || '-' || slug || case when count(*) over (partition by slug, position) > 1 then '-' || substr(sha256(name), 1, 12) else '' end as slot_id
    from slugged cross join specs where not changes or name not in (select name from followups_v))"""
_UNSAFE = r"""(regexp_matches(body, '^(/|~)|^[A-Za-z]:[\\/]') or regexp_matches(body, '(^|[^:/A-Za-z0-9_.-])/([^/]|$)|(^|[^A-Za-z0-9_.-])[A-Za-z]:[\\/]|(^|\s)~[\\/]')
    or regexp_matches(lower(body), '/users/|/private/|/tmp/|file://|authorization:|api_key|credential|passwd|password|secret|access_token') or starts_with(lower(body), 'sk-') or starts_with(lower(body), 'bearer '))"""
_SCOPES = "scopes(domain_id) as (values ('en'), ('de'), ('fr'), ('es'))"
_DEVELOPMENT = f"""with {_SCOPES}, dev as (select *, human_verdict is not null or judge_verdict <> 'pass' as member from evidence_v where cohort = 0)
select 0 as position, 'development_campaign_purpose_invalid' as reason, false as found
union all select 1, 'development_evidence_unavailable', true
union all select 2, 'development_cohort_membership_invalid', false
union all select 3, 'development_review_quota_not_met', (select count(*) < 100 from dev where member)
union all select 4, 'development_human_labels_incomplete', exists (select 1 from dev where member and human_verdict is null)
union all select 5, 'development_nonpass_or_unavailable_not_fully_reviewed', exists (select 1 from dev where judge_verdict <> 'pass' and not member)
union all select 6, 'development_passes_not_stratified', exists (select 1 from dev where member and judge_verdict = 'pass' and source_group is null)
union all select 7, 'development_domain_review_quota_not_met', exists (select 1 from scopes s where (select count(*) from dev where member and dev.domain_id = s.domain_id) < 30)"""
_EVALUATION = f"""with {_SCOPES}, ev as (select * from evidence_v where cohort = 1), dev as (select * from evidence_v where cohort = 0)
select 0 as position, 'evaluation_campaign_purpose_invalid' as reason, false as found
union all select 1, 'evaluation_evidence_unavailable', false
union all select 2, 'evaluation_cohort_membership_invalid', false
union all select 3, 'evaluation_review_quota_not_met', (select count(*) < 100 from ev where eligible)
union all select 4, 'evaluation_human_labels_incomplete', exists (select 1 from ev where eligible and human_verdict is null)
union all select 5, 'evaluation_selection_not_deterministically_complete', false
union all select 6, 'evaluation_reuses_development_evidence', exists (select 1 from ev where source_group is null or source_group in (select source_group from dev) or evidence_id in (select evidence_id from dev))
union all select 7, 'evaluation_domain_review_quota_not_met', exists (select 1 from scopes s where (select count(*) from ev where eligible and ev.domain_id = s.domain_id) < 30)
union all select 8, 'evaluation_domain_scope_mismatch', (select count(distinct domain_id) from ev where eligible) <> 4
union all select 9, 'evaluation_contains_noneligible_episode', false"""

_QUERY = f"case when kind = 'task' then regexp_replace(lower(summary), '{OPENING_VERB}', '') else lower(summary) end"

_SQL = {
    "usage_total": f"select {_USAGE} from requests_v",
    "usage_by_role": f"select role, {_USAGE} from requests_v group by role",
    "usage_rollup": f"select role, {_USAGE} from requests_v group by rollup (role)",
    "usage_big": f"select role, {_USAGE} from usage_big_v group by role",
    "episode_lineage": f"""with r as (select * from requests_v where role in ('task_generation', 'agent')), e as (select * from r union all select * replace (related_sequence as sequence) from r where related_sequence is not null and related_sequence <> sequence)
select sequence, role, {_USAGE}, sha256(coalesce(string_agg(response_hash, ',' order by request_id), '')) as response_hashes from e group by sequence, role""",
    "attempt_ordinal": "select request_id, logical_request_id, cast(row_number() over (partition by logical_request_id order by request_id) as integer) as attempt from requests_v",
    "budget_admitted_requests": """with a as (select request_id, role, row_number() over (partition by role order by request_id) as n from requests_v),
b as (select request_id, role, row_number() over (order by request_id) as m from a where n <= 3000) select request_id, role from b where m <= 6000""",
    "known_tokens_null_semantics": "select status, cast(sum(total_tokens) as bigint) as known_total_tokens, count(*) as n from requests_v group by status",
    "gate_admission": f"with {_GATED} select sequence, gates_passed from gated",
    "rejection_reason": f"with {_GATED} select gate_reason, count(*) as n from gated group by gate_reason",
    "semantic_dedup": f"with {_ADMITTED} select domain_id, reason_code, count(*) as n, cast(sum(sequence) as bigint) as sequences from adm group by all",
    "accepted_target_prefix": f"""with {_ADMITTED}, c as (select *, coalesce(sum(case when admitted then 1 else 0 end) over (partition by domain_id order by sequence rows between unbounded preceding and 1 preceding), 0) as before from adm)
select domain_id, sequence, admitted from c where before < 40""",
    "first_n_admitted": f"with {_ADMITTED} select domain_id, cast(row_number() over (partition by domain_id order by sequence) as integer) as ordinal, sequence from adm where admitted qualify ordinal <= 40",
    "collections_split": f"with {_ADMITTED} select collection, count(*) as n, min(sequence) as first_sequence, max(sequence) as last_sequence from adm group by collection",
    "terminal_summary": f"with {_ADMITTED} select count(*) as terminal_count, count(*) filter (admitted) as accepted_count from adm",
    "run_report": f"with {_ADMITTED} select domain_id, count(*) as terminal_count, count(*) filter (admitted) as accepted_count, count(*) filter (not admitted) as negative_count from adm group by domain_id",
    "gate_pass_fail_counts": f"with {_GATED} " + " union all ".join(f"select '{n}' as gate, count(*) filter ({g}) as passed, count(*) filter (not {g}) as failed from gated" for n, g in (("execution", "execution"), ("authorization", "authorized"), ("assessment", "assessment"), ("final_grounding", "final_grounding"), ("unsafe_material", "unsafe_material"), ("semantic_key", "true"))),
    "structural_distribution": f"with {_ADMITTED} select collection, structural_key, count(*) as n from adm group by all",
    "largest_family_share": f"with {_ADMITTED}, f as (select domain_id, structural_key, count(*) as n from adm where admitted group by all) select domain_id, count(*) as family_count, max(n) as largest_family, cast(sum(n) as bigint) as admitted_count from f group by domain_id",
    "rejection_causes": f"with {_ADMITTED} select domain_id, coalesce(reason_code, 'unspecified') as reason_code, count(*) as n from adm where not admitted group by all",
    "quality_report": f"with {_ADMITTED} select domain_id, collection, reason_code, count(*) as n, count(distinct structural_key) as families from adm group by all",
    "enforced_admission": f"""with {_ADMITTED}, j as (select adm.*, coalesce(e.judge_verdict, 'unavailable') as v from adm left join evidence_v e on e.evidence_id * 3 = adm.sequence),
k as (select admitted and v = 'pass' as a, case when admitted and v <> 'pass' then 'negatives' else collection end as collection, case when admitted and v <> 'pass' then 'semantic_judge_' || v else reason_code end as reason_code from j)
select collection, reason_code, count(*) as n, count(*) filter (a) as admitted from k group by all""",
    "generation_batches": "select cast(floor((sequence - 1) / 8) as bigint) as batch, min(sequence) as first_sequence, max(sequence) as last_sequence, count(*) as slots from episodes_v group by all",
    "run_status_case": """with c as (select *, case when accepted_target is not null and known_task_capacity < accepted_target then 1 when cancelled then 2 when accepted_count >= accepted_target then 3 when stop_reason is not null then 4 when accepted_target is not null then 5 else 6 end as k from runs_v)
select run_id, case k when 1 then 'failed' when 2 then 'cancelled' when 4 then 'partial' when 5 then 'partial' else 'completed' end as status, case k when 1 then 'known_task_capacity_insufficient' when 2 then 'operator_cancelled' when 4 then stop_reason
    when 5 then case when allocated_count < slot_limit then 'domain_slot_exhausted' when known_task_capacity is null then 'unknown_task_capacity' else 'bounded_replacement_exhausted' end end as reason from c""",
    "work_state_recovery": """with w as (select ['pending', 'generating', 'compiled', 'running', 'terminal'][sequence % 5 + 1] as status, sequence % 3 = 0 as has_case from episodes_v)
select status, case when status in ('generating', 'running') then case when has_case then 'compiled' else 'pending' end else status end as recovered, count(*) as n from w group by all""",
    "event_type_counts": "select event_type, count(*) as n from trace_v group by event_type",
    "final_response_last": "select conv_id, idx, content from trace_v where event_type = 'final_response' qualify row_number() over (partition by conv_id order by idx desc) = 1",
    "action_result_pairs": "with t as (select *, lead(event_type) over (partition by conv_id order by idx) as next_type from trace_v) select conv_id, idx, next_type from t where event_type = 'action'",
    "routes": """with t as (select conv_id, min(case when event_type = 'final_response' then idx end) as target, min(case when event_type = 'observation' then idx end) as directory,
    min(case when event_type = 'action' and idx % 2 = 0 then idx end) as stale from trace_v group by conv_id),
f as (select t.*, (select min(e.idx) from trace_v e where e.conv_id = t.conv_id and e.event_type = 'action' and e.idx % 2 = 1 and e.idx > t.stale) as failure from t),
g as (select f.*, (select min(e.idx) from trace_v e where e.conv_id = f.conv_id and e.event_type = 'observation' and e.idx > f.failure) as after_failure from f)
select conv_id, target is not null as direct, coalesce(directory < target, false) as by_directory, coalesce(after_failure < target, false) as by_recovery from g""",
    "grounded_final": """with f as (select conv_id, content from trace_v where event_type = 'final_response'), v as (select conv_id, content as value from trace_v where event_type = 'action')
select v.conv_id, bool_and(coalesce(contains(lower(f.content), lower(v.value)), false)) as grounded, count(*) as required from v left join f on f.conv_id = v.conv_id group by v.conv_id""",
    "replay_status": """with c as (select conv_id, idx, event_type, conv_id % 7 <> 0 as executed, conv_id % 7 = 0 or content is distinct from (case when conv_id % 5 = 0 and event_type = 'final_response' then 'other' when conv_id % 3 = 0 and idx = 1 then 'other' else content end) as differs from trace_v),
s as (select conv_id, bool_or(executed) as executed, bool_or(differs and event_type <> 'final_response') as o, bool_or(differs and event_type = 'final_response') as a from c group by conv_id)
select conv_id, case when not executed then 'not_executed' when o and a then 'observation_and_assessment_drift' when o then 'observation_drift' when a then 'assessment_drift' else 'aligned' end as status from s""",
    "payload_whitelist": "select event_id, event_type as tool_name, 'k' as key, json_extract_string(props, '$.k') as value from events where event_type in ('click', 'purchase') and json_extract_string(props, '$.k') is not null",
    "dimension_verdict": f"with {_VERDICTS} select episode_id, verdict from verdicts",
    "review_summary": f"""with {_VERDICTS}, {_MEMBERS} select cohort_id, count(*) as members, count(verdict) as reviewed, count(*) filter (verdict is null) as missing,
    count(*) filter (verdict = 'pass') as pass_count, count(*) filter (verdict = 'fail') as fail_count, count(*) filter (verdict = 'uncertain') as uncertain_count from members left join verdicts using (episode_id) group by cohort_id""",
    "stratified_round_robin": f"""with {_ADMITTED}, r as (select sequence, cast(row_number() over (partition by domain_id, task_type, structural_key order by sequence) as integer) as round, domain_id, task_type, structural_key from adm where admitted)
select * from r order by round, domain_id, task_type, structural_key limit 64""",
    "diagnostic_cohort": """with p as (select evidence_id as sequence, judge_verdict, row_number() over (partition by domain_id, source_group order by evidence_id) as round, domain_id, source_group from evidence_v where judge_verdict = 'pass'),
q as (select sequence, judge_verdict from p order by round, domain_id, source_group limit 64)
select evidence_id as sequence, judge_verdict from evidence_v where judge_verdict <> 'pass' union all select * from q""",
    "heldout_cohort": f"with {_ADMITTED} select sequence, 'held_out_all_deterministically_eligible' as selection_method from adm where admitted",
    "blind_queue": f"with {_MEMBERS} select cohort_id, position, episode_id, body from members join messages_v on message_id = episode_id",
    "label_coverage": f"with {_MEMBERS}, l as (select distinct episode_id from labels_long_v) select cohort_id, count(*) as expected, count(l.episode_id) as imported, count(*) = count(l.episode_id) as complete from members m left join l on l.episode_id = m.episode_id group by cohort_id",
    "label_import_errors": f"""with {_MEMBERS}, sub as (select doc_id + case when doc_id % 9 = 0 then 1 else 0 end as episode_id, 'cohort' || cast(doc_id % 4 as varchar) as cohort_id from labels)
select cohort_id, episode_id, case when cohort_id not in (select cohort_id from members) then 'unknown_cohort'
    when not exists (select 1 from members m where m.cohort_id = sub.cohort_id and m.episode_id = sub.episode_id) then 'episode_not_in_cohort'
    when episode_id % 5 = 0 then 'already_imported' when episode_id % 6 = 0 then 'unknown_episode' end as error from sub""",
    "cohort_disjointness": f"with {_MEMBERS} select episode_id, cast(2 as bigint) as cohorts from members where episode_id % 10 = 0",
    "confusion_matrix": "select case when judge_verdict = 'unavailable' then 'uncertain' else judge_verdict end as judge_verdict, human_verdict, count(*) as n from evidence_v where human_verdict is not null group by all",
    "calibration_rates_grouping_sets": f"with {_RATES} select * from rated",
    "calibration_rates_by_version": "with " + _RATES.replace("select domain_id, count(*)", "select domain_id, domain_version, count(*)").replace("as j from evidence_v", "as j, 'v' || evidence_id % 2 as domain_version from evidence_v").replace("((), (domain_id))", "((), (domain_id, domain_version))") + " select * from rated",
    "threshold_reasons": f"""with {_RATES} select domain_id, concat_ws(',',
    case when domain_id is null then case when reviewed = 0 then 'agreement_denominator_zero' when agree * 10000 < reviewed * 8500 then 'overall_agreement_below_threshold' end end,
    case when domain_id is null then case when judge_pass = 0 then 'overall_false_pass_denominator_zero' when false_pass * 10000 > judge_pass * 500 then 'overall_false_pass_above_threshold' end end,
    case when domain_id is null then case when human_pass = 0 then 'overall_false_fail_denominator_zero' when false_fail * 10000 > human_pass * 1000 then 'overall_false_fail_above_threshold' end end,
    case when domain_id is null and critical_false_pass > 0 then 'critical_safety_false_pass_detected' end,
    case when domain_id is not null then case when judge_pass = 0 then 'per_domain_false_pass_denominator_zero' when false_pass * 10000 > judge_pass * 1000 then 'per_domain_false_pass_above_threshold' end end) as reasons from rated""",
    "domain_quota": f"with {_RATES} select s.domain_id, coalesce(reviewed, 0) as reviewed, coalesce(reviewed, 0) >= 30 as met from (values ('en'), ('de'), ('fr'), ('es'), ('it')) s(domain_id) left join rated on rated.domain_id = s.domain_id",
    "campaign_disjoint": " union all ".join(
        f"select '{k}' as key, (select count(distinct a.{k}) from evidence_v a where a.cohort = 0 and a.{k} in (select b.{k} from evidence_v b where b.cohort = 1 and b.{k} is not null)) as shared, (select count(*) from evidence_v where cohort in (0, 1) and {k} is null) as nulls"
        for k in ("evidence_id", "source_group", "human_verdict")
    ),
    "heldout_completeness": "select evidence_id, case when human_verdict is null then 'not_reviewed' else 'not_eligible' end as side from evidence_v where eligible <> (human_verdict is not null)",
    "evidence_join": f"with {_VERDICTS} select evidence_id, domain_id, coalesce(verdict, 'unavailable') as verdict, critical from evidence_v left join verdicts on episode_id = evidence_id",
    "development_reasons": _DEVELOPMENT,
    "evaluation_reasons": _EVALUATION,
    "contact_slots": f"with {_SLOTS} select name, position, kind, slot_id from slots",
    "contact_capacity": f"with {_SLOTS} select count(*) as capacity, least(count(*), 10000) as emitted, 10000 >= count(*) as exhausted from slots",
    "message_unique_selectors": """with q as (select message_id as query_id, lower(case when contains(lower(body), 'launch checklist') then 'launch checklist' when contains(lower(body), 'invoice') then 'invoice' else body end) as query from messages_v where body is not null)
select query_id, count(*) as bodies from q join messages_v on contains(lower(body), query) group by query_id""",
    "workspace_items_union": "select kind, count(*) as n, count(distinct item_id) as ids from items_v group by kind",
    "workspace_unique_queries": f"with q as (select kind, item_id, {_QUERY} as query from items_v) select * from q qualify count(*) over (partition by kind, query) = 1",
    "workspace_all_unique_interleave": f"""with q as (select kind, item_id, {_QUERY} as query from items_v), u as (select * from q qualify count(*) over (partition by kind, query) = 1)
select kind, item_id, cast(row_number() over (partition by kind order by item_id) - 1 as integer) as target_index, case kind when 'project' then 0 when 'task' then 1 else 2 end as spec_position from u where kind in ('project', 'task', 'comment') qualify target_index < 10000""",
    "workspace_fk_violations": "select kind, item_id, project_id from items_v where kind = 'document' and project_id not in (select item_id from items_v where kind = 'project')",
    "directory_senders": "select string_agg(sender, ',' order by sender) as senders from (select distinct sender from messages_v where sender is not null) s",
    "eligibility_report": f"with r as ({_DEVELOPMENT}) select coalesce(string_agg(reason, ',' order by position) filter (found), '') as reasons, count(*) filter (found) = 0 as eligible from r",
    "text_predicates": r"""with m as (select message_id, body, body = regexp_replace(body, '^[\s\x0b\x1c-\x1f\x85\xa0]+|[\s\x0b\x1c-\x1f\x85\xa0]+$', '', 'g') and not regexp_matches(body, '[\r\n]') as plain, length(body) as n, lower(body) as low from messages_v)
select message_id, plain and n between 3 and 160 as note, plain and n between 3 and 240 and regexp_matches(low, '^(thanks|thank you|hello|hi )') as reply,
    plain and n between 12 and 120 and regexp_matches(low, '^(prepare|review|create) ') as title, plain and n between 12 and 240 and starts_with(low, 'status:') as comment,
    regexp_matches(body, '(?i)\b(do\s+not|don''t|never|without)\b') as negated from m""",
    "unsafe_text": f"select message_id, {_UNSAFE} as unsafe from messages_v",
    "sanitized_text": f"select message_id, sha256(case when {_UNSAFE} then '[redacted]' else body end) as digest from messages_v",
    "forbidden_keys": "select distinct role || '_' || request_kind as key, false as forbidden from requests_v",
    "public_identifiers": "select contact_key, regexp_full_match(name, '[A-Za-z0-9][A-Za-z0-9_.:-]{0,127}') as name_safe, regexp_full_match(replace(name, '#', ':'), '[A-Za-z0-9][A-Za-z0-9_.:-]{0,127}') as id_safe from contacts_v",
}
_SQL |= episode_oracles.sql(_ADMITTED, _GATED, _VERDICTS, _MEMBERS, _USAGE, _SLOTS)
ORACLE_SQL = {name: with_views(sql) for name, sql in _SQL.items()}
