"""The registered queries over the test tables' views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import admission, calibration, eligibility, review, sequence, tasks, usage
from .views import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TARGET, BATCH, PASSES = 40, 8, 64
BUDGET, ROLE_BUDGET = 6000, 3000
ROLES = ("task_generation", "agent", "quality_judge")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def gated(s: SparkSession, d: str) -> DataFrame:
    codes = F.when(F.col("first_code").isNotNull(), F.array("first_code")).otherwise(F.array().cast("array<string>"))
    return admission.gate_admission(view(s, d, "episodes_v").withColumn("reason_codes", codes).withColumn("coverage_tags", F.when(F.col("recovery"), F.array(F.lit("lookup"), F.lit("recovery")))))


def admitted(s: SparkSession, d: str) -> DataFrame:
    return admission.semantic_dedup(gated(s, d))


# --- usage


@query
def usage_total(s, d):
    return usage.usage_summary(view(s, d, "requests_v"))


@query
def usage_by_role(s, d):
    return usage.usage_summary(view(s, d, "requests_v"), "role")


@query
def usage_rollup(s, d):
    return usage.usage_rollup(view(s, d, "requests_v"))


@query
def usage_big(s, d):
    return usage.usage_summary(view(s, d, "usage_big_v"), "role")


@query
def episode_lineage(s, d):
    rows = view(s, d, "requests_v").withColumn("related_sequences", F.when(F.col("related_sequence").isNotNull(), F.array("related_sequence")))
    return usage.episode_lineage(rows).withColumn("response_hashes", F.sha2(F.array_join("response_hashes", ","), 256))


@query
def attempt_ordinal(s, d):
    return usage.attempt_ordinals(view(s, d, "requests_v")).select("request_id", "logical_request_id", "attempt")


@query
def budget_admitted_requests(s, d):
    return usage.budget_admitted(view(s, d, "requests_v"), BUDGET, {r: ROLE_BUDGET for r in ROLES}).select("request_id", "role")


@query
def known_tokens_null_semantics(s, d):
    return view(s, d, "requests_v").groupBy("status").agg(F.sum("total_tokens").alias("known_total_tokens"), F.count(F.lit(1)).alias("n"))


# --- admission


@query
def gate_admission(s, d):
    return gated(s, d).select("sequence", "gates_passed")


@query
def rejection_reason(s, d):
    return gated(s, d).groupBy("gate_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def semantic_dedup(s, d):
    return admitted(s, d).groupBy("domain_id", "reason_code").agg(F.count(F.lit(1)).alias("n"), F.sum("sequence").alias("sequences"))


@query
def accepted_target_prefix(s, d):
    return admission.accepted_prefix(admitted(s, d), TARGET).select("domain_id", "sequence", "admitted")


@query
def first_n_admitted(s, d):
    return admission.first_admitted(admitted(s, d), TARGET).select("domain_id", "ordinal", "sequence")


@query
def collections_split(s, d):
    return admitted(s, d).groupBy("collection").agg(F.count(F.lit(1)).alias("n"), F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence"))


@query
def terminal_summary(s, d):
    return admitted(s, d).agg(F.count(F.lit(1)).alias("terminal_count"), F.count_if("admitted").alias("accepted_count"))


@query
def run_report(s, d):
    return admission.run_report(admitted(s, d))


@query
def gate_pass_fail_counts(s, d):
    return admission.gate_counts(gated(s, d))


@query
def structural_distribution(s, d):
    return admitted(s, d).groupBy("collection", "structural_key").agg(F.count(F.lit(1)).alias("n"))


@query
def largest_family_share(s, d):
    return admission.family_share(admitted(s, d))


@query
def rejection_causes(s, d):
    return admission.rejection_causes(admitted(s, d))


@query
def quality_report(s, d):
    return admitted(s, d).groupBy("domain_id", "collection", "reason_code").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("structural_key").alias("families"))


@query
def enforced_admission(s, d):
    judgments = view(s, d, "evidence_v").select((F.col("evidence_id") * 3).alias("sequence"), "judge_verdict")
    return admission.enforced(admitted(s, d), judgments).groupBy("collection", "reason_code").agg(F.count(F.lit(1)).alias("n"), F.count_if("admitted").alias("admitted"))


@query
def generation_batches(s, d):
    return admission.generation_batches(view(s, d, "episodes_v"), BATCH)


@query
def run_status_case(s, d):
    return admission.run_status(view(s, d, "runs_v")).select("run_id", "status", "reason")


@query
def work_state_recovery(s, d):
    work = view(s, d, "episodes_v").select("sequence", F.element_at(F.array(*[F.lit(x) for x in ("pending", "generating", "compiled", "running", "terminal")]), (F.col("sequence") % 5 + 1).cast("int")).alias("status"), (F.col("sequence") % 3 == 0).alias("has_case"))
    return admission.recovered_state(work).groupBy("status", "recovered").agg(F.count(F.lit(1)).alias("n"))


# --- sequences


@query
def event_type_counts(s, d):
    return view(s, d, "trace_v").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def final_response_last(s, d):
    return sequence.final_response(view(s, d, "trace_v"))


@query
def action_result_pairs(s, d):
    return sequence.action_pairs(view(s, d, "trace_v")).select("conv_id", "idx", "next_type")


@query
def routes(s, d):
    kind = lambda name, even=None: lambda e: (e["event_type"] == name) & (F.lit(True) if even is None else (e["idx"] % 2 == even))
    return sequence.route_completion(sequence.traces(view(s, d, "trace_v")), kind("final_response"), kind("observation"), kind("action", 0), kind("action", 1))


@query
def grounded_final(s, d):
    events = view(s, d, "trace_v")
    values = events.where("event_type = 'action'").select("conv_id", F.col("content").alias("value"))
    return sequence.grounded(sequence.final_response(events), values)


@query
def replay_status(s, d):
    saved = view(s, d, "trace_v")
    again = saved.where(F.col("conv_id") % 7 != 0).withColumn("content", F.when((F.col("conv_id") % 5 == 0) & (F.col("event_type") == "final_response"), "other").when((F.col("conv_id") % 3 == 0) & (F.col("idx") == 1), "other").otherwise(F.col("content")))
    return sequence.replay_status(saved, again)


@query
def payload_whitelist(s, d):
    events = s.read.parquet(f"{d}/events.parquet")
    payloads = events.select("event_id", F.col("event_type").alias("tool_name"), F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    declared = s.createDataFrame([("click", "k"), ("purchase", "k"), ("view", "j")], "tool_name string, key string")
    return sequence.whitelisted(payloads, declared).select("event_id", "tool_name", "key", "value")


# --- review


def cohort_members(s, d):
    return view(s, d, "evidence_v").select(F.concat(F.lit("cohort"), F.col("cohort").cast("string")).alias("cohort_id"), F.col("evidence_id").alias("episode_id"), F.col("evidence_id").alias("position"))


@query
def dimension_verdict(s, d):
    return review.dimension_verdict(view(s, d, "labels_long_v"))


@query
def review_summary(s, d):
    return review.review_summary(cohort_members(s, d), review.dimension_verdict(view(s, d, "labels_long_v")))


@query
def stratified_round_robin(s, d):
    rows = admitted(s, d).where("admitted")
    return review.round_robin(rows, ["domain_id", "task_type", "structural_key"], PASSES).select("sequence", "round", "domain_id", "task_type", "structural_key")


@query
def diagnostic_cohort(s, d):
    judged = view(s, d, "evidence_v").withColumnRenamed("evidence_id", "sequence")
    return review.diagnostic_cohort(judged, ["domain_id", "source_group"], PASSES).select("sequence", "judge_verdict")


@query
def heldout_cohort(s, d):
    return review.held_out_cohort(admitted(s, d)).select("sequence", "selection_method")


@query
def blind_queue(s, d):
    episodes = view(s, d, "messages_v").select(F.col("message_id").alias("episode_id"), "body")
    return review.blind_queue(cohort_members(s, d), episodes, ["body"])


@query
def label_coverage(s, d):
    members = cohort_members(s, d)
    labels = members.join(view(s, d, "labels_long_v").select("episode_id").distinct(), "episode_id", "left_semi")
    return review.label_coverage(members, labels)


@query
def label_import_errors(s, d):
    members = cohort_members(s, d)
    labels = s.read.parquet(f"{d}/labels.parquet").select((F.col("doc_id") + F.when(F.col("doc_id") % 9 == 0, 1).otherwise(0)).alias("episode_id"), F.concat(F.lit("cohort"), (F.col("doc_id") % 4).cast("string")).alias("cohort_id"))
    imported = labels.where(F.col("episode_id") % 5 == 0)
    episodes = members.where(F.col("episode_id") % 6 != 0).select("episode_id")
    return review.label_errors(labels, members, imported, episodes)


@query
def cohort_disjointness(s, d):
    members = cohort_members(s, d)
    more = members.where(F.col("episode_id") % 10 == 0).withColumn("cohort_id", F.lit("cohort9"))
    return review.shared_members(members.unionByName(more))


# --- calibration


@query
def confusion_matrix(s, d):
    return calibration.confusion(view(s, d, "evidence_v"))


@query
def calibration_rates_grouping_sets(s, d):
    return calibration.rates(view(s, d, "evidence_v"))


@query
def calibration_rates_by_version(s, d):
    rows = view(s, d, "evidence_v").withColumn("domain_version", F.concat(F.lit("v"), (F.col("evidence_id") % 2).cast("string")))
    return calibration.rates(rows, "domain_id", "domain_version")


@query
def threshold_reasons(s, d):
    return calibration.threshold_reasons(calibration.rates(view(s, d, "evidence_v")))


@query
def domain_quota(s, d):
    scopes = s.createDataFrame([("en",), ("de",), ("fr",), ("es",), ("it",)], "domain_id string")
    return calibration.domain_quota(scopes, calibration.rates(view(s, d, "evidence_v")))


@query
def campaign_disjoint(s, d):
    rows = view(s, d, "evidence_v")
    return calibration.disjoint(rows.where("cohort = 0"), rows.where("cohort = 1"), ["evidence_id", "source_group", "human_verdict"])


@query
def heldout_completeness(s, d):
    rows = view(s, d, "evidence_v")
    return calibration.selection_gaps(rows.where("eligible"), rows.where("human_verdict is not null"), "evidence_id")


@query
def evidence_join(s, d):
    verdicts = review.dimension_verdict(view(s, d, "labels_long_v")).withColumnRenamed("episode_id", "evidence_id")
    return view(s, d, "evidence_v").join(verdicts, "evidence_id", "left").select("evidence_id", "domain_id", F.coalesce("verdict", F.lit("unavailable")).alias("verdict"), "critical")


def campaigns(s, d):
    evidence = view(s, d, "evidence_v").withColumn("task_type", F.lit("t")).withColumnRenamed("source_group", "structural_family")
    scopes = s.createDataFrame([("en",), ("de",), ("fr",), ("es",)], "domain_id string")
    return evidence.where("cohort = 0"), evidence.where("cohort = 1"), scopes


@query
def development_reasons(s, d):
    development, _, scopes = campaigns(s, d)
    members = development.where("human_verdict is not null or judge_verdict <> 'pass'").select("evidence_id")
    return eligibility.development_reasons(members, development, scopes, "diagnostic-development", 1, eligibility.STRATIFIED)


@query
def evaluation_reasons(s, d):
    development, evaluation, scopes = campaigns(s, d)
    members = evaluation.where("eligible").select("evidence_id")
    return eligibility.evaluation_reasons(members, evaluation, development, scopes, "held-out-evaluation", 0, ["evidence_id", "structural_family"])


# --- tasks


def contact_task_space(s, d):
    return tasks.contact_slots(view(s, d, "contacts_v").select("name"), view(s, d, "followups_v"))


@query
def contact_slots(s, d):
    return contact_task_space(s, d)


@query
def contact_capacity(s, d):
    return tasks.capacity(contact_task_space(s, d), 10_000)


@query
def message_unique_selectors(s, d):
    return tasks.message_query_counts(view(s, d, "messages_v"))


@query
def workspace_items_union(s, d):
    return view(s, d, "items_v").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_id").alias("ids"))


@query
def workspace_unique_queries(s, d):
    return tasks.unique_queries(view(s, d, "items_v")).select("kind", "item_id", "query")


@query
def workspace_all_unique_interleave(s, d):
    items = tasks.unique_queries(view(s, d, "items_v"))
    return tasks.interleaved(items, ["project", "task", "comment"]).select("kind", "item_id", "target_index", "spec_position")


@query
def workspace_fk_violations(s, d):
    return tasks.foreign_key_violations(view(s, d, "items_v"), "document", "project")


@query
def directory_senders(s, d):
    return view(s, d, "messages_v").agg(F.array_join(F.array_sort(F.collect_set("sender")), ",").alias("senders"))


# --- text


@query
def text_predicates(s, d):
    body = F.col("body")
    return view(s, d, "messages_v").select("message_id", T.note_allowed(body).alias("note"), T.reply_allowed(body).alias("reply"), T.title_allowed(body).alias("title"), T.comment_allowed(body).alias("comment"), T.negated_text(body).alias("negated"))


@query
def unsafe_text(s, d):
    return view(s, d, "messages_v").select("message_id", T.forbidden_text(F.col("body")).alias("unsafe"))


@query
def sanitized_text(s, d):
    return view(s, d, "messages_v").select("message_id", F.sha2(T.sanitized(F.col("body")), 256).alias("digest"))


@query
def forbidden_keys(s, d):
    return view(s, d, "requests_v").select(F.concat("role", F.lit("_"), "request_kind").alias("key")).distinct().select("key", T.forbidden_key(F.col("key")).alias("forbidden"))


@query
def public_identifiers(s, d):
    return view(s, d, "contacts_v").select("contact_key", T.safe_identifier(F.col("name")).alias("name_safe"), T.safe_identifier(F.replace(F.col("name"), F.lit("#"), F.lit(":"))).alias("id_safe"))


from . import episodes  # noqa: E402, F401  (registers the queries of the domains)
