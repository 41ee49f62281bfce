"""A whole offline run at scale: task space, rollouts, assessment, admission and reports of so many attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import admission, assessment, cases, reports, rollout
from .episodes import call, final, responded


def table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """A run's table, written once: later steps read it and don't plan anew what made it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def attempts(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """``n`` attempts of contact tasks, eight for a contact, of which some go wrong; admitted or not, by sequence.  Traces and outcomes are tables in ``folder``."""
    contacts = spark.range(-(-n // 8)).select(F.format_string("Person %07d", "id").alias("name"), F.format_string("p%07d@example.test", "id").alias("email"))
    made = cases.contact_cases(contacts, contacts.limit(0).select("name"))
    made = made.withColumn("sequence", F.regexp_extract("target", "([0-9]+)", 1).cast("long") * 8 + F.col("position") + 1).where(F.col("sequence") <= n)
    c, k = F.col, F.col("sequence")
    far, writes, note = c("route").isin("directory", "recovery"), c("action") == "record_followup", F.coalesce("exact_note", F.lit("Call back on Monday"))
    answer = final(F.when(k % 13 == 0, "I am done.").otherwise(F.concat_ws(" ", "target", "expected_email", note)))
    steps = [
        (c("route") == "recovery", call("lookup_contact", name=cases.stale(c("target")))), (far & (k % 9 != 0), call("list_contacts")), (k % 11 != 0, call("lookup_contact", name=c("target"))),
        (writes, call("record_followup", name=c("target"), note=note)), (c("route") == "verify", call("get_followup", name=c("target"))), (k % 17 != 0, answer),
    ]
    asked = table(responded(made, "contacts", ["sequence"], *steps), folder, "responses")
    state = rollout.looped(c("responses"), cases.contact_tools(), F.lit(None).cast("map<string,string>"), rollout.contact_step(F.create_map("target", "expected_email")))
    traced = table(rollout.assessable(rollout.ended(asked, state).drop("responses")), folder, "traces")
    judged = assessment.or_incomplete(assessment.assess_contacts(traced))
    a = F.col("assessment")
    ready = judged.select(
        "sequence", F.lit("contacts").alias("domain_id"), "terminal_reason", "mutation_authorization", a["passed"].alias("passed"), a["reason_codes"].alias("reason_codes"), a["coverage_tags"].alias("coverage_tags"), a["structural_key"].alias("structural_key"),
        F.exists(a["checks"], lambda x: (x["name"] == "final_response_grounded") & x["passed"]).alias("grounded"), "unsafe", cases.contact_key().alias("semantic_key"),
    )
    return table(admission.semantic_dedup(admission.gate_admission(table(ready, folder, "assessments"))), folder, "outcomes")


def run(spark: SparkSession, folder: str, n: int = 10_000) -> DataFrame:
    """The quality report's counts of a run of ``n`` attempts, whose tables go to ``folder``."""
    judgments = spark.createDataFrame([], "availability string, verdict string")
    return reports.quality_counts(attempts(spark, folder, n), judgments, allocated=n, capacity=n)
