"""Judge against human: confusion, rates and eligibility by exact thresholds (AG-15, AG-16, JN-2, JN-10, ST-2, ST-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds in ten-thousandths.
AGREEMENT, FALSE_PASS, FALSE_FAIL, DOMAIN_FALSE_PASS, DOMAIN_QUOTA = 8500, 500, 1000, 1000, 30


def effective(judge: Column) -> Column:
    """An unavailable judgment counts as uncertain."""
    return F.when(judge == "unavailable", "uncertain").otherwise(judge)


def confusion(evidence: DataFrame) -> DataFrame:
    """AG-15: counts by judge and human verdict of what humans reviewed."""
    return evidence.where(F.col("human_verdict").isNotNull()).groupBy(effective(F.col("judge_verdict")).alias("judge_verdict"), "human_verdict").agg(F.count(F.lit(1)).alias("n"))


def rates(evidence: DataFrame, *by: str) -> DataFrame:
    """AG-15, AG-16: numerators and denominators overall (domain null) and by domain, or by the columns ``by`` (domain_id and domain_version), in one pass of grouping sets."""
    by = by or ("domain_id",)
    judge, human = effective(F.col("judge_verdict")), F.col("human_verdict")
    seen = human.isNotNull()
    at = evidence.select(*by, seen.alias("seen"), (judge == human).alias("agree"), (judge == "pass").alias("j"), (human == "pass").alias("h"), "critical", (F.col("judge_verdict") == "unavailable").alias("gone"))
    return at.groupingSets([[], list(by)], *by).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(~F.col("seen")).alias("missing_labels"), F.count_if("gone").alias("unavailable"), F.count_if("seen").alias("reviewed"),
        F.count_if(F.col("seen") & F.col("agree")).alias("agree"), F.count_if(F.col("seen") & F.col("j")).alias("judge_pass"), F.count_if(F.col("seen") & F.col("j") & ~F.col("h")).alias("false_pass"),
        F.count_if(F.col("seen") & F.col("h")).alias("human_pass"), F.count_if(F.col("seen") & F.col("h") & ~F.col("j")).alias("false_fail"), F.count_if(F.col("seen") & F.col("j") & F.col("critical")).alias("critical_false_pass"),
    )


def threshold_reasons(measured: DataFrame) -> DataFrame:
    """The reasons against eligibility, by whole-number comparison, of the overall row and of each domain; joined by ``,`` in their order, empty if none."""
    overall = F.col("domain_id").isNull()

    def limit(kind: Column, numerator: str, denominator: str, most: int, name: str) -> Column:
        return F.when(kind & (F.col(denominator) == 0), f"{name}_denominator_zero").when(kind & (F.col(numerator) * 10000 > F.col(denominator) * most), f"{name}_above_threshold")

    checks = [
        F.when(overall & (F.col("reviewed") == 0), "agreement_denominator_zero").when(overall & (F.col("agree") * 10000 < F.col("reviewed") * AGREEMENT), "overall_agreement_below_threshold"),
        limit(overall, "false_pass", "judge_pass", FALSE_PASS, "overall_false_pass"),
        limit(overall, "false_fail", "human_pass", FALSE_FAIL, "overall_false_fail"),
        F.when(overall & (F.col("critical_false_pass") > 0), "critical_safety_false_pass_detected"),
        limit(~overall, "false_pass", "judge_pass", DOMAIN_FALSE_PASS, "per_domain_false_pass"),
    ]
    return measured.select("domain_id", F.array_join(F.array_distinct(F.array_compact(F.array(*checks))), ",").alias("reasons"))


def domain_quota(scopes: DataFrame, measured: DataFrame) -> DataFrame:
    """JN-10: whether each scope has enough reviews; a scope without evidence has none."""
    at = scopes.join(measured.where(F.col("domain_id").isNotNull()).select("domain_id", "reviewed"), "domain_id", "left")
    reviewed = F.coalesce("reviewed", F.lit(0).cast("long"))
    return at.select("domain_id", reviewed.alias("reviewed"), (reviewed >= DOMAIN_QUOTA).alias("met"))


def disjoint(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """ST-2: by key, shared values and nulls; campaigns are disjoint if all are 0."""
    out = None
    for key in keys:
        shared = left.select(key).where(F.col(key).isNotNull()).distinct().join(right.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("shared"))
        nulls = left.select(key).unionAll(right.select(key)).agg(F.count_if(F.col(key).isNull()).alias("nulls"))
        row = shared.crossJoin(nulls).select(F.lit(key).alias("key"), "shared", "nulls")
        out = row if out is None else out.unionByName(row)
    return out


def selection_gaps(eligible: DataFrame, reviewed: DataFrame, key: str) -> DataFrame:
    """ST-4: keys on one side alone; the selection is complete if there are none."""
    both = eligible.select(key).distinct().withColumn("a", F.lit(1)).join(reviewed.select(key).distinct().withColumn("b", F.lit(1)), key, "full")
    side = F.when(F.col("b").isNull(), "not_reviewed").when(F.col("a").isNull(), "not_eligible")
    return both.select(key, side.alias("side")).where(F.col("side").isNotNull())
