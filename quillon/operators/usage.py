"""Provider usage: totals, roles, lineage, attempts and budgets (AG-1 to AG-4, AG-8, WN-4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _measures() -> list[Column]:
    """Counts as in AG-1; sums of unknown tokens stay null, never 0."""
    return [
        F.count(F.lit(1)).alias("request_count"),
        (F.count(F.lit(1)) - F.count_distinct("logical_request_id")).alias("retry_count"),
        F.count_if(F.col("request_kind") == "repair").alias("repair_count"),
        F.sum("total_tokens").alias("known_total_tokens"),
        F.count_if(F.col("total_tokens").isNull()).alias("unknown_usage_count"),
        F.count_if(F.col("status") == "reserved").alias("reserved_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.count_if(F.col("status") == "completed").alias("completed_count"),
    ]


def usage_summary(requests: DataFrame, *by: str) -> DataFrame:
    """AG-1, AG-2, AG-4: usage of all requests, or by columns."""
    return requests.groupBy(*by).agg(*_measures())


def usage_rollup(requests: DataFrame) -> DataFrame:
    """AG-2: usage by role and, with role null, in total."""
    # Retries subtract distinct ids; Spark expands a rollup with a distinct count, so both levels are one pass.
    return requests.rollup("role").agg(*_measures())


def with_sequences(requests: DataFrame) -> DataFrame:
    """JN-12, JN-13: a row for each episode that a request counts for: its own and all related ones, each once."""
    own = F.when(F.col("sequence").isNotNull(), F.array(F.col("sequence"))).otherwise(F.array())
    related = F.coalesce(F.col("related_sequences").cast("array<bigint>"), F.array().cast("array<bigint>"))
    return requests.withColumn("sequence", F.explode(F.array_union(own.cast("array<bigint>"), related)))


def episode_lineage(requests: DataFrame) -> DataFrame:
    """AG-3: usage by episode and role with the hashes of the responses, in the order of requests; a request counts for every related episode.

    ``requests`` have related_sequences and response_hash.
    """
    counted = with_sequences(requests.where(F.col("role").isin("task_generation", "agent")))
    hashes = F.transform(F.array_sort(F.collect_list(F.when(F.col("response_hash").isNotNull(), F.struct("request_id", "response_hash")))), lambda r: r["response_hash"])
    return counted.groupBy("sequence", "role").agg(*_measures(), hashes.alias("response_hashes"))


def attempt_ordinals(requests: DataFrame) -> DataFrame:
    """AG-8, WN-5: the number of each physical request within its logical one."""
    by = Window.partitionBy("logical_request_id").orderBy("request_id")
    return requests.withColumn("attempt", F.row_number().over(by))


def budget_admitted(requests: DataFrame, total_limit: int, role_limits: dict[str, int]) -> DataFrame:
    """WN-4: the requests that a sequential budget lets pass, in two stages.

    First each role's own limit, then the total over what is left.  Each is the
    first rows by id, which Spark takes from every partition before it merges
    them, so no task sorts a role's requests.  Roles without a limit of their
    own have the total.
    """
    parts = [requests.where(F.col("role") == role).orderBy("request_id").limit(limit) for role, limit in role_limits.items()]
    parts.append(requests.where(~F.coalesce(F.col("role").isin(*role_limits), F.lit(False))).orderBy("request_id").limit(total_limit))
    return reduce(DataFrame.unionByName, parts).orderBy("request_id").limit(total_limit)
