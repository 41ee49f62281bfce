"""Usage of provider requests as they arrive, late ones included up to the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage_windows(requests: DataFrame, time: str = "ts", late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Requests and failures by window and role; a request that was delivered twice counts once."""
    once = requests.withWatermark(time, late).dropDuplicatesWithinWatermark(["request_id"])
    return once.groupBy(F.window(time, window), "role").agg(F.count(F.lit(1)).alias("request_count"), F.count_if(F.col("status") == "failed").alias("failed_count"))


def ingest(requests: DataFrame, path: str, checkpoint: str):
    """Append requests to a table, each once, and survive restarts: the file sink's log and the checkpoint agree."""
    once = requests.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["request_id"])
    return once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
