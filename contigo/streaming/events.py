"""Structured Streaming versions of windows, pairing and deduplication: extensions, as the batch operators' model has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """event_type, start, n, total of tumbling windows; events later than the watermark are dropped by Spark."""
    w = F.window("ts", width)
    rows = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rows.select("event_type", F.col("w.start").alias("start"), "n", "total")


def deduplicated(events: DataFrame, key: list[str], late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def paired(left: DataFrame, right: DataFrame, key: str, within: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events of two streams with one key, the right one at most so long after the left: a stream-stream join with bounded state."""
    a = left.withWatermark("ts", late).select(F.col(key).alias("key"), F.col("ts").alias("ts1"), F.col("event_id").alias("id1"))
    b = right.withWatermark("ts", late).select(F.col(key).alias("key2"), F.col("ts").alias("ts2"), F.col("event_id").alias("id2"))
    return a.join(b, F.expr(f"key = key2 AND ts2 >= ts1 AND ts2 <= ts1 + INTERVAL {within} AND id1 != id2")).drop("key2")


def sessions(events: DataFrame, key: str = "user_id", gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    s = F.session_window("ts", gap)
    rows = events.withWatermark("ts", late).groupBy(s.alias("s"), key).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")
