"""Event-time operators on a stream of events; the registered queries run the same plans on the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATE = "1 hour"


def watermarked(events: DataFrame, late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late)


def tumbling(events: DataFrame, size: str = "1 hour") -> DataFrame:
    w = F.window("ts", size)
    return watermarked(events).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "2 hours", slide: str = "1 hour") -> DataFrame:
    return watermarked(events).groupBy(F.window("ts", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    return watermarked(events).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def deduplicated(events: DataFrame) -> DataFrame:
    return watermarked(events).dropDuplicates(["event_id", "ts"])


def by_user(events: DataFrame) -> DataFrame:
    """Running totals of a user (update mode keeps one row of state a user)."""
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))


def _on_table(operator):
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    return deduplicated(e.unionAll(e)).select("event_id", "user_id")


def queries() -> dict:
    return {"stream_tumbling": _on_table(tumbling), "stream_sliding": _on_table(sliding), "stream_sessions": _on_table(sessions), "stream_dedup": _dedup, "stream_keyed_state": _on_table(by_user)}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_tumbling": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
        "stream_sliding": "SELECT start, count(*) AS n FROM (SELECT date_trunc('hour', ts) - to_hours(k) AS start FROM events, (VALUES (0), (1)) AS t(k)) GROUP BY 1",
        "stream_sessions": "SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)) GROUP BY user_id, s",
        "stream_dedup": "SELECT event_id, user_id FROM events",
        "stream_keyed_state": "SELECT user_id, count(*) AS n, max(ts) AS last FROM events GROUP BY 1",
    }
