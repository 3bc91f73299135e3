"""Change feeds, facts, metering and run logs derived from ``events``.

    catalog change feed   signup events (upsert) and error events (delete)
                          key = user_id, change time = ts, lsn = event_id,
                          tracked = value and the ``k`` of ``props``
    facts by date         purchase events
    sync runs             view events (a run fails when value < 1)
    metering history      every event: start_time = ts, warehouse =
                          upper(event_type) + '_WH', compute credits =
                          value, cloud-services credits = value / 10
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

AS_OF = "2024-01-31 00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def props_k(col: str = "props"):
    return F.try_variant_get(F.parse_json(F.col(col)), "$.k", "bigint")


def catalog_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).where(F.col("event_type").isin("signup", "error"))
    up = F.col("event_type") == "signup"
    return ev.select(
        F.col("user_id").alias("catalog_id"),
        "ts",
        F.col("event_id").alias("lsn"),
        F.when(up, F.lit("UPSERT")).otherwise(F.lit("DELETE")).alias("op"),
        F.when(up, F.col("value")).alias("tracked_value"),
        F.when(up, props_k()).alias("k"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")


def sync_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("run_ts"), (F.col("value") >= 1.0).alias("succeeded")
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("ts").alias("start_time"),
        F.concat(F.upper("event_type"), F.lit("_WH")).alias("warehouse_name"),
        F.col("value").alias("credits_used_compute"),
        (F.col("value") / 10).alias("credits_used_cloud_services"),
        (F.col("value") + F.col("value") / 10).alias("credits_used"),
    )
