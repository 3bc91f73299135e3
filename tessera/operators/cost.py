"""Spend analytics over a metering table and budget monitors
(CST-1..8): daily rollup and upsert, burn rate, month-end projection,
status tiers, running totals and the brief."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import days_left_in_month
from tessera.operators.aggregates import daily_rollup, running_sum
from tessera.operators.dedup import latest_per_key
from tessera.operators.joins import attach_scalars
from tessera.operators.merge import merge_upsert
from tessera.sources.tables import literal_rows

DAILY_SUMS = [
    ("credits_used_compute", "credits_used_compute"),
    ("credits_used_cloud_services", "credits_used_cloud_services"),
    ("credits_used", "credits_used_total"),
]


def budget_snapshot(monitors: DataFrame, snapshot_ts) -> DataFrame:
    """Monitor rows with level and percent used (zero quota -> 0) (CST-1).
    ``monitors``: monitor_name, credit_quota, used_credits,
    remaining_credits, notify_percent, suspend_percent,
    suspend_immediate_percent, owner, warehouses."""
    return monitors.select(
        F.lit(snapshot_ts).cast("timestamp_ntz").alias("snapshot_ts"),
        "monitor_name",
        F.when(F.col("warehouses").isNull(), F.lit("ACCOUNT")).otherwise(F.lit("WAREHOUSE")).alias("monitor_level"),
        "credit_quota", "used_credits", "remaining_credits",
        F.when(F.col("credit_quota") == 0, F.lit(0.0)).otherwise(F.col("used_credits") / F.col("credit_quota") * 100).alias("pct_used"),
        "notify_percent", "suspend_percent", "suspend_immediate_percent", "owner", "warehouses",
    )


def metering_daily(history: DataFrame, target: DataFrame | None, lookback_days: int, as_of) -> DataFrame:
    """Daily rollup of the last ``lookback_days`` upserted into the daily
    table on (usage_date, warehouse_name) (CST-2)."""
    src = recent_daily(history, lookback_days, as_of)
    return src if target is None else merge_upsert(target, src, DAILY_KEY)


DAILY_KEY = ["usage_date", "warehouse_name"]


def recent_daily(history: DataFrame, lookback_days: int, as_of) -> DataFrame:
    """Daily rollup of the last ``lookback_days``."""
    now = F.lit(as_of).cast("timestamp_ntz")
    recent = history.where(
        (F.col("start_time") >= now - F.expr(f"INTERVAL {int(lookback_days)} DAYS")) & F.col("warehouse_name").isNotNull()
    )
    return daily_rollup(recent, "start_time", ["warehouse_name"], DAILY_SUMS).withColumn("last_updated_ts", now)


def burn_rate(daily: DataFrame, as_of, warehouse: str, days: int = 7) -> DataFrame:
    """Mean daily total of one warehouse over the last ``days`` days, one
    row (CST-3)."""
    today = F.to_date(F.lit(as_of).cast("timestamp_ntz"))
    return daily.where((F.col("usage_date") >= F.date_sub(today, days)) & (F.col("warehouse_name") == warehouse)).agg(
        F.avg("credits_used_total").alias("avg_daily_credits_7d")
    )


def _status(pct, s_imm, s, n):
    return (
        F.when(pct >= s_imm, F.lit("CRITICAL"))
        .when(pct >= s, F.lit("HIGH"))
        .when(pct >= n, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


# Narrative hint per monitor name.
NARRATIVE_HINTS = {
    "EV_PIPELINE_MONITOR": "Pipeline warehouse budget posture",
    "EV_ACCOUNT_MONITOR": "Account-wide budget posture",
}
DEFAULT_HINT = "General monitor posture"


def cost_situation(snapshot: DataFrame, daily: DataFrame, as_of, warehouse: str) -> DataFrame:
    """Projected month-end spend and current / projected status (CST-4)."""
    br = burn_rate(daily, as_of, warehouse)
    today = F.to_date(F.lit(as_of).cast("timestamp_ntz"))
    horizon = snapshot.sparkSession.range(1).select(days_left_in_month(today).alias("days_left_in_cycle"))
    j = attach_scalars(snapshot, br, horizon)
    avg7 = F.coalesce(F.col("avg_daily_credits_7d"), F.lit(0.0))
    projected = F.col("used_credits") + avg7 * F.col("days_left_in_cycle")
    ppct = projected / F.col("credit_quota") * 100
    hint = F.lit(DEFAULT_HINT)
    for name, text in reversed(list(NARRATIVE_HINTS.items())):
        hint = F.when(F.col("monitor_name") == name, F.lit(text)).otherwise(hint)
    return j.select(
        "snapshot_ts", "monitor_name", "monitor_level", "credit_quota", "used_credits", "remaining_credits", "pct_used",
        "days_left_in_cycle",
        avg7.alias("avg_daily_credits_7d"),
        projected.alias("projected_month_end_credits"),
        _status(F.col("pct_used"), F.col("suspend_immediate_percent"), F.col("suspend_percent"), F.col("notify_percent")).alias("current_status"),
        F.when(F.col("credit_quota") == 0, F.lit("UNKNOWN"))
        .otherwise(_status(ppct, F.col("suspend_immediate_percent"), F.col("suspend_percent"), F.col("notify_percent")))
        .alias("projected_status"),
        hint.alias("narrative_hint"),
    )


def latest_situation(situations: DataFrame) -> DataFrame:
    """Latest snapshot per monitor (CST-5)."""
    return latest_per_key(situations, ["monitor_name"], [F.col("snapshot_ts").desc_nulls_last()])


def cost_trend(daily: DataFrame) -> DataFrame:
    """Daily totals with the running total per warehouse (CST-6)."""
    return running_sum(daily, ["warehouse_name"], "usage_date", "credits_used_total", "cumulative_credits")


def cost_brief(latest: DataFrame) -> DataFrame:
    """Rounded brief with a recommended action (CST-7)."""
    return latest.select(
        "snapshot_ts", "monitor_name", "monitor_level", "current_status", "projected_status",
        F.round("pct_used", 2).alias("pct_used"),
        F.round("projected_month_end_credits", 4).alias("projected_month_end_credits"),
        F.round("credit_quota", 4).alias("credit_quota"),
        F.round("avg_daily_credits_7d", 4).alias("avg_daily_credits_7d"),
        "days_left_in_cycle", "narrative_hint",
        F.when(F.col("projected_status").isin("HIGH", "CRITICAL"), F.lit(ACTION_TEXT["act"]))
        .otherwise(F.lit(ACTION_TEXT["none"])).alias("recommended_action"),
    )


# The recommended actions of the brief, as the source writes
# them.
ACTION_TEXT = {
    "act": "Recommended action: reduce warehouse runtime or scale down compute usage.",
    "none": "Recommended action: current spend trajectory is within configured thresholds.",
}


# Monitor thresholds in percent (notify, suspend, suspend
# immediately) and monthly credit quotas, as the source's budget setup
# defines them.
MONITOR_THRESHOLDS = {
    "EV_PIPELINE_MONITOR": (75.0, 95.0, 100.0, 20.0),
    "EV_ACCOUNT_MONITOR": (75.0, 90.0, 100.0, 50.0),
}


def monitor_config(spark, names: Sequence[str] | None = None) -> DataFrame:
    """Thresholds as data (CST-8): monitor_name, notify_percent,
    suspend_percent, suspend_immediate_percent, credit_quota."""
    rows = [(k, *v) for k, v in MONITOR_THRESHOLDS.items() if names is None or k in names]
    return literal_rows(
        spark, rows, "monitor_name string, notify_percent double, suspend_percent double, suspend_immediate_percent double, credit_quota double"
    )
