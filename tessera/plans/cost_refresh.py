"""The cost-observability refresh run: a monitor snapshot, the daily metering
rollup merged over the lookback window, and the cost situation of the
snapshot; readers use the latest-per-monitor view and the brief.

A run is numbered by its time ``as_of``: its snapshot and situation are its own
batches, and of the daily table only the days of the lookback are read and
replaced (``merge.merge_partitions``). A repeated run changes nothing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import cost as C
from tessera.operators.merge import merge_partitions
from tessera.tables import BatchTable


def run_number(as_of: str | datetime) -> int:
    """The run's time in seconds."""
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return int(moment.replace(tzinfo=timezone.utc).timestamp())


def refresh_cost(spark: SparkSession, monitors: DataFrame, metering: DataFrame, root: str, as_of: str,
                 warehouse: str, lookback_days: int = 30) -> dict[str, DataFrame]:
    root, run_no = root.rstrip("/"), run_number(as_of)
    snapshots, situations = BatchTable(f"{root}/monitor_snapshots"), BatchTable(f"{root}/cost_situation")
    snapshots.write(C.budget_snapshot(monitors, as_of), run_no)
    snapshot = spark.read.parquet(snapshots.path(run_no))
    recent = C.recent_daily(metering, lookback_days, as_of)
    daily = merge_partitions(recent, f"{root}/warehouse_cost_daily", C.DAILY_KEY, "usage_date", run_no)
    situations.write(C.cost_situation(snapshot, daily, as_of, warehouse), run_no)
    latest = C.latest_situation(situations.read(spark))
    return {"daily": daily, "trend": C.cost_trend(daily), "latest": latest, "brief": C.cost_brief(latest)}
