"""Change-data-capture monitoring: sync monitor, stage reconciliation,
run cadence, lineage, ingestion lag, evidence rollup and schema drift
(CDC-7, CDC-10..12, CDC-14..16)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import boundaries_between, minutes_between
from tessera.operators.aggregates import count_if
from tessera.operators.joins import attach_scalars


def cdc_monitor(dim: DataFrame, as_of, synced_col: str = "cdc_synced_at", current_col: str = "is_current",
                source: str = "catalog", stale_hours: int = 13) -> DataFrame:
    """Totals, last sync, hours since (boundaries crossed), current rows
    and the two alert rules (stale sync, no current rows) (CDC-7)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    agg = dim.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.max(synced_col).alias("last_sync_time"),
        F.sum(F.when(F.col(current_col), 1).otherwise(0)).cast("long").alias("current_records"),
    )
    hours = boundaries_between("hour", F.col("last_sync_time"), now)
    return agg.select(
        F.lit(source).alias("source"), "total_records", "last_sync_time",
        hours.alias("hours_since_sync"), "current_records",
        (hours > stale_hours).alias("alert_stale_sync"),
        (F.col("current_records") == 0).alias("alert_no_current"),
    )


def cdc_reconcile(extracted: DataFrame, landed: DataFrame, merged: DataFrame, rejected: DataFrame) -> DataFrame:
    """Stage counts side by side with the unexplained difference (CDC-10)."""
    parts = [
        extracted.agg(F.count(F.lit(1)).alias("extracted")),
        landed.agg(F.count(F.lit(1)).alias("landed")),
        merged.agg(F.count(F.lit(1)).alias("merged")),
        rejected.agg(F.count(F.lit(1)).alias("rejected")),
    ]
    out = attach_scalars(parts[0], *parts[1:])
    diff = F.col("extracted") - F.col("landed")
    unexplained = F.col("landed") - F.col("merged") - F.col("rejected")
    return out.select(
        "*", diff.alias("lost_in_transport"), unexplained.alias("unexplained"),
        F.when((diff == 0) & (unexplained == 0), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


def cadence_report(runs: DataFrame, as_of, key: Sequence[str] = (), ts: str = "run_ts", ok: str = "succeeded",
                   window_hours: int = 72, target_min: float = 15.0, tolerance_min: float = 3.0,
                   gap_min: float = 30.0) -> DataFrame:
    """Per key over the last ``window_hours``: runs, success %, mean
    interval in minutes, whether it is within target +- tolerance, and
    gaps longer than ``gap_min`` (CDC-11). The interval uses ``lag`` per
    key; run logs hold one row per run, so a key's sequence is bounded by
    the run cadence over the window."""
    now = F.lit(as_of).cast("timestamp_ntz")
    recent = runs.where((F.col(ts) >= now - F.expr(f"INTERVAL {int(window_hours)} HOURS")) & (F.col(ts) <= now))
    w = Window.partitionBy(*key).orderBy(F.col(ts).asc())
    gaps = recent.withColumn(
        "_gap_min", minutes_between(F.lag(ts).over(w), F.col(ts))
    )
    agg = gaps.groupBy(*key).agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(count_if(F.col(ok)) * 100.0 / F.count(F.lit(1)), 2).alias("success_pct"),
        F.round(F.avg("_gap_min"), 4).alias("mean_interval_min"),
        count_if(F.col("_gap_min") > gap_min).alias("gaps_over_limit"),
        F.round(F.max("_gap_min"), 4).alias("max_gap_min"),
    )
    return agg.withColumn(
        "cadence_ok",
        F.abs(F.col("mean_interval_min") - F.lit(target_min)) <= F.lit(tolerance_min),
    )


def lineage_violations(consumption: DataFrame, landing: DataFrame, batch: str, sync: str, key: Sequence[str]) -> DataFrame:
    """Consumption batches mapped to more than one sync, and consumption
    keys with no landing row (CDC-12)."""
    multi = (
        consumption.groupBy(batch)
        .agg(F.countDistinct(sync).alias("syncs"))
        .where(F.col("syncs") != 1)
        .select(F.lit("BATCH_NOT_ONE_SYNC").alias("violation"), F.col(batch).cast("string").alias("ref"))
    )
    missing = (
        consumption.select(*key).distinct()
        .join(landing.select(*key).distinct(), list(key), "left_anti")
        .select(F.lit("NO_LANDING_ROW").alias("violation"), F.concat_ws("|", *[F.col(k).cast("string") for k in key]).alias("ref"))
    )
    return multi.unionByName(missing)


def lag_report(df: DataFrame, source_ts: str, landed_ts: str, threshold_min: float = 30.0) -> DataFrame:
    """Ingestion lag in minutes per row and its status (CDC-14)."""
    lag = minutes_between(F.col(source_ts), F.col(landed_ts))
    return df.withColumn("lag_min", F.round(lag, 4)).withColumn(
        "lag_status", F.when(F.col("lag_min") <= threshold_min, F.lit("OK")).otherwise(F.lit("BREACH"))
    )


def evidence_summary(evidence: DataFrame, ts: str = "timestamp_utc", result: str = "result") -> DataFrame:
    """Evidence items per day: total and PASS / WARNING / FAIL / BLOCKED
    counts (CDC-15)."""
    r = F.upper(F.col(result))
    return evidence.groupBy(F.to_date(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("total"),
        count_if(r == "PASS").alias("pass"),
        count_if(r == "WARNING").alias("warning"),
        count_if(r == "FAIL").alias("fail"),
        count_if(r == "BLOCKED").alias("blocked"),
    )


def schema_drift(flat: DataFrame, expected: Mapping[int, str], value_col: str = "value") -> DataFrame:
    """Per array position, the variant types seen that differ from the
    contract (CDC-16). ``expected`` maps a position to the allowed
    ``schema_of_variant`` type (e.g. 'STRING'); JSON null is always
    allowed. Output: position, observed type, rows."""
    rows = []
    for pos in sorted(expected):
        v = F.try_variant_get(F.col(value_col), f"$[{pos}]", "variant")
        rows.append(F.struct(F.lit(pos).alias("position"), F.schema_of_variant(v).alias("observed_type")))
    exploded = flat.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
    exp = flat.sparkSession.createDataFrame(list(expected.items()), "position int, expected_type string")
    counts = exploded.groupBy("position", "observed_type").agg(F.count(F.lit(1)).alias("rows"))
    return (
        counts.join(F.broadcast(exp), "position")  # the contract: one row per position
        .where((F.col("observed_type") != F.col("expected_type")) & (F.col("observed_type") != F.lit("VOID")))
        .select("position", "expected_type", "observed_type", "rows")
    )
