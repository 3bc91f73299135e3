"""Data-quality checks, quarantine rows, reconciliation, freshness and
the dashboard (DQ-1..18).

Checks return the offending rows in the quarantine schema, so they union
into one append; summaries are aggregates over those rows. Time-relative
rules take an explicit ``as_of``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.scalar import boundaries_between
from tessera.operators.aggregates import count_if
from tessera.operators.filters import tagged_rows
from tessera.operators.joins import attach_scalars, orphans

# quarantine table layout (name, type)
ERROR_SCHEMA = [
    ("source_layer", "string"),
    ("source_table", "string"),
    ("error_type", "string"),
    ("error_description", "string"),
    ("vin", "string"),
    ("make", "string"),
    ("model", "string"),
    ("model_year", "bigint"),
    ("ev_type", "string"),
    ("electric_range", "bigint"),
    ("base_msrp", "double"),
    ("dol_vehicle_id", "string"),
    ("source_file", "string"),
]


# The layer / table tags and error descriptions written into
# quarantine rows, as the source's checks write them.
RAW_TAG = ("BRONZE", "RAW_EV_DATA")
CLEAN_TAG = ("SILVER", "CLEAN_EV_DATA_DT")
ERROR_TEXT = {
    "NULL_VIN": "VIN is null",
    "INVALID_RANGE": "Electric range out of valid bounds (0-500)",
    "ORPHAN_MAKE": "Make not in DIM_MANUFACTURERS_GOLD",
    "NULL_CRITICAL_FIELD": "Critical field is null",
}


def error_rows(
    df: DataFrame,
    layer: str,
    table: str,
    etype: str,
    description: str,
    mapping: Mapping[str, Column | str | None] | None = None,
    raw_record: Column | None = None,
) -> DataFrame:
    """Offending rows in the quarantine layout (PRJ-9)."""
    tags = {"source_layer": layer, "source_table": table, "error_type": etype, "error_description": description}
    m = {"dol_vehicle_id": None}
    m.update(mapping or {})
    if raw_record is None:
        return tagged_rows(df, tags, m, ERROR_SCHEMA)
    return tagged_rows(df, tags, m | {"raw_record": raw_record}, [*ERROR_SCHEMA, ("raw_record", "string")])


def dq_null_key(flat: DataFrame, key: str = "vin", raw_col: str = "value") -> DataFrame:
    """Raw rows without a key; the raw element, as a variant or its JSON
    text, is kept if the input has it (DQ-1)."""
    bad = flat.where(F.col(key).isNull())
    raw = None
    if raw_col in flat.columns:
        text = flat.schema[raw_col].dataType.typeName() == "string"
        raw = F.col(raw_col) if text else F.to_json(F.col(raw_col))
    return error_rows(bad, *RAW_TAG, "NULL_VIN", ERROR_TEXT["NULL_VIN"], {"vin": F.lit(None)}, raw)


def dq_out_of_range(df: DataFrame, col: str = "electric_range", lo: float = 0, hi: float = 500) -> DataFrame:
    """Values outside [lo, hi]; NULL is not out of range (DQ-2)."""
    bad = df.where((F.col(col) < lo) | (F.col(col) > hi))
    text = ERROR_TEXT["INVALID_RANGE"] if (lo, hi) == (0, 500) else f"Electric range out of valid bounds ({lo:g}-{hi:g})"
    return error_rows(bad, *CLEAN_TAG, "INVALID_RANGE", text)


def dq_orphan(df: DataFrame, ref: DataFrame, col: str = "make", ref_col: str = "manufacturer_name") -> DataFrame:
    """Values missing from the reference set; NULL counts as orphan (DQ-3)."""
    return error_rows(orphans(df, ref, col, ref_col), *CLEAN_TAG, "ORPHAN_MAKE", ERROR_TEXT["ORPHAN_MAKE"])


def dq_null_any(df: DataFrame, cols: Sequence[str] = ("make", "model", "model_year")) -> DataFrame:
    """Any critical field NULL (DQ-4)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return error_rows(df.where(cond), *CLEAN_TAG, "NULL_CRITICAL_FIELD", ERROR_TEXT["NULL_CRITICAL_FIELD"])


@dataclass(frozen=True)
class RowRule:
    """A check of single rows: those where ``broken`` is true are errors."""

    error_type: str
    broken: Column
    layer: tuple[str, str] = CLEAN_TAG
    text: str | None = None


def with_known(df: DataFrame, ref: DataFrame, col: str = "make", ref_col: str = "manufacturer_name", flag: str = "_known") -> DataFrame:
    """``df`` with a flag: whether the reference has the row's value."""
    names = ref.select(F.col(ref_col).alias("_ref")).where("_ref IS NOT NULL").distinct()
    return df.join(names, F.col(col) == F.col("_ref"), "left").withColumn(flag, F.col("_ref").isNotNull()).drop("_ref")


def clean_rules(known: str | None = None, lo: float = 0, hi: float = 500,
                critical: Sequence[str] = ("make", "model", "model_year")) -> list[RowRule]:
    """The checks of the cleansed layer (DQ-2..4) as row rules; the orphan
    check needs the flag of ``with_known``."""
    rng = F.col("electric_range")
    missing = F.lit(False)
    for c in critical:
        missing = missing | F.col(c).isNull()
    rules = [RowRule("INVALID_RANGE", (rng < lo) | (rng > hi)), RowRule("NULL_CRITICAL_FIELD", missing)]
    return rules + ([RowRule("ORPHAN_MAKE", ~F.col(known))] if known else [])


def broken_rules(df: DataFrame, rules: Sequence[RowRule], observed: Observation | None = None) -> DataFrame:
    """The rows that break rules in the quarantine layout, one row per rule
    that a row breaks, from one scan of ``df`` (DQ-6): the violations of a row
    are an array that is exploded once. ``observed`` gets the number of rows
    (``rows``) and of broken rules by error type, once the result is used."""
    if observed is not None:
        counts = [F.count_if(F.coalesce(r.broken, F.lit(False))).alias(r.error_type) for r in rules]
        df = df.observe(observed, F.count(F.lit(1)).alias("rows"), *counts)
    found = [
        F.when(r.broken, F.struct(*[F.lit(v).alias(n) for n, v in zip(
            ("source_layer", "source_table", "error_type", "error_description"), (*r.layer, r.error_type, r.text or ERROR_TEXT[r.error_type]))]))
        for r in rules
    ]
    values = [
        (F.lit(None) if n == "dol_vehicle_id" or n not in df.columns else F.col(n)).cast(t).alias(n)
        for n, t in ERROR_SCHEMA[4:]
    ]
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("_v"), *values).select("_v.*", *[n for n, _ in ERROR_SCHEMA[4:]])


def dq_duplicates(flat: DataFrame, key: str = "vin", existing: DataFrame | None = None) -> DataFrame:
    """Keys seen more than once: occurrence count, a sample make/model
    (MAX) and the sorted set of files; keys already stored are skipped
    (DQ-5). ``collect_set`` is partial-aggregated, and its size is bounded
    by the number of distinct files holding the key."""
    dupes = (
        flat.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("occurrence_count"),
            F.max("make").alias("make"),
            F.max("model").alias("model"),
            F.sort_array(F.collect_set("source_file")).alias("source_files"),
        )
        .where(F.col("occurrence_count") > 1)
    )
    if existing is not None:
        dupes = dupes.join(existing.select(key), key, "left_anti")
    return dupes


def quarantine(checks: Sequence[DataFrame], run_id: str | None = None, detected_at=None) -> DataFrame:
    """Union of all checks, tagged with run and detection time (DQ-6)."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    if detected_at is not None:
        out = out.withColumn("detected_at", F.lit(detected_at).cast("timestamp_ntz"))
    return out


def new_errors_only(errors: DataFrame, stored: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Default quarantine mode: append only rows whose content is not
    stored yet (compares on ``cols``, all error columns by default)."""
    cols = list(cols or [n for n, _ in ERROR_SCHEMA])
    h = F.xxhash64(*[F.col(c) for c in cols])
    # the hash is the equi-join key (partitioning); the null-safe equality
    # of every column makes the comparison exact despite hash collisions
    seen = stored.select(h.alias("_h2"), *[F.col(c).alias("_s_" + c) for c in cols]).distinct()
    cond = F.col("_h") == F.col("_h2")
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col("_s_" + c))
    return errors.withColumn("_h", h).join(seen, cond, "left_anti").drop("_h")


def error_summary(errors: DataFrame) -> DataFrame:
    """Count and first / last detection per type, layer, table (DQ-10)."""
    return errors.groupBy("error_type", "source_layer", "source_table").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.min("detected_at").alias("first_seen"),
        F.max("detected_at").alias("last_seen"),
    )


def error_trend(errors: DataFrame, ts: str = "detected_at") -> DataFrame:
    """Hourly error counts per type and layer (DQ-11)."""
    return errors.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"), "error_type", "source_layer").agg(
        F.count(F.lit(1)).alias("error_count")
    )


def top_offenders(errors: DataFrame, group: str = "make") -> DataFrame:
    """Per make: errors, distinct types, the type set and per-type counts
    (DQ-12)."""
    return (
        errors.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("total_errors"),
            F.countDistinct("error_type").alias("distinct_error_types"),
            F.sort_array(F.collect_set("error_type")).alias("error_types"),
            count_if(F.col("error_type") == "INVALID_RANGE").alias("invalid_range_count"),
            count_if(F.col("error_type") == "ORPHAN_MAKE").alias("orphan_make_count"),
            count_if(F.col("error_type") == "NULL_CRITICAL_FIELD").alias("null_field_count"),
        )
    )


def reconcile(raw: DataFrame | int, flat: DataFrame, clean: DataFrame, metrics: DataFrame, key: str = "vin",
              measure: str = "total_vehicles") -> DataFrame:
    """Cross-layer row counts and drift, PASS / DRIFT_DETECTED (DQ-13).
    Five one-row aggregates side by side; a NULL drift (empty gold) is
    not 0, so it reports DRIFT_DETECTED. ``raw`` may be the number of its
    rows, where a pass over them has counted them already."""
    keyed = flat.where(F.col(key).isNotNull())
    if isinstance(raw, int):
        b = flat.sparkSession.range(1).select(F.lit(raw).cast("long").alias("bronze_raw_rows"))
    else:
        b = raw.agg(F.count(F.lit(1)).alias("bronze_raw_rows"))
    bf = keyed.agg(F.count(F.lit(1)).alias("bronze_flattened_rows"), F.countDistinct(key).alias("bronze_unique_vins"))
    s = clean.agg(F.count(F.lit(1)).alias("silver_rows"))
    g = metrics.agg(F.count(F.lit(1)).alias("gold_groups"), F.sum(measure).cast("long").alias("gold_total_vehicles"))
    out = attach_scalars(b, bf, s, g)
    b2s = F.col("silver_rows") - F.col("bronze_unique_vins")
    s2g = F.col("gold_total_vehicles") - F.col("silver_rows")
    return out.select(
        "bronze_raw_rows",
        "bronze_flattened_rows",
        "bronze_unique_vins",
        (F.col("bronze_flattened_rows") - F.col("bronze_unique_vins")).alias("duplicates_removed"),
        "silver_rows",
        b2s.alias("bronze_to_silver_drift"),
        "gold_groups",
        "gold_total_vehicles",
        s2g.alias("silver_to_gold_drift"),
        F.when((b2s == 0) & (s2g == 0), F.lit("PASS")).otherwise(F.lit("DRIFT_DETECTED")).alias("status"),
    )


# Freshness tiers in minutes (fresh limit, acceptable limit)
# per layer, as the source's monitoring defines them.
FRESHNESS_TIERS = {"SILVER": (5, 60), "GOLD": (15, 120), "ICEBERG": (30, 180)}


def freshness(layer_ts: DataFrame, as_of, tiers: Mapping[str, tuple[int, int]] = FRESHNESS_TIERS) -> DataFrame:
    """Freshness status per layer (DQ-14). ``layer_ts`` has ``layer``,
    ``table_name``, ``last_refresh``; minutes are counted as boundaries
    crossed; an unknown age is STALE."""
    now = F.lit(as_of).cast("timestamp_ntz")
    mins = boundaries_between("minute", F.col("last_refresh"), now)
    fresh = F.lit(None).cast("long")
    acc = F.lit(None).cast("long")
    for layer, (f_lim, a_lim) in tiers.items():
        fresh = F.when(F.col("layer") == layer, F.lit(f_lim)).otherwise(fresh)
        acc = F.when(F.col("layer") == layer, F.lit(a_lim)).otherwise(acc)
    return layer_ts.select(
        "layer", "table_name", "last_refresh",
        mins.alias("minutes_since_refresh"),
        F.when(mins <= fresh, F.lit("FRESH")).when(mins <= acc, F.lit("ACCEPTABLE")).otherwise(F.lit("STALE")).alias("freshness_status"),
    )


def dq_dashboard(errors: DataFrame, duplicates: DataFrame, reconciliation: DataFrame, as_of) -> DataFrame:
    """Error sections x duplicate summary x reconciliation (DQ-15); empty
    when there are no errors, as a cross join with an empty side is."""
    now = F.lit(as_of).cast("timestamp_ntz")
    e = errors.groupBy("source_layer", "error_type").agg(
        F.count(F.lit(1)).alias("total_errors"),
        count_if(F.col("detected_at") >= now - F.expr("INTERVAL 24 HOURS")).alias("errors_last_24h"),
        count_if(F.col("detected_at") >= now - F.expr("INTERVAL 1 HOURS")).alias("errors_last_1h"),
        F.min("detected_at").alias("first_seen"),
        F.max("detected_at").alias("last_seen"),
    )
    d = duplicates.agg(
        F.count(F.lit(1)).alias("total_duplicate_vins"),
        F.sum("occurrence_count").cast("long").alias("total_duplicate_rows"),
        count_if(F.col("detected_at") >= now - F.expr("INTERVAL 24 HOURS")).alias("dupes_last_24h"),
    )
    r = reconciliation.select(
        "bronze_raw_rows", "silver_rows", "gold_total_vehicles", "bronze_to_silver_drift",
        "silver_to_gold_drift", F.col("status").alias("reconciliation_status"),
    )
    return attach_scalars(e.withColumn("section", F.lit("ERROR_SUMMARY")), d, r)


def expect_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column test ``not_null``: one row per (column, failing count>0)."""
    aggs = [count_if(F.col(c).isNull()).alias(c) for c in cols]
    counts = df.agg(*aggs)
    stack = F.expr("stack({}, {})".format(len(cols), ", ".join(f"'{c}', `{c}`" for c in cols)))
    return counts.select(stack.alias("column_name", "failures")).where(F.col("failures") > 0).select(
        F.lit("not_null").alias("test"), "column_name", F.col("failures").cast("long").alias("failures")
    )


def expect_unique(df: DataFrame, col: str) -> DataFrame:
    """Column test ``unique``: values occurring more than once."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def dq_timeliness(df: DataFrame, ts: str, as_of, max_hours: int = 24) -> DataFrame:
    """Rows older than ``max_hours`` at ``as_of`` (DQ-7)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return df.where(F.col(ts) < now - F.expr(f"INTERVAL {int(max_hours)} HOURS"))


def share_rule_violations(shares: DataFrame, group: Sequence[str], pct_col: str, count_col: str,
                          decimals: int = 2) -> DataFrame:
    """Consumption rules (DQ-8): shares of a group must sum to 100 and counts
    must not be negative. Each share may be off by half of its last decimal,
    so a sum of ``n`` shares may be off by ``n`` times that."""
    off = F.abs(F.col("pct_sum") - 100.0)
    return (
        shares.groupBy(*group)
        .agg(F.sum(pct_col).alias("pct_sum"), F.min(count_col).alias("min_count"), F.count(F.lit(1)).alias("parts"))
        .where((off > F.col("parts") * (0.5 * 10.0**-decimals) + 1e-9) | (F.col("min_count") < 0))
        .drop("parts")
    )


def lineage_edges(log: DataFrame, as_of, name_pattern: str, days: int = 14,
                  domains: Sequence[str] = ("Table", "Dynamic Table")) -> DataFrame:
    """Source -> target object edges from an access log whose
    ``objects_modified`` is a variant array of {objectDomain, objectName,
    columns, directSources: [...]} (DQ-17)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    om = log.select(
        "user_name", "query_id", "query_start_time",
        F.explode(F.try_variant_get(F.col("objects_modified"), "$", "array<variant>")).alias("om"),
    )
    ds = om.select("*", F.explode(F.try_variant_get(F.col("om"), "$.directSources", "array<variant>")).alias("ds"))
    out = ds.select(
        F.try_variant_get("ds", "$.objectDomain", "string").alias("source_type"),
        F.try_variant_get("ds", "$.objectName", "string").alias("source_object"),
        F.try_variant_get("om", "$.objectDomain", "string").alias("target_type"),
        F.try_variant_get("om", "$.objectName", "string").alias("target_object"),
        F.to_json(F.try_variant_get("om", "$.columns", "variant")).alias("columns_modified"),
        "user_name", "query_id", "query_start_time",
    )
    return out.where(
        F.col("target_type").isin(list(domains))
        & (F.col("target_object").ilike(name_pattern) | F.col("source_object").ilike(name_pattern))
        & (F.col("query_start_time") >= now - F.expr(f"INTERVAL {int(days)} DAYS"))
    )


def metric_results(df: DataFrame, database: str) -> DataFrame:
    """Monitoring results with dotted full names, one database (DQ-18)."""
    return df.where(F.col("table_database") == database).select(
        F.concat_ws(".", "table_database", "table_schema", "table_name").alias("full_table_name"),
        "table_name",
        F.concat_ws(".", "metric_database", "metric_schema", "metric_name").alias("dmf_name"),
        "argument_names",
        F.col("value").alias("metric_value"),
        "scheduled_time",
        "change_commit_time",
    )
