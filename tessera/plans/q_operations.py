"""Registered queries: catalog sync, history projections, lineage, layer
tables and answers with their context."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import monitoring as MON
from tessera.operators import quality as Q
from tessera.operators import scd2 as S
from tessera.operators.flatten import flatten_nested
from tessera.operators.joins import attach_scalars
from tessera.operators.keys import dense_ids
from tessera.plans import feeds
from tessera.plans import medallion as M
from tessera.plans.catalog import CatalogTables, enriched_metrics, sync_catalog
from tessera.plans.oracle_sql import with_flat
from tessera.plans.q_cdc import AS_OF_SQL, HIST_CTE, KEYS, TRACKED, history, with_hist
from tessera.plans.q_quality import Layers
from tessera.plans.registrations import AS_OF, flat_registrations, landing_documents
from tessera.plans.registry import query
from tessera.plans.semantic import consumption_rows, market_share, registration_model, suggested_questions, with_context
from tessera.session import scratch_path
from tessera.sources.cdc import CATALOG_CHANGE_SCHEMA
from tessera.tables import materialize


def catalog_landing(spark, sf_dir):
    """The catalog feed in the landing layout of the capture tool; whole
    values only, so that some updates change nothing."""
    ch = feeds.catalog_changes(spark, sf_dir)
    return spark.createDataFrame([], CATALOG_CHANGE_SCHEMA).unionByName(ch.select(
        "catalog_id", F.col("k").alias("manufacturer_id"), F.concat(F.lit("M"), F.col("k").cast("string")).alias("manufacturer_name"),
        F.floor("tracked_value").cast("long").alias("seating_capacity"), F.col("ts").alias("source_timestamp"),
        F.when(F.col("op") == "UPSERT", "INSERT").otherwise("DELETE").alias("cdc_operation"), "lsn",
    ), allowMissingColumns=True)


_WHOLE_HIST = HIST_CTE.replace("THEN value END", "THEN CAST(floor(value) AS BIGINT) END")


@query(
    "catalog_sync",
    f"WITH {_WHOLE_HIST} SELECT catalog_id, 'M' || k AS manufacturer_name, tracked_value AS seating_capacity, effective_start_at, "
    "effective_end_at, is_current, closed_by FROM hist",
)
def q_catalog_sync(spark, sf_dir):
    """Two syncs, the later half of the feed first, both tables compacted, a
    redelivery, the rest of the feed after it, and a sync with nothing landed
    (SRC-3, CDC-3)."""
    root = scratch_path(spark, "catalog", uuid.uuid4().hex)
    landed = catalog_landing(spark, sf_dir)
    day = F.dayofmonth("source_timestamp")
    for part in (day > 15, day <= 10, None, day > 15, day.between(11, 15)):
        if part is None:
            CatalogTables(root).compact(spark)
            continue
        landed.where(part).write.parquet(f"{root}/landing")
        assert sync_catalog(spark, f"{root}/landing", root)
    landed.limit(0).write.parquet(f"{root}/landing")
    assert not sync_catalog(spark, f"{root}/landing", root)
    return CatalogTables(root).history(spark).select(
        "catalog_id", "manufacturer_name", "seating_capacity", S.START, S.END, S.CURRENT, "closed_by"
    )


@query(
    "history_archive",
    with_hist("SELECT catalog_id, tracked_value, k, effective_start_at AS valid_from, effective_end_at AS valid_to, cdc_operation FROM hist"),
)
def q_history_archive(spark, sf_dir):
    return S.history_archive(history(spark, sf_dir), KEYS, TRACKED)


@query(
    "scd2_snapshots",
    """WITH daily AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, CAST(max(floor(value)) AS BIGINT) AS v
                      FROM events WHERE event_type = 'view' GROUP BY ALL),
       days AS (SELECT day, row_number() OVER (ORDER BY day) AS i FROM (SELECT DISTINCT day FROM daily)),
       runs AS (SELECT user_id, v, i, i - row_number() OVER (PARTITION BY user_id, v ORDER BY i) AS run FROM daily JOIN days USING (day)),
       spans AS (SELECT user_id, v, min(i) AS a, max(i) + 1 AS b FROM runs GROUP BY user_id, v, run)
       SELECT user_id, v, s.day AS effective_start_at, e.day AS effective_end_at, e.day IS NULL AS is_current
       FROM spans JOIN days s ON s.i = a LEFT JOIN days e ON e.i = b""",
)
def q_scd2_snapshots(spark, sf_dir):
    """History from daily snapshots, in which users come and go (CDC-8)."""
    views = feeds.events(spark, sf_dir).where("event_type = 'view'")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    snaps = views.groupBy("user_id", day.alias("snapshot_ts")).agg(F.max(F.floor("value")).cast("long").alias("v"))
    return S.scd2_from_snapshots(snaps, ["user_id"], ["v"]).select("user_id", "v", S.START, S.END, S.CURRENT)


@query(
    "lineage_violations",
    """SELECT 'BATCH_NOT_ONE_SYNC' AS violation, CAST(user_id % 100 AS VARCHAR) AS ref FROM events WHERE event_type = 'purchase'
       GROUP BY user_id % 100 HAVING count(DISTINCT CAST(ts AS DATE)) <> 1
       UNION ALL
       SELECT DISTINCT 'NO_LANDING_ROW', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase'
         AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
)
def q_lineage_violations(spark, sf_dir):
    """Purchases as consumption rows in batches by user, synced daily
    (CDC-12)."""
    used = feeds.purchases(spark, sf_dir).select("user_id", (F.col("user_id") % 100).alias("batch"), F.to_date("ts").alias("sync"))
    landed = feeds.events(spark, sf_dir).where("event_type = 'signup'").select("user_id")
    return MON.lineage_violations(used, landed, "batch", "sync", ["user_id"])


@query(
    "object_lineage",
    f"""SELECT 'Table' AS source_type, 'DB.RAW_' || (event_id % 5) AS source_object, if(event_id % 3 = 0, 'Stage', 'Table') AS target_type,
               'DB.' || upper(event_type) AS target_object, CAST(user_id AS VARCHAR) AS user_name, event_id AS query_id, ts AS query_start_time
        FROM events WHERE event_id % 3 <> 0 AND ts >= {AS_OF_SQL} - INTERVAL 14 DAY AND (event_type ILIKE '%p%' OR event_id % 5 = 2)""",
)
def q_object_lineage(spark, sf_dir):
    """Edges from an access log, a row per event (DQ-17)."""
    one = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    source = F.pmod("event_id", F.lit(5)).cast("string")
    text = one(
        '[{"objectDomain":"', F.when(F.col("event_id") % 3 == 0, "Stage").otherwise("Table"), '","objectName":"DB.', F.upper("event_type"),
        '","columns":[],"directSources":[{"objectDomain":"Table","objectName":"DB.RAW_', source, '"}]}]',
    )
    log = feeds.events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("user_name"), F.col("event_id").alias("query_id"), F.col("ts").alias("query_start_time"),
        F.parse_json(text).alias("objects_modified"),
    )
    found = Q.lineage_edges(log, AS_OF, "%P%").unionByName(Q.lineage_edges(log, AS_OF, "%raw_2")).distinct()
    return found.drop("columns_modified")


@query(
    "metric_results",
    """SELECT 'DB.GOLD.' || event_type AS full_table_name, event_type AS table_name, 'DB.CORE.ROWS' AS dmf_name,
              'k' AS argument_names, value AS metric_value, ts AS scheduled_time, ts AS change_commit_time
       FROM events WHERE user_id % 2 = 0""",
)
def q_metric_results(spark, sf_dir):
    """Monitoring results of one of two databases (DQ-18)."""
    ev = feeds.events(spark, sf_dir)
    text = lambda v: F.lit(v)
    return Q.metric_results(ev.select(
        F.when(F.col("user_id") % 2 == 0, "DB").otherwise("OTHER").alias("table_database"), text("GOLD").alias("table_schema"),
        F.col("event_type").alias("table_name"), text("DB").alias("metric_database"), text("CORE").alias("metric_schema"),
        text("ROWS").alias("metric_name"), text("k").alias("argument_names"), "value", F.col("ts").alias("scheduled_time"),
        F.col("ts").alias("change_commit_time"),
    ), "DB")


@query("fact_registrations", with_flat(f"SELECT *, {AS_OF_SQL} AS load_timestamp FROM clean"))
def q_fact_registrations(spark, sf_dir):
    """The gold detail fact with its load time (PRJ-6)."""
    fact = M.fact_registrations(M.clean_registrations(flat_registrations(spark, sf_dir)), AS_OF)
    return fact.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


@query("stg_registrations", with_flat("SELECT * FROM clean"))
def q_stg_registrations(spark, sf_dir):
    """The staging view over the cleansed layer (PRJ-7)."""
    return M.stg_registrations(M.clean_registrations(flat_registrations(spark, sf_dir)))


@query(
    "nested_fields",
    with_flat("SELECT source_file, count(*) * 26 AS fields, count(*) * 14 AS present FROM flat GROUP BY source_file"),
)
def q_nested_fields(spark, sf_dir):
    """Every field of every record of every document, by two chained
    flattens (PRJ-2)."""
    fields = flatten_nested(landing_documents(spark, sf_dir), "json_data", "$.data", "$")
    present = F.when(~F.is_variant_null("inner_value"), 1)
    return fields.groupBy("source_file").agg(F.count(F.lit(1)).alias("fields"), F.count(present).alias("present"))


@query(
    "market_share",
    with_flat("""SELECT make, ev_type, count(vin) AS total_vehicles, round(count(vin) * 100.0 / (SELECT count(vin) FROM clean), 2) AS market_share_pct
                 FROM clean GROUP BY ALL"""),
)
def q_market_share(spark, sf_dir):
    clean = M.clean_registrations(flat_registrations(spark, sf_dir))
    return market_share(registration_model(), clean, ["make", "ev_type"])


_STATUS_SQL = f"""
, refreshed AS (SELECT date_diff('minute', max(ts), {AS_OF_SQL}) AS age FROM events WHERE event_type = 'purchase'),
status AS (
  SELECT if(age <= 15, 'FRESH', if(age <= 120, 'ACCEPTABLE', 'STALE')) AS freshness_status,
         if((SELECT count(*) FROM clean) = (SELECT count(DISTINCT vin) FROM flat)
            AND (SELECT sum(n) FROM (SELECT count(vin) AS n FROM clean GROUP BY make, ev_type)) = (SELECT count(*) FROM clean),
            'PASS', 'DRIFT_DETECTED') AS quality_status FROM refreshed)
"""


def statuses(spark, sf_dir, layers):
    """One-row results: freshness of the gold layer, whose last refresh is
    the last purchase, and the reconciliation of layers that are written
    once."""
    last = feeds.purchases(spark, sf_dir).agg(F.max("ts").alias("last_refresh")).select(
        F.lit("GOLD").alias("layer"), F.lit("FACT").alias("table_name"), "last_refresh"
    )
    fresh = Q.freshness(last, AS_OF).select(F.col("freshness_status").alias("_f"))
    return fresh, layers.reconciliation().select(F.col("status").alias("_q"))


@query(
    "semantic_with_context",
    with_flat(_STATUS_SQL + """SELECT ev_type, count(vin) AS total_vehicles, any_value(freshness_status) AS freshness_status,
        any_value(quality_status) AS quality_status, 'rows without VIN' AS exclusions, 'latest record per VIN' AS assumptions,
        'gold' AS source_surface FROM clean, status GROUP BY ev_type"""),
)
def q_semantic_with_context(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    answer = registration_model().query(layers.clean, "fact_registrations", ["ev_type"], ["total_vehicles"])
    return with_context(
        attach_scalars(answer, *statuses(spark, sf_dir, layers)), F.col("_f"), F.col("_q"),
        exclusions="rows without VIN", assumptions="latest record per VIN",
    ).drop("_f", "_q")


@query(
    "starter_top_districts",
    with_flat("""SELECT legislative_district, count(vin) AS total_vehicles FROM clean GROUP BY 1
                 ORDER BY total_vehicles DESC, legislative_district LIMIT 10"""),
)
def q_starter_top_districts(spark, sf_dir):
    clean = M.clean_registrations(flat_registrations(spark, sf_dir))
    return suggested_questions(registration_model(), clean)["top_districts"]


@query(
    "starter_counties_with_codes",
    with_flat("SELECT county_name, counties, count(vin) AS total_vehicles FROM clean GROUP BY ALL"),
)
def q_starter_counties_with_codes(spark, sf_dir):
    clean = M.clean_registrations(flat_registrations(spark, sf_dir))
    return suggested_questions(registration_model(), clean)["counties_with_codes"]


@query(
    "enriched_metrics",
    with_flat(f""", {_WHOLE_HIST.strip()},
      names AS (SELECT make, row_number() OVER (ORDER BY make) AS i FROM (SELECT DISTINCT make FROM clean)),
      metrics AS (SELECT make, ev_type, count(vin) AS total_vehicles, avg(electric_range) AS avg_range, max(base_msrp) AS max_msrp
                  FROM clean GROUP BY ALL),
      catalog AS (SELECT n.make, 'M' || h.k AS vehicle_class, h.tracked_value AS seating_capacity, h.effective_start_at AS cdc_synced_at
                  FROM hist h JOIN names n ON n.i = h.catalog_id WHERE h.is_current)
      SELECT m.make, ev_type, total_vehicles, round(avg_range, 6) AS avg_range, max_msrp, vehicle_class, seating_capacity, cdc_synced_at
      FROM metrics m LEFT JOIN catalog c ON c.make = m.make"""),
)
def q_enriched_metrics(spark, sf_dir):
    """Market metrics with the current catalog values of their make, after a
    sync of the feed (JN-1). The first keys of the feed stand for the makes
    in the order of their names."""
    root = scratch_path(spark, "catalog", uuid.uuid4().hex)
    metrics = materialize(M.fact_market_metrics(M.clean_registrations(flat_registrations(spark, sf_dir))))
    names = dense_ids(metrics.select("make").distinct(), ["make"], "i")
    landed = catalog_landing(spark, sf_dir)
    named = landed.join(names, F.col("catalog_id") == F.col("i")).withColumns({"vehicle_class": F.col("manufacturer_name"), "manufacturer_name": F.col("make")})
    named.select(landed.columns).write.parquet(f"{root}/landing")
    sync_catalog(spark, f"{root}/landing", root)
    found = enriched_metrics(metrics, CatalogTables(root).history(spark))
    return found.withColumn("avg_range", F.round("avg_range", 6)).select(
        "make", "ev_type", "total_vehicles", "avg_range", "max_msrp", "vehicle_class", "seating_capacity", "cdc_synced_at")


@query(
    "starter_range_by_year",
    with_flat("SELECT model_year, round(avg(electric_range), 6) AS avg_electric_range, count(vin) AS total_vehicles FROM clean GROUP BY 1"),
)
def q_starter_range_by_year(spark, sf_dir):
    clean = M.clean_registrations(flat_registrations(spark, sf_dir))
    found = suggested_questions(registration_model(), clean)["avg_range_by_year"]
    return found.withColumn("avg_electric_range", F.round("avg_electric_range", 6))


@query(
    "consumption_rows",
    with_flat(_STATUS_SQL + f""", {HIST_CTE.strip()}
      SELECT p.event_id, p.user_id, p.ts, p.value, h.tracked_value, h.k, freshness_status, quality_status
      FROM status, purch p LEFT JOIN hist h ON h.catalog_id = p.user_id AND p.ts >= h.effective_start_at
        AND p.ts < coalesce(h.effective_end_at, TIMESTAMP '9999-01-01')"""),
)
def q_consumption_rows(spark, sf_dir):
    """Purchases with the catalog values of their time and the statuses
    (SEM-4)."""
    facts = attach_scalars(feeds.purchases(spark, sf_dir), *statuses(spark, sf_dir, Layers(spark, sf_dir)))
    rows = consumption_rows(facts, history(spark, sf_dir), "user_id", "catalog_id", "ts", TRACKED, F.col("_f"), F.col("_q"))
    return rows.drop("_f", "_q")
