"""Registered queries: forecast, metric registry, growth, diversity,
pipeline snapshot, path extraction, schema drift and backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.aggregates import yoy
from tessera.operators.flatten import extract_paths, flatten
from tessera.operators.forecast import linear_forecast
from tessera.operators.joins import attach_scalars
from tessera.operators.monitoring import schema_drift
from tessera.plans import feeds
from tessera.plans import medallion as M
from tessera.plans.oracle_sql import with_flat
from tessera.plans.registrations import REGISTRATION_POSITIONS, flat_registrations, landing_documents
from tessera.plans.registry import query
from tessera.plans.semantic import registration_model


def clean(spark, sf_dir):
    return M.clean_registrations(flat_registrations(spark, sf_dir))


def yearly(spark, sf_dir, group=()):
    return (
        clean(spark, sf_dir)
        .where(F.col("model_year").isNotNull())
        .groupBy(*group, "model_year")
        .agg(F.count(F.lit(1)).alias("registrations"))
    )


FORECAST_SQL = """, yearly AS (SELECT {g} model_year, count(*) AS registrations FROM clean WHERE model_year IS NOT NULL GROUP BY {g} model_year),
fit AS (
  SELECT {g} CAST(count(*) AS HUGEINT) AS n, max(model_year) AS last_year,
         CAST(sum(model_year) AS HUGEINT) AS sx, CAST(sum(registrations) AS HUGEINT) AS sy,
         sum(CAST(model_year AS HUGEINT) * model_year) AS sxx, sum(CAST(model_year AS HUGEINT) * registrations) AS sxy
  FROM yearly GROUP BY {gg} HAVING count(*) >= 3
),
pq AS (
  SELECT {g} CAST(last_year + step AS INTEGER) AS model_year,
         CASE WHEN n * sxx - sx * sx = 0 THEN sy
              ELSE sy * (n * sxx - sx * sx) + (n * sxy - sx * sy) * (n * (last_year + step) - sx) END AS p,
         CASE WHEN n * sxx - sx * sx = 0 THEN n ELSE n * (n * sxx - sx * sx) END AS q
  FROM fit, (SELECT unnest(range(1, 4)) AS step)
)
SELECT {g} model_year,
       CAST(CASE WHEN p <= 0 THEN 0
                 ELSE p // q + CASE WHEN 2 * (p - (p // q) * q) > q THEN 1
                                    WHEN 2 * (p - (p // q) * q) = q AND (p // q) % 2 = 1 THEN 1 ELSE 0 END END AS BIGINT) AS forecast_registrations
FROM pq"""


@query("forecast_by_make", with_flat(FORECAST_SQL.format(g="make,", gg="make")))
def q_forecast_by_make(spark, sf_dir):
    return linear_forecast(yearly(spark, sf_dir, ["make"]), ["make"], "model_year", "registrations", out_y="forecast_registrations")


@query("forecast_total", with_flat(FORECAST_SQL.format(g="", gg="()")))
def q_forecast_total(spark, sf_dir):
    return linear_forecast(yearly(spark, sf_dir), [], "model_year", "registrations", out_y="forecast_registrations")


@query(
    "yoy_growth",
    with_flat(
        """, y AS (SELECT model_year, CAST(count(*) AS BIGINT) AS registrations FROM clean WHERE model_year IS NOT NULL GROUP BY model_year)
           SELECT model_year, registrations, lag(registrations) OVER (ORDER BY model_year) AS prev_registrations,
                  round((registrations - lag(registrations) OVER (ORDER BY model_year)) * 100.0
                        / nullif(lag(registrations) OVER (ORDER BY model_year), 0), 2) AS yoy_growth_pct
           FROM y"""
    ),
)
def q_yoy_growth(spark, sf_dir):
    # one row per year: the ordered window is over a bounded set of years
    return yoy(yearly(spark, sf_dir), "model_year", "registrations")


SEM_MEASURES = ["total_vehicles", "max_base_msrp", "bev_count", "phev_count", "model_diversity", "county_coverage"]


@query(
    "semantic_make_metrics",
    with_flat(
        """SELECT make, CAST(count(vin) AS BIGINT) AS total_vehicles, max(base_msrp) AS max_base_msrp,
                  CAST(count(CASE WHEN ev_type = 'STANDARD' THEN 1 END) AS BIGINT) AS bev_count,
                  CAST(count(CASE WHEN ev_type = 'PROMO' THEN 1 END) AS BIGINT) AS phev_count,
                  CAST(count(DISTINCT model) AS BIGINT) AS model_diversity,
                  CAST(count(DISTINCT county_name) AS BIGINT) AS county_coverage
           FROM clean GROUP BY make"""
    ),
)
def q_semantic_make_metrics(spark, sf_dir):
    model = registration_model(bev_label="STANDARD", phev_label="PROMO")
    return model.query(clean(spark, sf_dir), "fact_registrations", ["make"], SEM_MEASURES)


@query(
    "semantic_year_type_share",
    with_flat(
        """SELECT model_year, ev_type, CAST(count(vin) AS BIGINT) AS total_vehicles,
                  round(CAST(count(CASE WHEN ev_type = 'STANDARD' THEN 1 END) AS DOUBLE) * 100.0 / nullif(count(*), 0), 2) AS bev_share_pct,
                  round(CAST(count(CASE WHEN cafv_eligibility = 'N' THEN 1 END) AS DOUBLE) * 100.0 / nullif(count(*), 0), 2) AS cafv_eligible_pct
           FROM flat WHERE vin IS NOT NULL GROUP BY model_year, ev_type"""
    ),
)
def q_semantic_year_type_share(spark, sf_dir):
    model = registration_model(bev_label="STANDARD", cafv_label="N")
    flat = flat_registrations(spark, sf_dir).where(F.col("vin").isNotNull())
    return model.query(flat, "fact_registrations", ["model_year", "ev_type"], ["total_vehicles", "bev_share_pct", "cafv_eligible_pct"])


@query(
    "semantic_recent_years",
    with_flat("SELECT model_year, count(vin) AS total_vehicles FROM clean WHERE model_year >= 1997 GROUP BY model_year"),
)
def q_semantic_recent_years(spark, sf_dir):
    """A filter of the caller on an answer."""
    return registration_model().query(
        clean(spark, sf_dir), "fact_registrations", ["model_year"], ["total_vehicles"], filters=[F.col("model_year") >= 1997]
    )


@query(
    "model_diversity",
    with_flat("SELECT make, CAST(count(DISTINCT model) AS BIGINT) AS models FROM clean GROUP BY make"),
)
def q_model_diversity(spark, sf_dir):
    return clean(spark, sf_dir).groupBy("make").agg(F.countDistinct("model").alias("models"))


@query(
    "layer_snapshot",
    with_flat(
        """SELECT (SELECT CAST(count(DISTINCT source_file) AS BIGINT) FROM flat) AS bronze_documents,
                  (SELECT CAST(count(*) AS BIGINT) FROM clean) AS silver_rows,
                  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT make, ev_type FROM clean)) AS gold_groups"""
    ),
)
def q_layer_snapshot(spark, sf_dir):
    raw = landing_documents(spark, sf_dir)
    c = clean(spark, sf_dir)
    gold = M.fact_market_metrics(c)
    return attach_scalars(
        raw.agg(F.count(F.lit(1)).alias("bronze_documents")),
        c.agg(F.count(F.lit(1)).alias("silver_rows")),
        gold.agg(F.count(F.lit(1)).alias("gold_groups")),
    )


@query(
    "event_props",
    "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def q_event_props(spark, sf_dir):
    ev = feeds.events(spark, sf_dir).withColumn("p", F.parse_json("props"))
    return extract_paths(ev, "p", [("$.k", "k", "bigint")], keep=["event_id", "event_type"])


@query(
    "schema_drift",
    # every position of the landed rows is a JSON string or null, so
    # against an all-STRING contract nothing drifts; against a numeric
    # contract for the year and range positions every present value does
    with_flat(
        """SELECT 13 AS position, 'BIGINT' AS expected_type, 'STRING' AS observed_type, CAST(count(model_year) AS BIGINT) AS rows FROM flat
           UNION ALL
           SELECT 18, 'BIGINT', 'STRING', CAST(count(electric_range) AS BIGINT) FROM flat"""
    ),
)
def q_schema_drift(spark, sf_dir):
    flat = flatten(landing_documents(spark, sf_dir), "json_data", "$.data")
    expected = {pos: "STRING" for pos, _, _ in REGISTRATION_POSITIONS}
    expected[13] = "BIGINT"
    expected[18] = "BIGINT"
    return schema_drift(flat, expected)


@query(
    "backfill_cafv",
    with_flat(
        """SELECT c.vin, c.dol_vehicle_id, f.cafv_eligibility
           FROM clean c LEFT JOIN flat f ON c.dol_vehicle_id = f.dol_vehicle_id"""
    ),
)
def q_backfill_cafv(spark, sf_dir):
    """The cleansed layer has no CAFV column; backfill it from the raw
    flatten by the unique record id (ENR-1)."""
    flat = flat_registrations(spark, sf_dir)
    c = clean(spark, sf_dir).select("vin", "dol_vehicle_id").withColumn("cafv_eligibility", F.lit(None).cast("string"))
    src = flat.select(F.col("dol_vehicle_id").alias("_d"), F.col("cafv_eligibility").alias("_c"))
    return c.join(src, F.col("dol_vehicle_id") == F.col("_d"), "left").select(
        "vin", "dol_vehicle_id", F.coalesce(F.col("cafv_eligibility"), F.col("_c")).alias("cafv_eligibility")
    )
