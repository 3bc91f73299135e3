"""Registered queries: raw -> cleansed -> gold registration pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.aggregates import market_metrics
from tessera.plans import medallion as M
from tessera.plans.oracle_sql import with_flat
from tessera.plans.registrations import AS_OF, flat_registrations
from tessera.plans.registry import query


def clean(spark, sf_dir, via_json=True):
    return M.clean_registrations(flat_registrations(spark, sf_dir, via_json=via_json))


@query("clean_registrations", with_flat("SELECT * FROM clean"))
def q_clean_registrations(spark, sf_dir):
    """Landed JSON -> flatten -> positional extract -> latest per VIN."""
    return clean(spark, sf_dir)


@query(
    "fact_market_metrics",
    with_flat(
        """SELECT make, ev_type, CAST(count(vin) AS BIGINT) AS total_vehicles,
                  round(avg(electric_range), 6) AS avg_range, max(base_msrp) AS max_msrp
           FROM clean GROUP BY make, ev_type"""
    ),
)
def q_fact_market_metrics(spark, sf_dir):
    detail = M.fact_registrations(clean(spark, sf_dir), AS_OF)
    return market_metrics(detail, round_avg=6)


@query(
    "fact_market_metrics_rounded",
    with_flat(
        """SELECT make, ev_type, CAST(count(vin) AS BIGINT) AS total_vehicles,
                  round(avg(electric_range), 1) AS avg_range, max(base_msrp) AS max_msrp
           FROM clean WHERE make IS NOT NULL GROUP BY make, ev_type"""
    ),
)
def q_fact_market_metrics_rounded(spark, sf_dir):
    return M.fact_market_metrics_rounded(clean(spark, sf_dir))


@query(
    "dim_county_gold",
    with_flat(
        """SELECT CAST(row_number() OVER (ORDER BY county_name ASC NULLS LAST, county_code ASC NULLS LAST) AS BIGINT) AS county_id,
                  county_code, county_name
           FROM (SELECT DISTINCT counties AS county_code, county_name FROM clean)"""
    ),
)
def q_dim_county_gold(spark, sf_dir):
    return M.dim_county_gold(clean(spark, sf_dir))


@query(
    "raw_document_counts",
    with_flat(
        """SELECT count(DISTINCT source_file) AS documents, CAST(count(*) AS BIGINT) AS flattened_rows,
                  CAST(count(DISTINCT vin) AS BIGINT) AS unique_vins
           FROM flat"""
    ),
)
def q_raw_document_counts(spark, sf_dir):
    flat = flat_registrations(spark, sf_dir)
    return flat.agg(
        F.countDistinct("source_file").alias("documents"),
        F.count(F.lit(1)).alias("flattened_rows"),
        F.countDistinct("vin").alias("unique_vins"),
    )
