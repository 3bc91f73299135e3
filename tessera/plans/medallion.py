"""Raw -> cleansed -> gold layer transforms (registration pipeline)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import market_metrics
from tessera.operators.dedup import latest_per_key
from tessera.operators.filters import reject_null_keys, stamp
from tessera.operators.keys import build_pair_dim

CLEAN_COLUMNS = [
    "vin", "county_name", "make", "model", "model_year", "ev_type", "electric_range",
    "base_msrp", "legislative_district", "dol_vehicle_id", "vehicle_location",
    "electric_utility", "census_tract_2020", "counties", "source_file",
]


def latest_order():
    """Latest file wins; inside a file the later array position wins."""
    return [F.col("source_file").desc_nulls_last(), F.col("pos").desc_nulls_last()]


def clean_registrations(flat: DataFrame, columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """Cleansed layer: non-null VIN, latest record per VIN (DED-1).
    ``columns`` are those that its readers use (all by default)."""
    keyed = reject_null_keys(flat, ["vin"])
    return latest_per_key(keyed, ["vin"], latest_order()).select(*columns)


def fact_registrations(clean: DataFrame, as_of) -> DataFrame:
    """Gold detail fact: the cleansed rows plus the load timestamp."""
    return stamp(clean.select(*CLEAN_COLUMNS), as_of)


def dim_county_gold(detail: DataFrame) -> DataFrame:
    """County lookup of distinct (code, name), ids by (name, code)."""
    return build_pair_dim(detail, "counties", "county_name", "county")


def fact_market_metrics(detail: DataFrame, as_of=None) -> DataFrame:
    """Per make x EV type: vehicles, average range, highest price."""
    return market_metrics(detail, as_of=as_of)


def fact_market_metrics_rounded(detail: DataFrame) -> DataFrame:
    """Variant that drops NULL makes and rounds the average to 1 place."""
    return market_metrics(detail, round_avg=1, drop_null=["make"])


def stg_registrations(clean: DataFrame) -> DataFrame:
    """Staging passthrough (PRJ-7): the cleansed columns under their
    consumer-facing names; the boundary where source renames are absorbed."""
    return clean.select(*CLEAN_COLUMNS)
