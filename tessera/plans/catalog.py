"""Catalog change feed -> SCD2 catalog dimension -> enriched metrics
(the catalog-sync flow): landed CDC files are normalized, deduplicated on
(key, change time, log position), added to the stored change log and
applied to the history of their keys; the enriched metrics view joins the market metrics to the current catalog rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import scd2
from tessera.operators.dedup import dedup_cdc
from tessera.operators.joins import enrich_current
from tessera.sources.cdc import normalize_ops, read_cdc
from tessera.streaming.jobs import CdcStream
from tessera.tables import delete_files

CATALOG_KEY = ["catalog_id"]
CATALOG_TRACKED = [
    "manufacturer_id", "manufacturer_name", "country", "vehicle_class", "vehicle_category",
    "fuel_type", "transmission", "seating_capacity",
]


class CatalogTables(CdcStream):
    """Change log and history of the catalog, one batch per sync run."""

    def __init__(self, root: str):
        super().__init__(root, CATALOG_KEY, CATALOG_TRACKED)


def sync_catalog(spark: SparkSession, landing: str, root: str, fmt: str = "parquet", consume: bool = True) -> bool:
    """One sync run: skip when nothing landed (CDC-3); otherwise dedup
    (DED-3), add to the change log and rebuild the touched keys' history
    (CDC-1/4/5). The files that the run has read are removed once both are
    written (``consume``), and no others: what lands meanwhile is the next
    run's. A run repeated before that replaces its first attempt.
    Change time = ``source_timestamp`` (falling back to
    ``last_updated_at``), log position = ``lsn``. Returns whether there was
    anything to apply."""
    landed = read_cdc(spark, landing, fmt)
    files = landed.inputFiles()  # listed once, when the reader was made
    if landed.isEmpty():
        return False
    changes = normalize_ops(landed).select(
        *CATALOG_KEY,
        F.coalesce("source_timestamp", "last_updated_at").alias("ts"),
        F.col("lsn"),
        "op",
        *CATALOG_TRACKED,
    )
    tables = CatalogTables(root)
    log, done = tables.log.last(spark), tables.versions.last(spark)
    tables.handle(dedup_cdc(changes, CATALOG_KEY, "ts", "lsn"), log if log > done else done + 1)
    if consume:
        delete_files(spark, files, landing)
    return True


def current_catalog(history: DataFrame) -> DataFrame:
    """Current-state view with the sync time of each row (CDC-6)."""
    return scd2.current(history).withColumn("cdc_synced_at", F.col(scd2.START))


def enriched_metrics(metrics: DataFrame, history: DataFrame) -> DataFrame:
    """Market metrics with the current catalog attributes of their make
    (JN-1): a left join on the manufacturer name restricted to current
    rows; ``joins.fanout_keys`` reports names with several current rows."""
    cat = current_catalog(history).withColumn("is_current", F.lit(True))
    return enrich_current(
        metrics, cat, "make", "manufacturer_name",
        attrs=["vehicle_class", "vehicle_category", "fuel_type", "seating_capacity", "cdc_synced_at"],
    )
