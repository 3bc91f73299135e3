"""Stored consumption tables, bucketed by what readers group and join on
(SNK-8, SNK-3).

``refresh_consumption`` writes the denormalized base in buckets of the VIN and
the market metrics in buckets of the make, as Spark tables over folders of the
run's number: a reader that aggregates or joins on the bucket key needs no
shuffle. ``open_consumption`` names the folders of the last run as tables in a
later session.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import star as S
from tessera.tables import committed_snapshots


@dataclass(frozen=True)
class Consumption:
    base: DataFrame
    metrics: DataFrame


#: table -> bucket key
BUCKETED = {"denorm_base": "vin", "mv_market_metrics": "make_name"}


def buckets_for(input_bytes: int, bucket_bytes: int = 16 * 1024 * 1024) -> int:
    """A bucket per ``bucket_bytes`` of compressed input, 16 at least: a task
    writes one, so a fixed number of them would grow with the input."""
    return max(16, -(-input_bytes // bucket_bytes))


def _name(root: str, table: str, run_no: int) -> str:
    return f"tessera_{table}_{zlib.crc32(root.encode()):08x}_{run_no}"


def _store(df: DataFrame, root: str, table: str, run_no: int, buckets: int) -> DataFrame:
    spark, key = df.sparkSession, BUCKETED[table]
    name, path = _name(root, table, run_no), f"{root}/{table}/snap={run_no}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # one file a bucket
    rows = df.repartition(buckets, key).sortWithinPartitions(key)
    rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def refresh_consumption(star: S.Star, root: str, run_no: int, buckets: int = 16) -> Consumption:
    """The tables of run ``run_no``; a repeated run writes the same ones."""
    base = _store(S.denorm_base(star), root, "denorm_base", run_no, buckets)
    return Consumption(base, _store(S.market_metrics_wide(base), root, "mv_market_metrics", run_no, buckets))


def open_consumption(spark: SparkSession, root: str, buckets: int = 16) -> Consumption:
    """The tables of the last finished run, for a session that has not
    written them."""
    found = {}
    for table, key in BUCKETED.items():
        run_no = committed_snapshots(spark, f"{root}/{table}")[-1]
        name, path = _name(root, table, run_no), f"{root}/{table}/snap={run_no}"
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
        found[table] = spark.table(name)
    return Consumption(found["denorm_base"], found["mv_market_metrics"])


def top_makes(tables: Consumption) -> DataFrame:
    """Registrations by make: the metrics are in buckets of the make."""
    return tables.metrics.groupBy("make_name").agg(F.sum("total_vehicles").alias("total_registrations"))


def repeated_registrations(tables: Consumption) -> DataFrame:
    """Records of vehicles that were registered more than once, with their
    number: an aggregate by VIN joined to the records by VIN, both in the
    base's buckets."""
    per_vin = tables.base.groupBy("vin").agg(F.count(F.lit(1)).alias("registrations")).where("registrations > 1")
    return tables.base.join(per_vin, "vin")
