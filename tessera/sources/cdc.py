"""Change-data-capture landing tables (SRC-3): rows with the business
columns, the change time, a log position and the operation, as landed by
an external capture tool in parquet or JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_CHANGE_SCHEMA = (
    "catalog_id bigint, manufacturer_id bigint, manufacturer_name string, country string, "
    "vehicle_class string, vehicle_category string, fuel_type string, transmission string, "
    "seating_capacity bigint, last_updated_at timestamp_ntz, source_timestamp timestamp_ntz, "
    "cdc_operation string, lsn bigint"
)

_OPS = {"INSERT": "UPSERT", "UPDATE": "UPSERT", "UPSERT": "UPSERT", "DELETE": "DELETE"}


def read_cdc(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = CATALOG_CHANGE_SCHEMA) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def stream_cdc(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = CATALOG_CHANGE_SCHEMA,
               max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path) if fmt == "parquet" else r.json(path)


def normalize_ops(df: DataFrame, op_col: str = "cdc_operation") -> DataFrame:
    """INSERT / UPDATE -> UPSERT, DELETE stays; missing operation means
    upsert (the landing payload may omit it)."""
    op = F.upper(F.coalesce(F.col(op_col), F.lit("UPSERT")))
    mapped = F.lit(None).cast("string")
    for k, v in _OPS.items():
        mapped = F.when(op == k, F.lit(v)).otherwise(mapped)
    return df.withColumn("op", mapped)
