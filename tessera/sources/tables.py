"""Reading named tables (SRC-4) and inline literal rows (SRC-5)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table ``<root>/<name>.parquet`` (a file or a folder)."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small fixed row set (seed data, parameters) as a DataFrame."""
    return spark.createDataFrame(list(rows), schema=schema)
