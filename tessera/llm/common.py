"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


BATCH_BYTES = 16 << 20
SHORT_BATCH_BYTES = 4 << 20  # for functions that hold their rows as Python objects


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, the folder that driver
    and executors share."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir")
    return f"{base.rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: it
    is not computed again by later readers, and a lost executor costs only a
    reread. The folder belongs to the run and may be removed after it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Batches of at most ``most`` bytes between Spark and Python workers, which hold
    several of them each, unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key)).lower().rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


def joined_by_comma(items: Column) -> Column:
    return F.array_join(items, ",")


def fresh_names(columns: Iterable[str], names: Iterable[str]) -> list[str]:
    """``names`` with underscores in front until none is a column already."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
        taken.add(n.lower())
    return out
