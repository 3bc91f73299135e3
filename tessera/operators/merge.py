"""MERGE-style keyed upsert on immutable files (SNK-4).

``target FULL OUTER JOIN source`` on the key with presence flags: a key
present in the source takes the source row (update or insert), any other
target row stays. One shuffle on the key for both sides.

``merge_partitions`` merges into a stored table partition by partition: only
the partitions that the source touches are read, and replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.tables import BatchTable, path_exists


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` after ``MERGE ... WHEN MATCHED UPDATE SET
    update_cols WHEN NOT MATCHED INSERT insert_cols``. Matched rows keep
    their target values for columns not in ``update_cols``; inserted rows
    get NULL for columns not in ``insert_cols``. Source keys must be
    unique (as MERGE requires)."""
    cols = [c for c in target.columns if c not in keys]
    upd = set(update_cols if update_cols is not None else cols)
    ins = set(insert_cols if insert_cols is not None else cols)
    t = target.select(*keys, *[F.col(c).alias("_t_" + c) for c in cols]).withColumn("_t_present", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias("_s_" + c) for c in cols if c in source.columns]).withColumn("_s_present", F.lit(True))
    j = t.join(s, list(keys), "full_outer")
    matched = F.col("_t_present").isNotNull() & F.col("_s_present").isNotNull()
    inserted = F.col("_t_present").isNull()
    out = []
    for c in cols:
        src = F.col("_s_" + c) if c in source.columns else F.lit(None)
        tgt = F.col("_t_" + c)
        v = tgt
        if c in upd:
            v = F.when(matched, src).otherwise(v)
        v = F.when(inserted, src if c in ins else F.lit(None)).otherwise(v)
        out.append(v.cast(target.schema[c].dataType).alias(c))
    return j.select(*keys, *out)


def merge_partitions(source: DataFrame, root: str, keys: Sequence[str], partition: str, run_no: int) -> DataFrame:
    """MERGE ``source`` into the table ``root``/table, partitioned by
    ``partition`` (one of ``keys``), as run ``run_no``. The merged rows of the
    touched partitions are written under the run's number first and then put
    in their places by a dynamic partition overwrite: a run that fails in
    between is finished from what it has written, a repeated one changes
    nothing, and the files of other partitions stay as they are."""
    spark = source.sparkSession
    staged = BatchTable(f"{root}/staged")
    if run_no not in staged.batches(spark):
        target = read_partitions(spark, root)
        if target is None:
            merged = source
        else:
            touched = source.select(partition).distinct()
            days = [r[0] for r in touched.collect()]  # the partitions that the source touches
            merged = merge_upsert(target.where(F.col(partition).isin(days)), source, keys).select(*source.columns)
        staged.write(merged, run_no)
    done = spark.read.parquet(staged.path(run_no))
    done.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(f"{root}/table")
    return read_partitions(spark, root)


def read_partitions(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/table"
    return spark.read.parquet(path) if path_exists(spark, path) else None
