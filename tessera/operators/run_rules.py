"""Rules over runs (DQ-8, CDC-16): what each run brought is kept as a few
measured rows, and every run is compared with the one before it.

``run_metrics`` counts per table and run the rows, and per field the rows
without it and the types that its values have in the raw records. A table of
these rows, one batch per run, is all that ``run_violations`` reads: a field
has one row per run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_metrics(rows: DataFrame, table: Column, run_no: Column, paths: Mapping[str, str], value_col: str = "value") -> DataFrame:
    """``table_name``, ``run_no``, ``field`` (null for the table itself),
    ``n_rows``, ``n_missing`` and ``types`` (sorted, without JSON null) of the
    variant ``value_col``; ``paths`` maps a field to its JSON path."""
    seen = [
        F.struct(F.lit(name).alias("field"), F.coalesce(F.schema_of_variant(F.try_variant_get(F.col(value_col), path, "variant")), F.lit("VOID")).alias("type"))
        for name, path in paths.items()
    ]
    whole = F.struct(F.lit(None).cast("string").alias("field"), F.lit("VOID").alias("type"))
    each = rows.select(table.alias("table_name"), run_no.alias("run_no"), F.explode(F.array(whole, *seen)).alias("f"))
    counts = each.groupBy("table_name", "run_no", "f").agg(F.count(F.lit(1)).alias("n"))
    typed = F.col("f.type") != "VOID"
    return counts.groupBy("table_name", "run_no", "f.field").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("f.field").isNull() | typed, 0).otherwise(F.col("n"))).alias("n_missing"),
        F.sort_array(F.collect_set(F.when(typed, F.col("f.type")))).alias("types"),  # at most the names of types
    )


def run_violations(metrics: DataFrame, max_drop: float = 0.2, max_missing_rise: float = 0.1) -> DataFrame:
    """One row per run, field and rule that is broken against the run before:

    ``ROW_COUNT_DROP``  the table lost more than ``max_drop`` of its rows
    ``FIELD_LOST``      no row has the field any more
    ``FIELD_ADDED``     no row had the field before
    ``TYPE_CHANGED``    its values have other types
    ``MISSING_RISE``    the share of rows without it rose by more than ``max_missing_rise``
    """
    by_run = Window.partitionBy("table_name", "field").orderBy("run_no")
    now = metrics.select(
        "*", F.lag("n_rows").over(by_run).alias("_rows"), F.lag("n_missing").over(by_run).alias("_missing"), F.lag("types").over(by_run).alias("_types"),
    ).where("_rows IS NOT NULL")
    table, none = F.col("field").isNull(), F.size("types") == 0
    had_none = F.size("_types") == 0
    share, old_share = F.col("n_missing") / F.col("n_rows"), F.col("_missing") / F.col("_rows")
    text = lambda c: F.col(c).cast("string")
    kinds = lambda c: F.array_join(c, "|")
    rules = [
        ("ROW_COUNT_DROP", table & (F.col("n_rows") < F.col("_rows") * (1 - max_drop)), text("_rows"), text("n_rows")),
        ("FIELD_LOST", ~table & none & ~had_none, kinds("_types"), F.lit("")),
        ("FIELD_ADDED", ~table & had_none & ~none, F.lit(""), kinds("types")),
        ("TYPE_CHANGED", ~table & ~none & ~had_none & (F.col("types") != F.col("_types")), kinds("_types"), kinds("types")),
        ("MISSING_RISE", ~table & ~none & (share > old_share + max_missing_rise), text("_missing"), text("n_missing")),
    ]
    found = [F.when(broken, F.struct(F.lit(name).alias("rule"), was.alias("previous"), now_.alias("current"))) for name, broken, was, now_ in rules]
    return now.select("table_name", "run_no", "field", F.explode(F.array_compact(F.array(*found))).alias("r")).select(
        "table_name", "run_no", "field", "r.rule", "r.previous", "r.current")
