"""Aggregations, shares, trends, running totals and top-N.

Every grouped aggregate here is decomposable (count, sum, min, max, avg as
sum+count), so Spark runs a partial aggregate before the shuffle: a key
holding a third of all rows is pre-combined in every map task and reaches
its reducer as one row per map task. Distinct counts are planned by
Catalyst's distinct expansion, also partial on both levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import pct


def market_metrics(
    df: DataFrame,
    group: Sequence[str] = ("make", "ev_type"),
    key: str = "vin",
    measure: str = "electric_range",
    price: str = "base_msrp",
    round_avg: int | None = None,
    drop_null: Sequence[str] = (),
    as_of=None,
    names: tuple[str, str, str] = ("total_vehicles", "avg_range", "max_msrp"),
) -> DataFrame:
    """COUNT(key), AVG(measure), MAX(price) per group (AGG-1); with
    ``round_avg`` and ``drop_null`` it is the variant that rounds the
    average and drops rows with a NULL group value (AGG-2)."""
    src = df
    for c in drop_null:
        src = src.where(F.col(c).isNotNull())
    avg = F.avg(measure)
    if round_avg is not None:
        avg = F.round(avg, round_avg)
    out = src.groupBy(*group).agg(
        F.count(key).alias(names[0]),
        avg.alias(names[1]),
        F.max(price).alias(names[2]),
    )
    if as_of is not None:
        out = out.withColumn("load_timestamp", F.lit(as_of).cast("timestamp"))
    return out


def share_within(
    df: DataFrame,
    group: Sequence[str],
    part: Sequence[str],
    measure: str | None = None,
    count_name: str = "regs",
    total_name: str = "total_regs",
    pct_name: str = "mix_pct",
    scale: int = 2,
) -> DataFrame:
    """Share of each ``part`` inside its ``group`` in percent (AGG-11).

    The group total comes from a window over the already aggregated rows
    (one row per group x part) instead of a self join, so the detail data
    is shuffled once.
    """
    value = F.count(F.lit(1)) if measure is None else F.sum(measure)
    counts = df.groupBy(*group, *part).agg(value.alias(count_name))
    total = F.sum(count_name).over(Window.partitionBy(*group))
    return counts.withColumn(total_name, total).withColumn(pct_name, pct(count_name, total_name, scale))


def trend(df: DataFrame, ts: str, unit: str, dims: Sequence[str], name: str = "n", bucket: str = "bucket") -> DataFrame:
    """Count per time bucket x dims (``DATE_TRUNC(unit, ts)``, AGG-9). The
    bucket is a wall-clock ``TIMESTAMP_NTZ`` whatever the session zone."""
    b = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    return df.groupBy(b.alias(bucket), *dims).agg(F.count(F.lit(1)).alias(name))


def daily_rollup(
    df: DataFrame,
    ts: str,
    dims: Sequence[str],
    sums: Sequence[tuple[str, str]],
    date_col: str = "usage_date",
) -> DataFrame:
    """Per day x dims sums (AGG-10); ``sums`` is (input, output) pairs."""
    return df.groupBy(F.to_date(F.col(ts)).alias(date_col), *dims).agg(
        *[F.sum(src).alias(out) for src, out in sums]
    )


def yoy(df: DataFrame, year: str, measure: str, group: Sequence[str] = (), name: str = "yoy_growth_pct") -> DataFrame:
    """Year-over-year growth in percent of an already aggregated measure
    (AGG-13); the first year of each group has NULL growth."""
    w = Window.partitionBy(*group).orderBy(F.col(year).asc())
    prev = F.lag(measure).over(w)
    return df.withColumn("prev_" + measure, prev).withColumn(
        name, F.round((F.col(measure) - prev) * F.lit(100.0) / F.nullif(prev, F.lit(0)), 2)
    )


def running_sum(df: DataFrame, partition: Sequence[str], order: str, measure: str, name: str) -> DataFrame:
    """``SUM(measure) OVER (PARTITION BY ... ORDER BY order)`` with the SQL
    default RANGE frame (peers share the running value, WIN-3)."""
    w = Window.partitionBy(*partition).orderBy(F.col(order).asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(measure).over(w))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-N rows (``ORDER BY ... LIMIT n``): planned as
    ``TakeOrderedAndProject`` - each task keeps its own top n, the driver
    merges n x tasks rows, never the whole input."""
    return df.orderBy(*order).limit(n)


def count_if(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``."""
    return F.count(F.when(cond, F.lit(1)))
