"""Previous / next row per key without a one-task window for hot keys.

``lag``/``lead`` over ``PARTITION BY key`` sends every row of a key to
one task. ``neighbors`` splits each key's sequence into time buckets
(``key, bucket`` partitions): inside a bucket the neighbour comes from an
ordinary window; the first (last) row of a bucket takes the last (first)
row of the previous (next) non-empty bucket of the same key, found on the
per-bucket summary - one row per key and bucket, built with a partial
aggregate - and joined back on (key, bucket). A key holding a third of
all rows is spread over all of its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: rows of one key that may meet in one task
MOST_PER_BUCKET = 1 << 20
UNITS = ("day", "hour", "minute", "second")


def bucket_unit(df: DataFrame, keys: Sequence[str], ts: str) -> str:
    """The coarsest time unit at which no key has more than
    ``MOST_PER_BUCKET`` rows in one bucket, from counts over all rows (the
    finest one if every unit has more). It sets how a key is spread; the
    results are the same with any unit."""
    for unit in UNITS:
        counts = df.groupBy(*keys, F.date_trunc(unit, F.col(ts)).alias("_b")).count()
        if (counts.agg(F.max("count")).first()[0] or 0) <= MOST_PER_BUCKET:
            return unit
    return UNITS[-1]


def neighbors(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    bucket: Column | str,
    direction: str = "prev",
    prefix: str | None = None,
) -> DataFrame:
    """Add ``<prefix><col>`` holding ``col`` of the previous (``prev``) or
    next (``next``) row of the same key under the ascending total order
    ``order``. ``bucket`` (an expression, or the name of a column already
    present) must be monotone in ``order`` (e.g. the day of the leading
    timestamp)."""
    prev = direction == "prev"
    prefix = prefix or ("prev_" if prev else "next_")
    if isinstance(bucket, str):
        # an existing bucket column: keeps the (key, bucket) partitioning of
        # an earlier step, so no new shuffle of the detail rows is needed
        b, keep_bucket, data = bucket, True, df
    else:
        b, keep_bucket = "_nb_bucket", False
        data = df.withColumn(b, bucket)
    w = Window.partitionBy(*keys, b).orderBy(*[F.col(c).asc() for c in order])
    shift = F.lag if prev else F.lead
    # first (prev) / last (next) row of its bucket: nothing before / after it
    data = data.withColumn("_nb_edge", shift(F.lit(1)).over(w).isNull())
    for c in cols:
        data = data.withColumn(f"_nb_in_{c}", shift(F.col(c)).over(w))

    # per (key, bucket): the boundary row in the direction we look from
    packed = F.struct(*[F.col(c).alias(c) for c in cols])
    okey = F.struct(*[F.col(c) for c in order])
    pick = F.max_by(packed, okey) if prev else F.min_by(packed, okey)
    summary = data.groupBy(*keys, b).agg(pick.alias("_nb_edge_row"))
    wb = Window.partitionBy(*keys).orderBy(F.col(b).asc())
    across = summary.select(
        *keys, b, (F.lag if prev else F.lead)(F.col("_nb_edge_row")).over(wb).alias("_nb_other")
    )
    joined = data.join(across, [*keys, b], "left")
    for c in cols:
        joined = joined.withColumn(
            prefix + c,
            F.when(F.col("_nb_edge"), F.col("_nb_other")[c]).otherwise(F.col(f"_nb_in_{c}")),
        )
    drop = ["_nb_edge", "_nb_other", *[f"_nb_in_{c}" for c in cols]] + ([] if keep_bucket else [b])
    return joined.drop(*drop)
