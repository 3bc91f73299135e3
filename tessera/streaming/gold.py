"""Gold tables kept by differences (STR-3, AGG-1..3, KEY-6).

A micro-batch replaces the latest row of some keys. ``IncrementalGold`` takes
the row that each of them had before and the one that it has now, subtracts
the first from its group and adds the second to its own; groups without such
a key are neither read nor written. Counts and sums follow from that alone.
A maximum does as long as it grows; a group that loses a row with its maximum
takes the new one from its counts per price, which are kept the same way.

Every table has a batch per micro-batch, written under its number from what
was known before it, so a repeated batch replaces its first attempt. State by
group is partitioned by a hash of the group; a batch reads the partitions of
its groups only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import latest_per_key
from tessera.operators.keys import build_pair_dim
from tessera.streaming.jobs import RegistrationStream
from tessera.tables import BatchTable, materialize, newest_generation

#: Partitions of the state by group; also the most values that the driver
#: gets to prune by.
BUCKETS = 16


def _bucket(group: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*group), F.lit(BUCKETS)).cast("int")


def _same_group(left: DataFrame, right: DataFrame, group: Sequence[str]) -> Column:
    """Equality in which a null group is a group."""
    out = F.lit(True)
    for c in group:
        out = out & left[c].eqNullSafe(right[c])
    return out


class IncrementalGold:
    """``after_commit`` callback of a ``RegistrationStream``: market metrics,
    detail rows and county lookup after each micro-batch."""

    def __init__(self, root: str, as_of=None, group: Sequence[str] = ("make", "ev_type"),
                 measure: str = "electric_range", price: str = "base_msrp", pair: tuple[str, str] = ("counties", "county_name")):
        self.changes = BatchTable(f"{root}/gold/changes")
        self.groups = BatchTable(f"{root}/gold/groups", partition_by=["bucket"])
        self.prices = BatchTable(f"{root}/gold/prices", partition_by=["bucket"])
        self.pairs = BatchTable(f"{root}/gold/pairs")
        self.as_of = as_of
        self.group, self.measure, self.price, self.pair = list(group), measure, price, list(pair)

    def __call__(self, job: RegistrationStream, batch_id: int) -> None:
        spark = SparkSession.getActiveSession()
        if not isinstance(job.schema(spark, batch_id)[self.measure].dataType, T.IntegralType):
            raise ValueError(f"{self.measure} must be an integer: sums of other types don't return to zero")
        now = (F.current_timestamp() if self.as_of is None else F.lit(self.as_of)).cast("timestamp")
        self.changes.write(job.changes(spark, batch_id).withColumn("load_timestamp", now), batch_id)
        changes = spark.read.parquet(self.changes.path(batch_id))
        bucket = _bucket(self.group).alias("bucket")
        priced = changes.where(F.col(self.price).isNotNull()).groupBy(*self.group, self.price, bucket)
        self.prices.write(priced.agg(F.sum("sign").alias("n")).where("n <> 0"), batch_id)
        self.pairs.write(changes.groupBy(*self.pair).agg(F.sum("sign").alias("n")).where("n <> 0"), batch_id)
        self.groups.write(self._next_groups(spark, changes, batch_id).withColumn("load_timestamp", now), batch_id)

    def _next_groups(self, spark: SparkSession, changes: DataFrame, batch_id: int) -> DataFrame:
        """The groups that ``changes`` touch as they are after batch ``batch_id``."""
        sign = F.col("sign")
        delta = changes.groupBy(*self.group, _bucket(self.group).alias("bucket")).agg(
            F.sum("sign").alias("d_rows"),
            F.coalesce(F.sum(sign * F.col(self.measure).cast("long")), F.lit(0)).alias("d_total"),
            F.coalesce(F.sum(F.when(F.col(self.measure).isNotNull(), sign)), F.lit(0)).alias("d_measured"),
            F.max(F.when(sign > 0, F.col(self.price))).alias("gained"),
            F.max(F.when(sign < 0, F.col(self.price))).alias("lost"),
        )
        old = self._latest_groups(spark, batch_id - 1, self._buckets(changes))
        if old is None:
            return delta.select(*self.group, "bucket", F.col("d_rows").alias("n_rows"), F.col("d_total").alias("total"),
                                F.col("d_measured").alias("measured"), F.col("gained").alias("top"))
        before = lambda c: F.coalesce(old[c], F.lit(0))
        fell = old["top"].isNotNull() & (F.col("lost") >= old["top"]) & (F.col("gained").isNull() | (F.col("gained") < old["top"]))
        merged = materialize(delta.join(old, _same_group(delta, old, self.group), "left").select(
            *[delta[c] for c in [*self.group, "bucket"]],
            (before("n_rows") + F.col("d_rows")).alias("n_rows"),
            (before("total") + F.col("d_total")).alias("total"),
            (before("measured") + F.col("d_measured")).alias("measured"),
            F.greatest(old["top"], F.col("gained")).alias("top"),
            F.coalesce(fell, F.lit(False)).alias("fell"),
        ))
        fallen = merged.where("fell")
        prices = self.prices.read(spark, batch_id)
        if prices is None:  # no row has ever had a price
            return merged.drop("fell")
        left = prices.where(F.col("bucket").isin(self._buckets(fallen)))
        left = left.join(fallen.select(*self.group), _same_group(left, fallen, self.group), "left_semi")
        tops = left.groupBy(*self.group, self.price).agg(F.sum("n").alias("n")).where("n > 0").groupBy(*self.group).agg(
            F.max(self.price).alias("found"))
        return merged.join(tops, _same_group(merged, tops, self.group), "left").select(
            *[merged[c] for c in [*self.group, "bucket", "n_rows", "total", "measured"]],
            F.when(F.col("fell"), F.col("found")).otherwise(F.col("top")).alias("top"),
        )

    def _buckets(self, rows: DataFrame) -> list[int]:
        """The state partitions of the groups of ``rows``, at most ``BUCKETS``."""
        return [r.b for r in rows.select(_bucket(self.group).alias("b")).distinct().collect()]

    def _latest_groups(self, spark: SparkSession, upto: int | None, buckets: list[int] | None = None) -> DataFrame | None:
        rows = self.groups.read(spark, upto, with_batch=True)
        if rows is None:
            return None
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        state = ["n_rows", "total", "measured", "top", "load_timestamp"]
        last = rows.groupBy(*self.group).agg(F.max_by(F.struct(*state), "batch_id").alias("s"))
        return last.select(*self.group, *[f"s.{c}" for c in state])

    def metrics(self, spark: SparkSession, upto: int | None = None,
                names: tuple[str, str, str] = ("total_vehicles", "avg_range", "max_msrp")) -> DataFrame | None:
        """Vehicles, average range and highest price per group."""
        rows = self._latest_groups(spark, upto)
        if rows is None:
            return None
        avg = F.when(F.col("measured") > 0, F.col("total").cast("double") / F.col("measured"))
        return rows.where("n_rows > 0").select(
            *self.group, F.col("n_rows").alias(names[0]), avg.alias(names[1]), F.col("top").alias(names[2]), "load_timestamp"
        )

    def detail(self, job: RegistrationStream, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        """The latest row of each key with the load time of the batch that
        brought it."""
        rows = self.changes.read(spark, upto, with_batch=True)
        return None if rows is None else newest_generation(rows.where("sign > 0"), [job.key]).drop("sign")

    def county_lookup(self, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        """Numbered pairs that some latest row has."""
        rows = self.pairs.read(spark, upto)
        if rows is None:
            return None
        held = rows.groupBy(*self.pair).agg(F.sum("n").alias("n")).where("n > 0")
        return build_pair_dim(held, *self.pair, "county")

    def compact(self, job: RegistrationStream, spark: SparkSession) -> None:
        """Sum up the state so far, so that later reads are short."""
        def summed(keys: list[str]):
            return lambda rows: rows.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")

        def last(rows: DataFrame) -> DataFrame:
            keys = [*self.group, "bucket"]
            state = [c for c in rows.columns if c not in (*keys, "batch_id")]
            found = rows.groupBy(*keys).agg(F.max_by(F.struct(*state), "batch_id").alias("s"))
            return found.select(*keys, *[f"s.{c}" for c in state])

        self.prices.compact(spark, summed([*self.group, self.price, "bucket"]))
        self.pairs.compact(spark, summed(self.pair))
        self.groups.compact(spark, last)
        self.changes.compact(spark, lambda rows: newest_generation(rows.where("sign > 0"), [job.key]))
