"""SCD2 history kept by suffixes (STR-6, CDC-1/4/5).

A change can only alter its key's history from its own instant on. A batch
therefore finds the earliest changed instant of each of its keys, takes the
last version before it as the start (``seed``), replays the stored changes
from that instant on, and writes the versions that follow, with the instant
from which on they replace what was known (``cut``). Versions before it stay
where they are, and neither they nor the changes that made them are read.

Tables, all written per batch under its number:

    change_log  every change once, partitioned by key hash and time
    history     the versions of the batch's suffixes, partitioned the same way
    cuts        per key the instant from which the batch's versions replace older ones
    heads       per key its first start and its last version after the batch

Changes in order start at the key's last version, which ``heads`` has. For a
late one the version before it is looked up in the stored history, in
windows that go back from the change and double; a window is read for the
keys alone that no nearer one has answered.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import scd2
from tessera.operators.scd2 import DELETE, END, START, UPSERT
from tessera.tables import BatchTable, materialize

#: Hash partitions of the stored tables; also the most bounds that the
#: driver gets to prune by.
KEY_BUCKETS = 16


class CdcStream:
    """CDC micro-batches applied to an SCD2 history. Files arriving late or
    out of order give the in-order history. ``unit`` is the time span of a
    partition of the log and the history (``day``, ``month`` or ``year``);
    ``types`` name those of attributes for readers that come before the first
    change."""

    def __init__(self, root: str, keys: Sequence[str], tracked: Sequence[str],
                 ts: str = "ts", lsn: str = "lsn", op: str = "op", unit: str = "month", types: Mapping[str, str] | None = None):
        self.types = dict(types or {})
        self.log = BatchTable(f"{root}/change_log", partition_by=["key_bucket", "since"])
        self.versions = BatchTable(f"{root}/history", partition_by=["key_bucket", "since"])
        self.cuts = BatchTable(f"{root}/cuts")
        self.heads = BatchTable(f"{root}/heads")
        self.keys, self.tracked, self.unit = list(keys), list(tracked), unit
        self.ts, self.lsn, self.op = ts, lsn, op

    def _parted(self, df: DataFrame, instant: str) -> DataFrame:
        return df.withColumns({"key_bucket": self._key_bucket(), "since": self._since(F.col(instant))})

    def _key_bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(KEY_BUCKETS)).cast("int")

    def _since(self, instant: Column) -> Column:
        return F.date_trunc(self.unit, instant).cast("date")

    # -- reading

    def history(self, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        rows = self.versions.read(spark, upto, with_batch=True)
        return None if rows is None else self._live(rows, spark, upto).drop("batch_id", "key_bucket", "since")

    def _live(self, rows: DataFrame, spark: SparkSession, upto: int | None) -> DataFrame:
        """The versions that no later batch replaces: those before every later
        cut of their key. The cuts of a key, one per batch, become the
        earliest later cut per key and batch, an equi join away."""
        cuts = self.cuts.read(spark, upto, with_batch=True)
        wrote = rows.select(*self.keys, "batch_id").distinct().withColumn("cut", F.lit(None).cast(cuts.schema["cut"].dataType))
        per_batch = cuts.select(*self.keys, "batch_id", "cut").unionByName(wrote).groupBy(*self.keys, "batch_id").agg(F.max("cut").alias("cut"))
        later = Window.partitionBy(*self.keys).orderBy(F.col("batch_id").desc()).rowsBetween(Window.unboundedPreceding, -1)
        ends = per_batch.select(*self.keys, "batch_id", F.min("cut").over(later).alias("_cut"))
        start = F.struct(F.col(START).alias("ts"), F.col("start_lsn").alias("lsn"))
        return rows.join(ends, [*self.keys, "batch_id"]).where(F.col("_cut").isNull() | (start < F.col("_cut"))).drop("_cut")

    def _last_heads(self, spark: SparkSession, upto: int) -> DataFrame | None:
        rows = self.heads.read(spark, upto, with_batch=True)
        if rows is None:
            return None
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct("first", "last"), "batch_id").alias("h")).select(*self.keys, "h.first", "h.last")

    def type_of(self, column: str) -> str:
        """The type of an attribute before any version is stored."""
        return {START: "timestamp_ntz", END: "timestamp_ntz"}.get(column, self.types.get(column, "string"))

    def replaced(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, DataFrame] | None:
        """The versions that batch ``batch_id`` took away and those that it put
        there, without the ones that are the same on both sides; None while
        there is no version at all."""
        put = self.versions.batch(spark, batch_id)
        before = self.versions.read(spark, batch_id - 1, with_batch=True)
        if put is None and before is None:
            return None
        put = (before.drop("batch_id").limit(0) if put is None else put).drop("key_bucket", "since")
        if before is None:
            return put.limit(0), put
        cuts = spark.read.parquet(self.cuts.path(batch_id))
        buckets = [r.b for r in cuts.select(self._key_bucket().alias("b")).distinct().collect()]  # at most KEY_BUCKETS
        start = F.struct(F.col(START).alias("ts"), F.col("start_lsn").alias("lsn"))
        mine = before.where(F.col("key_bucket").isin(buckets)).join(cuts, self.keys).where(start >= F.col("cut")).drop("cut")
        gone = materialize(self._live(mine, spark, batch_id - 1).select(*put.columns))
        # equal rows cancel out; of a version only what facts can see counts
        seen = [*self.keys, *self.tracked, START, END, "start_lsn"]

        def less(a: DataFrame, b: DataFrame) -> DataFrame:
            other = b.select(*[F.col(c).alias(f"_{c}") for c in seen])
            same = F.lit(True)
            for c in seen:
                same = same & (F.col(c) == F.col(f"_{c}") if c in self.keys else F.col(c).eqNullSafe(F.col(f"_{c}")))
            return a.join(other, same, "left_anti")

        return less(gone, put), less(put, gone)

    # -- writing

    def handle(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        if changes.isEmpty():
            return  # nothing landed since the last run: skip (CDC-3)
        self.log.write(self._parted(scd2.change_log_merge(None, changes, self.keys, self.ts, self.lsn), self.ts), batch_id)
        batch = spark.read.parquet(self.log.path(batch_id))
        instant = F.struct(F.col(self.ts).alias("ts"), F.col(self.lsn).alias("lsn"))
        starts = batch.groupBy(*self.keys).agg(F.min(instant).alias("t0"))
        starts = self._with_seeds(spark, starts, batch_id)
        suffix = materialize(self._rebuilt(spark, starts, batch_id))
        self._write_heads(starts, suffix, batch_id)
        self.cuts.write(starts.select(*self.keys, F.coalesce(_start_of("seed"), F.col("t0")).alias("cut")), batch_id)
        self.versions.write(self._parted(suffix, START), batch_id)  # from here on the batch is finished

    def _version(self) -> Column:
        return F.struct(*self.tracked, START, END, "cdc_operation", "start_lsn", "end_lsn", "closed_by")

    def _with_seeds(self, spark: SparkSession, starts: DataFrame, batch_id: int) -> DataFrame:
        """``starts`` (keys, ``t0``) with ``seed``, the last version before
        ``t0``, and ``first``, the key's first start so far."""
        heads = self._last_heads(spark, batch_id - 1)
        if heads is None:
            blank = [F.lit(None).cast(t).alias(n) for n, t in self._head_types(spark, batch_id)]
            return materialize(starts.select(*self.keys, "t0", *blank))
        known = starts.join(heads, self.keys, "left")
        in_order = _start_of("last") < F.col("t0")
        late = F.col("last").isNotNull() & ~in_order & (F.col("first") < F.col("t0"))
        known = materialize(known.select(
            *self.keys, "t0", "first", F.when(in_order, F.col("last")).alias("seed"), F.coalesce(late, F.lit(False)).alias("late")))
        found = self._looked_up(spark, known.where("late").select(*self.keys, "t0"), batch_id - 1)
        if found is None:
            return known.drop("late")
        found = found.withColumnRenamed("seed", "_found")
        return materialize(known.join(found, self.keys, "left").select(*self.keys, "t0", "first", F.coalesce("seed", "_found").alias("seed")))

    def _head_types(self, spark: SparkSession, batch_id: int) -> list[tuple[str, str]]:
        """Types of ``first`` and ``seed`` before any version is stored."""
        types = {f.name: f.dataType.simpleString() for f in spark.read.parquet(self.log.path(batch_id)).schema.fields}
        ts, lsn = types[self.ts], types[self.lsn]
        tracked = ",".join(f"{c}:{types[c]}" for c in self.tracked)
        version = f"struct<{tracked},{START}:{ts},{END}:{ts},cdc_operation:string,start_lsn:{lsn},end_lsn:{lsn},closed_by:string>"
        return [("first", f"struct<ts:{ts},lsn:{lsn}>"), ("seed", version)]

    def _looked_up(self, spark: SparkSession, late: DataFrame, upto: int) -> DataFrame | None:
        """The last stored version before ``t0`` of keys that have one."""
        left, found = late, None
        newest = left.agg(F.max(self._since(F.col("t0.ts"))).alias("d")).first()["d"]
        days = 31
        while newest is not None:
            oldest = newest - datetime.timedelta(days=days)
            buckets = [r.b for r in left.select(self._key_bucket().alias("b")).distinct().collect()]  # at most KEY_BUCKETS
            window = self.versions.read(spark, upto, with_batch=True).where(
                F.col("key_bucket").isin(buckets) & F.col("since").between(F.lit(oldest), F.lit(newest)))
            rows = self._live(window.join(left.select(*self.keys), self.keys, "left_semi"), spark, upto)
            before = rows.join(left, self.keys).where(F.struct(F.col(START), F.col("start_lsn")) < F.struct("t0.ts", "t0.lsn"))
            nearest = materialize(before.groupBy(*self.keys).agg(F.max_by(self._version(), F.struct(START, "start_lsn")).alias("seed")))
            found = nearest if found is None else found.unionByName(nearest)
            left = materialize(left.join(nearest.select(*self.keys), self.keys, "left_anti"))
            newest = None if left.isEmpty() else oldest - datetime.timedelta(days=1)
            days *= 2
        return found

    def _rebuilt(self, spark: SparkSession, starts: DataFrame, batch_id: int) -> DataFrame:
        """The versions of the suffixes: the seeds and all stored changes from
        ``t0`` on."""
        bounds = starts.groupBy(self._key_bucket().alias("b")).agg(F.min(self._since(F.col("t0.ts"))).alias("d")).collect()  # at most KEY_BUCKETS
        recent = F.lit(False)
        for r in bounds:
            recent = recent | ((F.col("key_bucket") == r.b) & (F.col("since") >= F.lit(r.d)))
        columns = [F.col(self.ts).alias("ts"), F.col(self.lsn).alias("lsn"), F.col(self.op).alias("op"), *self.tracked]
        past = self.log.read(spark, batch_id).where(recent).select(*self.keys, *columns)
        replay = past.join(starts.select(*self.keys, "t0"), self.keys).where(F.struct("ts", "lsn") >= F.col("t0")).drop("t0")
        seeded = starts.where("seed IS NOT NULL").select(*self.keys, "t0", "seed", "seed.*")
        ended = (F.col("closed_by") == DELETE) & (F.struct(END, "end_lsn") < F.col("t0"))
        opened = scd2.versions_to_changes(seeded.withColumn("closed_by", F.when(ended, F.lit(DELETE))), self.keys, self.tracked)
        versions = scd2.versions_from_changes(replay.unionByName(opened.select(*replay.columns)), self.keys, self.tracked)
        # how the seed was opened is known; in the replay it comes first
        first = seeded.select(*self.keys, F.col(START).alias("_s"), F.col("start_lsn").alias("_l"), F.col("cdc_operation").alias("_how"))
        same = (F.col(START) == F.col("_s")) & F.col("start_lsn").eqNullSafe(F.col("_l"))
        joined = versions.join(first, self.keys, "left").withColumn("cdc_operation", F.when(same, F.col("_how")).otherwise(F.col("cdc_operation")))
        return joined.select(*versions.columns)

    def _write_heads(self, starts: DataFrame, suffix: DataFrame, batch_id: int) -> None:
        at = F.struct(F.col(START).alias("ts"), F.col("start_lsn").alias("lsn"))
        ends = suffix.groupBy(*self.keys).agg(F.min(at).alias("_first"), F.max_by(self._version(), at).alias("last"))
        heads = ends.join(starts.select(*self.keys, "first"), self.keys)
        self.heads.write(heads.select(*self.keys, F.least("first", "_first").alias("first"), "last"), batch_id)

    def compact(self, spark: SparkSession) -> None:
        """Write the live versions and the whole log as one batch each. The
        cuts and heads of earlier batches have done their work then."""
        def heads(rows: DataFrame) -> DataFrame:
            found = rows.groupBy(*self.keys).agg(F.max_by(F.struct("first", "last"), "batch_id").alias("h"))
            return found.select(*self.keys, "h.first", "h.last")

        last = self.versions.last(spark)
        self.versions.compact(spark, lambda rows: self._live(rows, spark, last))
        self.heads.compact(spark, heads)
        self.log.compact(spark, lambda rows: scd2.change_log_merge(None, rows, self.keys, self.ts, self.lsn))
        self.cuts.compact(spark, lambda rows: rows.where(F.col("batch_id") >= last))


def _start_of(version: str) -> Column:
    return F.when(F.col(version).isNotNull(), F.struct(F.col(f"{version}.{START}").alias("ts"), F.col(f"{version}.start_lsn").alias("lsn")))
