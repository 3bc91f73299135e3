"""Facts with the attributes effective at their time, kept right when older
changes arrive late (JN-9, STR-7, SEM-4).

``EnrichedFacts`` joins new facts to the history as it is known and stores the
result. When a change batch rewrites part of a history, the versions that it
took away and those that it put there (``CdcStream.replaced``) are compared:
rows that are the same on both sides cancel out, and what is left are the
intervals in which a key's attributes have changed. The facts inside these
intervals are joined again, to the new versions of the intervals alone; all
others keep what they have. No version outside is read, and of the facts only
the partitions that the intervals touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import effective_join
from tessera.operators.scd2 import END, START
from tessera.streaming.history import KEY_BUCKETS, CdcStream
from tessera.tables import BatchTable, materialize, newest_generation


class EnrichedFacts:
    """Facts (unique ``fact_id``, ``fact_key``, ``fact_ts``) with ``attrs`` of the
    version of ``history`` effective at their time."""

    def __init__(self, root: str, history: CdcStream, fact_id: str, fact_key: str, fact_ts: str, attrs: Sequence[str],
                 unit: str = "month"):
        parts = ["fact_bucket", "since"]
        self.facts = BatchTable(f"{root}/facts", partition_by=parts)
        self.rows = BatchTable(f"{root}/enriched", partition_by=parts)
        self.history = history
        self.fact_id, self.fact_key, self.fact_ts = fact_id, fact_key, fact_ts
        self.attrs, self.unit = list(attrs), unit

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")

    def _since(self, instant: Column) -> Column:
        return F.date_trunc(self.unit, instant).cast("date")

    def _write(self, table: BatchTable, df: DataFrame, number: int) -> None:
        table.write(df.withColumns({"fact_bucket": self._bucket(self.fact_key), "since": self._since(F.col(self.fact_ts))}), number)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Every fact once, as last enriched."""
        rows = self.rows.read(spark, with_batch=True)
        return None if rows is None else newest_generation(rows, [self.fact_id]).drop("fact_bucket", "since")

    def add(self, facts: DataFrame, number: int) -> None:
        """Enrich and store new facts as step ``number``; steps of either kind
        are numbered together."""
        spark = facts.sparkSession
        if facts.isEmpty():
            return
        self._write(self.facts, facts, number)
        stored = spark.read.parquet(self.facts.path(number)).drop("fact_bucket", "since")
        known = self.history.history(spark)
        if known is None:
            types = {c: self.history.type_of(c) for c in self.attrs}
            joined = stored.withColumns({c: F.lit(None).cast(t) for c, t in types.items()})
        else:
            joined = effective_join(stored, known, self.fact_key, self.history.keys[0], self.fact_ts, attrs=self.attrs, version_order="start_lsn")
        self._write(self.rows, joined, number)

    def restate(self, spark: SparkSession, change_batch: int, number: int) -> None:
        """Enrich again the facts whose version batch ``change_batch`` of the
        history has changed, as step ``number``."""
        replaced, facts = self.history.replaced(spark, change_batch), self.facts.read(spark)
        if replaced is None or facts is None:
            return
        gone, put = replaced
        key = self.history.keys[0]
        spans = gone.select(key, START, END).unionByName(put.select(key, START, END))
        bounds = spans.groupBy(self._bucket(key).alias("b")).agg(
            F.min(self._since(F.col(START))).alias("lo"), F.max(self._since(F.coalesce(END, F.lit("9999-12-31").cast("timestamp_ntz")))).alias("hi"),
        ).collect()  # at most KEY_BUCKETS
        near = F.lit(False)
        for r in bounds:
            near = near | ((F.col("fact_bucket") == r.b) & F.col("since").between(F.lit(r.lo), F.lit(r.hi)))
        touched = spans.select(F.col(key).alias(self.fact_key)).distinct()
        some = facts.where(near).drop("fact_bucket", "since").join(touched, self.fact_key, "left_semi")
        # each side is part of a well-formed history: at most one match
        old = gone.select(key, START, END, "start_lsn", F.lit(True).alias("_gone"))
        new = put.select(key, START, END, "start_lsn", *self.attrs, F.lit(True).alias("_put"))
        in_old = effective_join(some, old, self.fact_key, key, self.fact_ts, attrs=["_gone"], version_order="start_lsn")
        in_new = effective_join(in_old, new, self.fact_key, key, self.fact_ts, attrs=[*self.attrs, "_put"], version_order="start_lsn")
        again = in_new.where("_gone IS NOT NULL OR _put IS NOT NULL").drop("_gone", "_put")
        self._write(self.rows, again, number)
