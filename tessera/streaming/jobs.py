"""Structured Streaming jobs: file-arrival ingestion into the raw layer,
incremental latest-wins cleansed layer, gold refresh and DQ in the same
micro-batch, CDC micro-batches into SCD2 history, and new-issue alerts.

Every job is a ``foreachBatch`` sink whose outputs are all written under the
micro-batch number, so a batch that is repeated after a failure replaces
what its first attempt left and runs all of its steps; the checkpoint of the
streaming query records which files were consumed (no staging table to
truncate). ``trigger(availableNow=True)`` runs everything that has landed
and stops; a ``processingTime`` trigger gives the scheduled cadence.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.dedup import latest_per_key
from tessera.operators.flatten import PositionSpec, extract_positions, flatten
from tessera.operators.filters import reject_null_keys
from tessera.streaming.history import CdcStream  # noqa: F401 - part of the jobs' interface
from tessera.session import size_listings
from tessera.tables import BatchTable


def json_document_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                         as_of=None, purge: bool = False) -> DataFrame:
    """New landed JSON documents (one per file) as a raw-layer stream with
    file lineage (SRC-2). ``purge`` makes the file source delete landed
    files after their batch is committed (the load-and-purge of the
    source's ingestion; Spark does it in the background of later
    batches)."""
    size_listings(spark)
    r = (
        spark.readStream.format("json")
        .option("singleVariantColumn", "json_data")
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true")
    )
    if purge:
        r = r.option("cleanSource", "delete")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.load(path)
    load_ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return src.select(
        "json_data",
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(1).cast("long").alias("source_file_row"),
        load_ts.alias("load_timestamp"),
    )


def run(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


class RegistrationStream:
    """File arrival -> raw -> flatten -> cleansed (DED-2) -> gold refresh and
    DQ callbacks, all inside one micro-batch (STR-1..4).

    A batch adds its documents, their flattened rows and the latest row of
    each of its keys; the cleansed layer is the latest row per key over the
    batches, resolved when it is read, and ``compact`` keeps that short.
    """

    def __init__(self, root: str, spec: PositionSpec, key: str = "vin", order=None,
                 after_commit: Sequence[Callable[[RegistrationStream, int], None]] = ()):
        self.raw = BatchTable(f"{root}/raw")
        self.flat = BatchTable(f"{root}/flat")
        self.latest = BatchTable(f"{root}/silver")
        self.spec = spec
        self.key = key
        self.order = order or [F.col("source_file").desc_nulls_last(), F.col("pos").desc_nulls_last()]
        self.after_commit = list(after_commit)

    def clean(self, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        """The cleansed layer after batch ``upto``."""
        rows = self.latest.read(spark, upto)
        return None if rows is None else latest_per_key(rows, [self.key], self.order)

    def schema(self, spark: SparkSession, batch_id: int):
        return spark.read.parquet(self.latest.path(batch_id)).schema

    def changes(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What batch ``batch_id`` changed in the cleansed layer: the new
        latest row of a key with ``sign`` 1 and the one that it replaces with
        -1. Keys whose latest row stays are left out; of the older batches
        only the rows of the batch's keys meet in the one shuffle."""
        new = spark.read.parquet(self.latest.path(batch_id))
        before = self.latest.read(spark, batch_id - 1)
        if before is None:
            return new.withColumn("sign", F.lit(1))
        old = before.join(new.select(self.key), self.key, "left_semi").withColumn("_new", F.lit(0))
        both = old.unionByName(new.withColumn("_new", F.lit(1)))
        by_key = Window.partitionBy(self.key)
        rank = F.row_number().over(by_key.orderBy(*self.order, F.col("_new").asc()))
        # the second row of a key matters only as the best of the older ones
        older = F.row_number().over(by_key.orderBy(F.col("_new").asc(), *self.order))
        ranked = both.select("*", rank.alias("_rank"), older.alias("_older")).withColumn("_won", F.max(F.when(F.col("_rank") == 1, F.col("_new"))).over(by_key))
        kept = ranked.where("_won = 1 AND (_rank = 1 OR (_new = 0 AND _older = 1))")
        return kept.withColumn("sign", F.when(F.col("_new") == 1, 1).otherwise(-1)).drop("_new", "_rank", "_older", "_won")

    def compact(self, spark: SparkSession) -> None:
        self.latest.compact(spark, lambda rows: latest_per_key(rows, [self.key], self.order))

    def handle(self, raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        if raw.isEmpty():
            return  # no file landed: no work (the has-data guard)
        self.raw.write(raw, batch_id)
        landed = spark.read.parquet(self.raw.path(batch_id))
        flat = extract_positions(flatten(landed, "json_data", "$.data"), self.spec, keep=["source_file", "load_timestamp", "pos"])
        self.flat.write(flat, batch_id)  # parsed once: the cleansed layer and the checks read this
        rows = spark.read.parquet(self.flat.path(batch_id))
        self.latest.write(latest_per_key(reject_null_keys(rows, [self.key]), [self.key], self.order), batch_id)
        for cb in self.after_commit:
            cb(self, batch_id)


class IssueAlerts:
    """Counts of new error rows and new duplicate keys per micro-batch of
    their feeds (``issue_stream``), and an alert row when there are any
    (DQ-16); sending is left to the reader of the alert table."""

    def __init__(self, alert_path: str, as_of=None):
        self.alerts = BatchTable(alert_path)
        self.as_of = as_of

    def handle(self, issues: DataFrame, batch_id: int) -> None:
        count = lambda feed: F.coalesce(F.sum((F.col("feed") == feed).cast("long")), F.lit(0))
        counts = issues.agg(count("error").alias("new_errors"), count("duplicate").alias("new_duplicates"))
        ts = (F.current_timestamp() if self.as_of is None else F.lit(self.as_of)).cast("timestamp_ntz")
        alert = counts.where("new_errors + new_duplicates > 0").select(
            ts.alias("alerted_at"), "new_errors", "new_duplicates",
            F.concat(
                F.lit("New error rows detected: "), F.col("new_errors").cast("string"),
                F.lit(", new duplicate keys: "), F.col("new_duplicates").cast("string"),
            ).alias("message"),
        )
        self.alerts.write(alert, batch_id)


def dedup_cdc_stream(changes: DataFrame, keys: Sequence[str], ts: str, lsn: str, delay: str = "1 hour") -> DataFrame:
    """Streaming CDC landing dedup on (key, ts, lsn) whose state is bounded
    by a watermark on the change time (STR-7 / DED-3): a redelivery later
    than ``delay`` behind the newest change is not remembered - the
    change-log merge downstream drops it anyway."""
    wm = _event_time(changes, ts)
    return changes.withColumn("_event_time", wm).withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(
        [*keys, ts, lsn]
    ).drop("_event_time")


def trend_stream(df: DataFrame, ts: str, dims: Sequence[str], every: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Streaming form of the hourly count (AGG-9): tumbling event-time
    windows with a watermark so finished hours are emitted and their state
    dropped."""
    return (
        df.withColumn("_event_time", _event_time(df, ts))
        .withWatermark("_event_time", delay)
        .groupBy(F.window(F.col("_event_time"), every).alias("w"), *dims)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), *dims, "n")
    )


def _event_time(df: DataFrame, ts: str):
    """Watermarks need a TIMESTAMP column; wall-clock TIMESTAMP_NTZ values
    are read in the session zone (a fixed shift that keeps their order)."""
    return F.col(ts).cast("timestamp")


def issue_stream(spark: SparkSession, error_path: str, error_schema, duplicate_path: str, duplicate_schema,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """New rows of the quarantine and the duplicate tables as one stream of
    their feed names (STR-5)."""
    def rows(path: str, schema, feed: str) -> DataFrame:
        r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path).select(F.lit(feed).alias("feed"))

    return rows(error_path, error_schema, "error").unionByName(rows(duplicate_path, duplicate_schema, "duplicate"))


def gold_refresh(root: str, as_of=None) -> Callable[[RegistrationStream, int], None]:
    """``after_commit`` callback (STR-3): after the cleansed layer of a
    micro-batch is written, refresh the gold tables from it as the batch's
    snapshots - detail fact, county lookup, market metrics. The cleansed
    rows are resolved once; the lookup and the metrics read the detail."""
    from tessera.plans import medallion as M
    from tessera.tables import refresh

    def cb(job: RegistrationStream, batch_id: int) -> None:
        spark = SparkSession.getActiveSession()
        ts = as_of if as_of is not None else F.current_timestamp()
        path = refresh(M.fact_registrations(job.clean(spark, batch_id), ts), f"{root}/gold/fact_registrations", version=batch_id)
        detail = spark.read.parquet(path)
        refresh(M.dim_county_gold(detail), f"{root}/gold/dim_county_gold", version=batch_id)
        refresh(M.fact_market_metrics(detail, ts), f"{root}/gold/fact_market_metrics", version=batch_id)

    return cb


def dq_after_gold(root: str, as_of, manufacturers: DataFrame | None = None, gold_tables=None) -> Callable[[RegistrationStream, int], None]:
    """``after_commit`` callback (STR-4, run after ``gold_refresh`` so the
    checks see the refreshed gold, D22): the full detection run over the
    layers as they stand after the batch; only new content is added. With
    ``gold_tables`` (``streaming.gold.IncrementalGold``) gold is theirs, and
    of the cleansed rows only those that the batch has replaced are checked."""
    from tessera.plans.dq_run import detect_errors

    def cb(job: RegistrationStream, batch_id: int) -> None:
        spark = SparkSession.getActiveSession()
        changed = None
        if gold_tables is not None:
            clean, gold = gold_tables.detail(job, spark, batch_id), gold_tables.metrics(spark, batch_id)
            changed = spark.read.parquet(gold_tables.changes.path(batch_id)).where("sign > 0")
        else:
            clean = spark.read.parquet(f"{root}/gold/fact_registrations/snap={batch_id}")
            gold = spark.read.parquet(f"{root}/gold/fact_market_metrics/snap={batch_id}")
        detect_errors(
            job.raw.read(spark, batch_id), job.flat.read(spark, batch_id), spark.read.parquet(job.flat.path(batch_id)), clean, gold,
            f"{root}/dq", as_of, batch_id, manufacturers, changed=changed,
        )

    return cb
