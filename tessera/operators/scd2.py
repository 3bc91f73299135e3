"""Slowly changing dimension type 2 from a change feed (CDC-1..9, 13).

A change row carries the business key, the change time ``ts``, the log
position ``lsn`` (ties on ``ts`` break on it), an operation (``UPSERT``
for insert/update, ``DELETE``) and the tracked attributes. Per key and in
(ts, lsn) order:

* an upsert opens a version unless the key has an open version with the
  same tracked values (a no-op update merges into it);
* an opened version is closed at the start of the next kept change;
* a delete closes the open version and opens nothing; a delete with no
  open version is ignored.

``scd2_apply`` recomputes only the keys touched by a batch, from the
stored change log of those keys plus the new changes, so late or
out-of-order changes give the same history as in-order ones and
re-applying a batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.joins import attach_scalars
from tessera.operators.sequence import bucket_unit, neighbors

UPSERT = "UPSERT"
DELETE = "DELETE"

START, END, CURRENT = "effective_start_at", "effective_end_at", "is_current"


def _same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b):
        out = out & x.eqNullSafe(y)
    return out


def classify_changes(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str = "ts",
    lsn: str = "lsn",
    op: str = "op",
    unit: str | None = None,
) -> DataFrame:
    """Each distinct change with its effect on the history: ``OPEN`` (a new
    version), ``CLOSE`` (a delete ending the open version), ``NOOP`` (same
    values as the open version) or ``IGNORED`` (delete without an open
    version). Columns: keys, _ts, _lsn, _op, tracked, effect,
    cdc_operation."""
    ch = changes.select(*keys, F.col(ts).alias("_ts"), F.col(lsn).alias("_lsn"), F.col(op).alias("_op"), *tracked)
    # one shuffle by (key, time bucket) serves the dedup and both neighbour
    # windows; a hot key is spread over its buckets
    ch = ch.withColumn("_bk", F.date_trunc(unit or bucket_unit(ch, keys, "_ts"), F.col("_ts")))
    ch = ch.dropDuplicates([*keys, "_bk", "_ts", "_lsn"])
    seq = neighbors(ch, keys, ["_ts", "_lsn"], ["_op", *tracked], "_bk", "prev", prefix="_p")
    is_up = F.col("_op") == F.lit(UPSERT)
    prev_op = F.col("_p_op")
    after_gap = prev_op.isNull() | (prev_op == F.lit(DELETE))
    changed = ~_same([F.col(c) for c in tracked], [F.col("_p" + c) for c in tracked])
    effect = (
        F.when(is_up & (after_gap | changed), F.lit("OPEN"))
        .when(is_up, F.lit("NOOP"))
        .when(after_gap, F.lit("IGNORED"))
        .otherwise(F.lit("CLOSE"))
    )
    return seq.select(
        *keys, "_ts", "_lsn", "_op", *tracked, "_bk",
        effect.alias("effect"),
        F.when(after_gap, F.lit("INSERT")).otherwise(F.lit("UPDATE")).alias("cdc_operation"),
    )


def versions_from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str = "ts",
    lsn: str = "lsn",
    op: str = "op",
    unit: str | None = None,
) -> DataFrame:
    """Full SCD2 history of the keys present in ``changes``."""
    kept = classify_changes(changes, keys, tracked, ts, lsn, op, unit).where(F.col("effect").isin("OPEN", "CLOSE"))
    nxt = neighbors(kept, keys, ["_ts", "_lsn"], ["_ts", "_lsn", "_op"], "_bk", "next", prefix="_n")
    return nxt.where(F.col("_op") == F.lit(UPSERT)).select(
        *keys,
        *tracked,
        F.col("_ts").alias(START),
        F.col("_n_ts").alias(END),
        F.col("_n_ts").isNull().alias(CURRENT),
        "cdc_operation",
        F.col("_lsn").alias("start_lsn"),
        F.col("_n_lsn").alias("end_lsn"),
        F.col("_n_op").alias("closed_by"),
    )


def versions_to_changes(history: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Stored versions back into the change rows that produce them: each
    version is an upsert at its start; a version closed by a delete adds
    that delete."""
    ups = history.select(*keys, F.col(START).alias("ts"), F.col("start_lsn").alias("lsn"), F.lit(UPSERT).alias("op"), *tracked)
    nulls = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in tracked]
    dels = history.where(F.col("closed_by") == F.lit(DELETE)).select(
        *keys, F.col(END).alias("ts"), F.col("end_lsn").alias("lsn"), F.lit(DELETE).alias("op"), *nulls
    )
    return ups.unionByName(dels)


def change_log_merge(log: DataFrame | None, changes: DataFrame, keys: Sequence[str],
                     ts: str = "ts", lsn: str = "lsn") -> DataFrame:
    """Stored change log plus a batch, each change once (DED-3): the state
    from which any history is rebuilt exactly."""
    both = changes if log is None else log.unionByName(changes.select(*log.columns))
    return both.dropDuplicates([*keys, ts, lsn])


def scd2_apply(
    history: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    ts: str = "ts",
    lsn: str = "lsn",
    op: str = "op",
    log: DataFrame | None = None,
) -> DataFrame:
    """New full history after applying a batch of ``changes``. Keys not in
    the batch keep their versions untouched; touched keys are rebuilt.

    With ``log`` (the stored change log, ``change_log_merge``) the touched
    keys are rebuilt from every change ever received, so late and
    out-of-order batches give exactly the in-order history: a delete that
    found nothing open, or an update equal to its predecessor, can become
    significant when an older change arrives later. Without a log the
    touched keys are rebuilt from their stored versions, which is exact
    when changes arrive in order (and re-applying a batch changes nothing).
    """
    batch = changes.select(*keys, F.col(ts).alias("ts"), F.col(lsn).alias("lsn"), F.col(op).alias("op"), *tracked)
    if history is None and log is None:
        return versions_from_changes(batch, keys, tracked)
    touched = batch.select(*keys).distinct()
    if log is not None:
        past = log.select(*keys, F.col(ts).alias("ts"), F.col(lsn).alias("lsn"), F.col(op).alias("op"), *tracked)
        replay = past.join(touched, list(keys), "left_semi").unionByName(batch)
    else:
        replay = versions_to_changes(history.join(touched, list(keys), "left_semi"), keys, tracked).unionByName(batch)
    rebuilt = versions_from_changes(replay, keys, tracked)
    if history is None:
        return rebuilt
    untouched = history.join(touched, list(keys), "left_anti")
    return untouched.unionByName(rebuilt.select(*history.columns))


def current(history: DataFrame) -> DataFrame:
    """Current-state view (CDC-6)."""
    return history.where(F.col(CURRENT))


def scd2_violations(history: DataFrame, keys: Sequence[str], unit: str | None = None) -> DataFrame:
    """Integrity problems of a history (CDC-9), one row per finding:
    ``MULTIPLE_CURRENT`` (more than one open version), ``OVERLAP`` (next
    version starts before this one ends, or this one is open), ``GAP``
    (next version starts after this one ended without a delete)."""
    multi = (
        history.where(F.col(CURRENT))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(START).alias(START))
        .where(F.col("_n") > 1)
        .select(*keys, F.lit("MULTIPLE_CURRENT").alias("violation"), F.col(START))
    )
    h = history.select(*keys, START, END, "closed_by", "start_lsn")
    seq = neighbors(h, keys, [START, "start_lsn"], [START], F.date_trunc(unit or bucket_unit(h, keys, START), F.col(START)), "next", prefix="_n")
    nstart = F.col("_n" + START)
    overlap = nstart.isNotNull() & (F.col(END).isNull() | (nstart < F.col(END)))
    gap = nstart.isNotNull() & F.col(END).isNotNull() & (nstart > F.col(END)) & (F.coalesce(F.col("closed_by"), F.lit("")) != F.lit(DELETE))
    pairs = seq.select(
        *keys,
        F.when(overlap, F.lit("OVERLAP")).when(gap, F.lit("GAP")).alias("violation"),
        F.col(START),
    ).where(F.col("violation").isNotNull())
    return multi.unionByName(pairs)


def effective_defects(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    key: str,
    fact_ts: str,
    tracked: Sequence[str],
) -> DataFrame:
    """Facts whose attributes differ between the version effective at the
    fact time and the current version (a latest-value overwrite would be
    wrong for them, CDC-13). The effective version comes from the as-of
    join; the current version is unique per key, an equi join."""
    from tessera.operators.joins import effective_join

    eff_hist = history.select(key, START, END, *[F.col(c).alias("eff_" + c) for c in tracked])
    eff = effective_join(facts, eff_hist, fact_key, key, fact_ts, attrs=["eff_" + c for c in tracked])
    cur = current(history).select(F.col(key).alias("_ck"), *[F.col(c).alias("cur_" + c) for c in tracked])
    joined = eff.join(cur, F.col(fact_key) == F.col("_ck"), "left")
    differs = ~_same([F.col("eff_" + c) for c in tracked], [F.col("cur_" + c) for c in tracked])
    return joined.where(differs).drop("_ck")


def history_archive(history: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Append-only audit projection of the versions (CDC-2): business
    columns with valid_from / valid_to and the operation that opened them."""
    return history.select(
        *keys, *tracked, F.col(START).alias("valid_from"), F.col(END).alias("valid_to"), "cdc_operation"
    )


def changes_from_snapshots(snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                           snapshot_ts: str = "snapshot_ts") -> DataFrame:
    """Change rows from a series of full snapshots (CDC-8): each key present
    in a snapshot is an upsert at the snapshot time (unchanged values merge
    as no-ops); a key missing from the snapshot after one that had it is a
    delete at that time. The snapshot times form a small table (one row per
    snapshot), numbered and broadcast; the per-key window runs over that
    key's presence rows only."""
    times = snapshots.select(snapshot_ts).distinct()
    # numbering the snapshot times: one row per snapshot, not per record
    idx = times.select(snapshot_ts, F.row_number().over(Window.orderBy(snapshot_ts)).alias("_i"))
    last_i = idx.agg(F.max("_i").alias("_last"))
    present = snapshots.join(F.broadcast(idx), snapshot_ts)  # one row per snapshot taken
    ups = present.select(*keys, F.col(snapshot_ts).alias("ts"), F.col("_i").cast("long").alias("lsn"),
                         F.lit(UPSERT).alias("op"), *tracked)
    w = Window.partitionBy(*keys).orderBy("_i")
    gaps = attach_scalars(present.select(*keys, "_i", F.lead("_i").over(w).alias("_next")), last_i)
    gone = gaps.where(
        (F.col("_next").isNull() & (F.col("_i") < F.col("_last"))) | (F.col("_next") > F.col("_i") + 1)
    ).select(*keys, (F.col("_i") + 1).alias("_di"))
    nulls = [F.lit(None).cast(snapshots.schema[c].dataType).alias(c) for c in tracked]
    dels = gone.join(F.broadcast(idx.withColumnRenamed("_i", "_di")), "_di").select(
        *keys, F.col(snapshot_ts).alias("ts"), F.col("_di").cast("long").alias("lsn"), F.lit(DELETE).alias("op"), *nulls
    )
    return ups.unionByName(dels)


def scd2_from_snapshots(snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                        snapshot_ts: str = "snapshot_ts") -> DataFrame:
    """History of an entity captured as periodic full snapshots (CDC-8)."""
    return versions_from_changes(changes_from_snapshots(snapshots, keys, tracked, snapshot_ts), keys, tracked)
