"""Join operators: dimension lookups, star denormalization, anti joins,
scalar attachment and effective-date (SCD2) joins.

Broadcast policy: a side is broadcast only when its size is bounded -
by construction (fixed code tables, per-bucket offsets) or by a measured
row count (that of a written dimension). Everything else is left to the planner, where AQE
turns a shuffle join into a broadcast join at run time if the shuffled
side turns out small; beyond the threshold the sort-merge join stays, so
nothing grows into an unbounded broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import normalize_name
from tessera.operators.keys import UNKNOWN_ID
from tessera.operators.sequence import bucket_unit


@dataclass(frozen=True)
class Lookup:
    """How one fact column resolves to a dimension id (JN-2).

    ``fact_col`` is normalized (upper/trim) unless ``numeric``;
    ``parent`` names the id column of an already-resolved parent lookup
    that is part of the dimension key (model within make).
    """

    dim: DataFrame
    fact_col: str
    dim_key: str
    dim_id: str
    numeric: bool = False
    parent_id: str | None = None


def resolve_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """LEFT join each lookup and replace a missing match by the unknown
    member id 0 (``COALESCE(id, 0)``). The unknown member itself is kept out
    of the lookup side, so a real value named like it cannot double rows."""
    out = fact
    for lk in lookups:
        key_expr = F.col(lk.fact_col) if lk.numeric else normalize_name(lk.fact_col)
        dim = lk.dim.where(F.col(lk.dim_id) != UNKNOWN_ID).select(
            F.col(lk.dim_id).alias("_lk_id"),
            F.col(lk.dim_key).alias("_lk_key"),
            *([F.col(lk.parent_id).alias("_lk_parent")] if lk.parent_id else []),
        )
        cond = key_expr == F.col("_lk_key")
        if lk.parent_id:
            cond = cond & (F.col(lk.parent_id) == F.col("_lk_parent"))
        out = (
            out.join(dim, cond, "left")
            .withColumn(lk.dim_id, F.coalesce(F.col("_lk_id"), F.lit(UNKNOWN_ID)).cast("long"))
            .drop("_lk_id", "_lk_key", *(["_lk_parent"] if lk.parent_id else []))
        )
    return out


def denormalize(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Star denormalization (JN-3): for each (dim, id column, attribute
    columns) LEFT join on the surrogate id and append the attributes."""
    out = fact
    for dim, id_col, attrs in dims:
        side = dim.select(F.col(id_col).alias("_dn_id"), *[F.col(a) for a in attrs])
        out = out.join(side, F.col(id_col) == F.col("_dn_id"), "left").drop("_dn_id")
    return out


def enrich_current(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    current_col: str = "is_current",
    attrs: Sequence[str] | None = None,
) -> DataFrame:
    """LEFT join to the current rows of a versioned dimension only (JN-1):
    the ``is_current`` test belongs to the join condition, so facts without
    a current version keep NULL attributes instead of disappearing."""
    side = dim.where(F.col(current_col))
    if attrs is not None:
        side = side.select(F.col(dim_key).alias("_cur_key"), *attrs)
    else:
        side = side.withColumnRenamed(dim_key, "_cur_key")
    return fact.join(side, F.col(fact_key) == F.col("_cur_key"), "left").drop("_cur_key")


def fanout_keys(dim: DataFrame, key: str, current_col: str = "is_current") -> DataFrame:
    """Join values that match more than one current dimension row - each
    would multiply the facts joined on it (D4: enrichment on a name that
    is not the dimension's key)."""
    return (
        dim.where(F.col(current_col))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .where(F.col("current_rows") > 1)
    )


def orphans(df: DataFrame, ref: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows whose key is missing from ``ref`` (LEFT ANTI, JN-5). A NULL key
    never matches and is therefore reported as an orphan."""
    keys = ref.select(F.col(right_key).alias("_ref_key"))
    return df.join(keys, F.col(left_key) == F.col("_ref_key"), "left_anti")


def new_only(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet (JN-6)."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def attach_scalars(df: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Attach the columns of single-row summaries to every row of ``df``
    (JN-7) as scalar subqueries - what the source's scalar subqueries
    are - rather than a cross join: each summary is a global aggregate,
    evaluated once and read as a constant (more than one row is an error,
    as for any scalar subquery)."""
    out = df
    for s in one_row:
        packed = s.select(F.struct(*[F.col(c) for c in s.columns]).alias("_s")).scalar()
        out = out.select("*", *[packed[c].alias(c) for c in s.columns])
    return out


def effective_join(
    events: DataFrame,
    versions: DataFrame,
    event_key: str,
    version_key: str,
    event_ts: str,
    start: str = "effective_start_at",
    end: str = "effective_end_at",
    attrs: Sequence[str] | None = None,
    version_order: str | None = None,
    unit: str | None = None,
) -> DataFrame:
    """Effective-date (as-of) LEFT join (JN-9): each event gets the version
    of its key with ``start <= ts AND (ts < end OR end IS NULL)``.

    Written as an as-of merge rather than key equality plus a range
    condition, which would pair every event of a key with every version of
    it before filtering. Events and version starts are put in one
    sequence per (key, time bucket); the latest version started at or
    before each event is carried forward inside the bucket, and events
    with no version start earlier in their bucket take the last version
    of the key's previous buckets from a one-row-per-(key, bucket)
    summary. The buckets' unit comes from counts (``sequence.bucket_unit``), so
    a key with a third of all rows, on one day even, is spread over many.

    Returns the event columns plus ``attrs`` (default: every version column
    except the key) of the matching version, NULL when none matches. A
    well-formed history (``scd2.scd2_violations`` empty) has at most one
    match per event; among versions starting at the same instant the
    later one (``version_order`` ascending, default ``end``) wins.
    """
    attrs = list(attrs) if attrs is not None else [c for c in versions.columns if c != version_key]
    vcols = list(dict.fromkeys([*attrs, start, end]))
    tie = version_order or end
    e_struct = F.struct(*[F.col(c) for c in events.columns])
    v_struct = F.struct(*[F.col(c) for c in vcols])
    e_type = events.select(e_struct.alias("x")).schema["x"].dataType
    v_type = versions.select(v_struct.alias("x")).schema["x"].dataType
    tie_type = versions.schema[tie].dataType
    ev = events.select(
        F.col(event_key).alias("_k"), F.col(event_ts).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(tie_type).alias("_tie"), e_struct.alias("_e"), F.lit(None).cast(v_type).alias("_v"),
    )
    vs = versions.select(
        F.col(version_key).alias("_k"), F.col(start).alias("_t"), F.lit(0).alias("_kind"),
        F.col(tie).alias("_tie"), F.lit(None).cast(e_type).alias("_e"), v_struct.alias("_v"),
    )
    unit = unit or bucket_unit(ev.select("_k", "_t").unionByName(vs.select("_k", "_t")), ["_k"], "_t")
    u = ev.unionByName(vs).withColumn("_b", F.date_trunc(unit, F.col("_t")))
    # versions sort before events at the same instant (start is inclusive);
    # among equal starts the open / later-ending version comes last
    seq_order = [F.col("_t").asc(), F.col("_kind").asc(), F.col("_tie").asc_nulls_last()]
    w = Window.partitionBy("_k", "_b").orderBy(*seq_order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cand = u.withColumn("_cand", F.last("_v", ignorenulls=True).over(w)).where(F.col("_kind") == 1)
    order_key = F.struct(F.col("_t"), F.col("_tie").isNull(), F.col("_tie"))
    per_bucket = u.groupBy("_k", "_b").agg(F.max_by(F.col("_v"), F.when(F.col("_kind") == 0, order_key)).alias("_lastv"))
    carry = per_bucket.select(
        "_k", "_b",
        F.last("_lastv", ignorenulls=True).over(
            Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        ).alias("_carry"),
    )
    j = cand.join(carry, ["_k", "_b"], "left")
    eff = F.coalesce(F.col("_cand"), F.col("_carry"))
    live = eff.isNotNull() & (eff[end].isNull() | (F.col("_t") < eff[end]))
    return j.select(
        *[F.col("_e")[c].alias(c) for c in events.columns],
        *[F.when(live, eff[c]).alias(c) for c in attrs],
    )


def as_of(versions: DataFrame, instant, start: str = "effective_start_at", end: str = "effective_end_at") -> DataFrame:
    """Point-in-time read of a history (JN-10): versions valid at ``instant``."""
    t = instant if isinstance(instant, Column) else F.lit(instant).cast("timestamp_ntz")
    return versions.where((F.col(start) <= t) & (F.col(end).isNull() | (t < F.col(end))))
