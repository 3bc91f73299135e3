"""Surrogate keys, business codes and dimension builders (KEY-1..6).

``dense_ids`` numbers rows 1..N by a global order without moving all rows
into one task: rows are split into key ranges and written once with their
place, and the running offsets of the range counts are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import business_code, non_blank, normalize_name
from tessera.tables import materialize

UNKNOWN_ID = 0
UNKNOWN_CODE = "UNK"
UNKNOWN_NAME = "UNKNOWN"


def dense_ids(
    df: DataFrame, order: Sequence[Column | str], id_col: str, start: int = 1, num_partitions: int | None = None
) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following ``order`` (ascending,
    NULLS LAST) across the whole DataFrame: ``ROW_NUMBER() OVER (ORDER BY
    ...)`` without the single-task window (KEY-1).

    Rows are range-partitioned and sorted once, and written with their
    partition and their position in it. The counts of the partitions and the
    ids are both taken from that copy, so they belong together whatever
    bounds the range partitioner drew, and a re-run task reads the same
    rows. Offsets are running sums of one row per partition, joined back as
    a broadcast of that size. ``num_partitions`` fixes their number; without
    it adaptive execution sizes them.

    ``order`` should be a total order (unique keys): equal keys share a
    partition, so one key repeated across a third of the rows would make its
    partition that large.
    """
    keys = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    # the id of a row is its partition, shifted by 33 bits, and its position
    placed = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_mid"), 33))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid")
    )
    fixed = materialize(placed)
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        fixed.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(id_col, (F.col("_offset") + F.col("_local") + F.lit(start)).cast("long"))
        .drop("_part", "_local", "_offset")
    )


def build_dim(
    df: DataFrame,
    src_col: str,
    prefix: str,
    unknown: bool = True,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Dimension from the distinct normalized names of ``src_col``:
    ``<prefix>_id`` ordered by name, ``<prefix>_code`` = business code,
    ``<prefix>_name``; plus the unknown member (0, UNK, UNKNOWN) (KEY-3).

    By default ids are renumbered on every build, as the source does
    (D11); with ``existing`` (the previous dimension) stored names keep
    their ids and only new names are numbered, after the highest id."""
    id_c, code_c, name_c = f"{prefix}_id", f"{prefix}_code", f"{prefix}_name"
    names = df.where(non_blank(src_col)).select(normalize_name(src_col).alias(name_c)).distinct()
    if existing is not None:
        kept = existing.where(F.col(id_c) != UNKNOWN_ID).select(id_c, code_c, name_c)
        new = names.join(kept.select(name_c), name_c, "left_anti")
        top = kept.agg(F.coalesce(F.max(id_c), F.lit(0)).alias("_top")).first()["_top"]  # one row
        added = dense_ids(new, [F.col(name_c)], id_c, start=int(top) + 1)
        dim = kept.unionByName(added.select(F.col(id_c), business_code(name_c).alias(code_c), F.col(name_c)))
        if unknown:
            dim = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (name_c, "string", UNKNOWN_NAME)]).unionByName(dim)
        return dim
    numbered = dense_ids(names, [F.col(name_c)], id_c)
    dim = numbered.select(F.col(id_c), business_code(name_c).alias(code_c), F.col(name_c))
    if unknown:
        dim = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (name_c, "string", UNKNOWN_NAME)]).unionByName(dim)
    return dim


def build_child_dim(
    df: DataFrame,
    src_col: str,
    parent_src_col: str,
    parent_dim: DataFrame,
    parent_prefix: str,
    prefix: str,
) -> DataFrame:
    """Child dimension numbered within its parent (model within make, KEY-4):
    distinct (parent id, normalized child name) for rows whose parent name
    resolves (inner join), ids ordered by (parent id, name)."""
    id_c, code_c, name_c = f"{prefix}_id", f"{prefix}_code", f"{prefix}_name"
    p_id, p_name = f"{parent_prefix}_id", f"{parent_prefix}_name"
    parents = parent_dim.where(F.col(p_id) != UNKNOWN_ID).select(p_id, p_name)
    pairs = (
        df.where(non_blank(src_col))
        .select(normalize_name(parent_src_col).alias("_pname"), normalize_name(src_col).alias(name_c))
        .join(parents, F.col("_pname") == F.col(p_name), "inner")
        .select(p_id, name_c)
        .distinct()
    )
    numbered = dense_ids(pairs, [F.col(p_id), F.col(name_c)], id_c)
    dim = numbered.select(F.col(id_c), F.col(p_id), business_code(name_c).alias(code_c), F.col(name_c))
    unk = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (p_id, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (name_c, "string", UNKNOWN_NAME)])
    return unk.unionByName(dim)


def build_numeric_dim(df: DataFrame, src_col: str, prefix: str, value_type: str = "int") -> DataFrame:
    """Dimension over a numeric attribute (model year, KEY-5): id ordered by
    value, code = value as text, unknown member has a NULL value."""
    id_c, code_c = f"{prefix}_id", f"{prefix}_code"
    values = df.where(F.col(src_col).isNotNull()).select(F.col(src_col).cast(value_type).alias(src_col)).distinct()
    numbered = dense_ids(values, [F.col(src_col)], id_c)
    dim = numbered.select(F.col(id_c), F.col(src_col).cast("string").alias(code_c), F.col(src_col))
    unk = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (src_col, value_type, None)])
    return unk.unionByName(dim)


def build_pair_dim(df: DataFrame, code_src: str, name_src: str, prefix: str) -> DataFrame:
    """Lookup dimension of distinct (code, name) pairs, ids ordered by
    (name, code) with NULLs last (county lookup of the gold layer, KEY-6)."""
    id_c, code_c, name_c = f"{prefix}_id", f"{prefix}_code", f"{prefix}_name"
    pairs = df.select(F.col(code_src).alias(code_c), F.col(name_src).alias(name_c)).distinct()
    numbered = dense_ids(pairs, [F.col(name_c), F.col(code_c)], id_c)
    return numbered.select(id_c, code_c, name_c)


def code_collisions(dim: DataFrame, prefix: str) -> DataFrame:
    """Business codes shared by more than one name (``A-B`` and ``A B`` both
    give ``A_B``), with the colliding names."""
    code_c, name_c = f"{prefix}_code", f"{prefix}_name"
    return (
        dim.groupBy(code_c)
        .agg(F.count(F.lit(1)).alias("names"), F.sort_array(F.collect_set(name_c)).alias("colliding_names"))
        .where(F.col("names") > 1)
    )


def _unknown_row(df: DataFrame, fields: Sequence[tuple[str, str, object]]) -> DataFrame:
    spark = df.sparkSession
    return spark.range(1).select(*[F.lit(v).cast(t).alias(n) for n, t, v in fields])


def dimension_members(
    df: DataFrame,
    specs: Sequence[tuple[str, str]],
    child: tuple[str, str, str] | None = None,
    numeric: tuple[str, str] | None = None,
) -> DataFrame:
    """Distinct (``_dim``, ``_k1``, ``_k2``) of several dimensions in one scan;
    see ``build_name_dims``."""
    parts = [
        F.struct(F.lit(prefix).alias("_dim"), normalize_name(src).alias("_k1"), F.lit("").alias("_k2"), non_blank(src).alias("_ok"))
        for prefix, src in specs
    ]
    if child is not None:
        c_prefix, c_src, p_prefix = child
        p_src = dict(specs)[p_prefix]
        parts.append(F.struct(
            F.lit(c_prefix).alias("_dim"), normalize_name(p_src).alias("_k1"), normalize_name(c_src).alias("_k2"),
            (non_blank(p_src) & non_blank(c_src)).alias("_ok"),
        ))
    if numeric is not None:
        n_prefix, n_src = numeric
        shifted = F.col(n_src).cast("long") + F.lit(_INT_SHIFT)
        parts.append(F.struct(
            F.lit(n_prefix).alias("_dim"), F.lpad(shifted.cast("string"), 10, "0").alias("_k1"), F.lit("").alias("_k2"),
            F.col(n_src).isNotNull().alias("_ok"),
        ))
    return df.select(F.explode(F.array(*parts)).alias("_p")).select("_p.*").where(F.col("_ok")).drop("_ok").distinct()


def with_parent_ids(local: DataFrame, child: tuple[str, str, str] | None) -> DataFrame:
    """``_pid``, the id of a child member's parent; resolved before the
    members are written, so reading a dimension later is a filter, never a
    join."""
    if child is None:
        return local.withColumn("_pid", F.lit(None).cast("long"))
    c_prefix, _, p_prefix = child
    parents = local.where(F.col("_dim") == p_prefix).select(F.col("_k1").alias("_pk"), F.col("_id").alias("_pid"))
    return local.join(parents, (F.col("_dim") == c_prefix) & (F.col("_k1") == F.col("_pk")), "left").drop("_pk")


def dimensions_of(
    local: DataFrame,
    df: DataFrame,
    specs: Sequence[tuple[str, str]],
    child: tuple[str, str, str] | None = None,
    numeric: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The dimensions, unknown members included, from numbered members
    (``_dim``, ``_k1``, ``_k2``, ``_id``, ``_pid``)."""
    out = {}
    for prefix, _ in specs:
        id_c, code_c, name_c = f"{prefix}_id", f"{prefix}_code", f"{prefix}_name"
        dim = local.where(F.col("_dim") == prefix).select(
            F.col("_id").cast("long").alias(id_c), business_code("_k1").alias(code_c), F.col("_k1").alias(name_c)
        )
        unk = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (name_c, "string", UNKNOWN_NAME)])
        out[prefix] = unk.unionByName(dim)
    if child is not None:
        c_prefix, _, p_prefix = child
        id_c, code_c, name_c, pid_c = f"{c_prefix}_id", f"{c_prefix}_code", f"{c_prefix}_name", f"{p_prefix}_id"
        rows_ = local.where(F.col("_dim") == c_prefix)
        dim = rows_.select(
            F.col("_id").cast("long").alias(id_c), F.col("_pid").cast("long").alias(pid_c),
            business_code("_k2").alias(code_c), F.col("_k2").alias(name_c),
        )
        unk = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (pid_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (name_c, "string", UNKNOWN_NAME)])
        out[c_prefix] = unk.unionByName(dim)
    if numeric is not None:
        n_prefix, n_src = numeric
        id_c, code_c = f"{n_prefix}_id", f"{n_prefix}_code"
        value = (F.col("_k1").cast("long") - F.lit(_INT_SHIFT)).cast(df.schema[n_src].dataType)
        dim = local.where(F.col("_dim") == n_prefix).select(
            F.col("_id").cast("long").alias(id_c), value.cast("string").alias(code_c), value.alias(n_src)
        )
        unk = _unknown_row(df, [(id_c, "long", UNKNOWN_ID), (code_c, "string", UNKNOWN_CODE), (n_src, df.schema[n_src].dataType.simpleString(), None)])
        out[n_prefix] = unk.unionByName(dim)
    return out


def build_name_dims(
    df: DataFrame,
    specs: Sequence[tuple[str, str]],
    materialize_fn=None,
    child: tuple[str, str, str] | None = None,
    numeric: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Several dimensions in one pass: one scan emits (dimension, key,
    sub-key) triples, one distinct, one numbering over the triples; each
    dimension's ids then start at 1 by subtracting its first id (one row
    per dimension, a bounded broadcast). Same result as ``build_dim`` per
    ``(prefix, source column)`` in ``specs``, and optionally

    * ``child = (prefix, source column, parent prefix)``: ``build_child_dim``
      - ids ordered by (parent name, name), which is the order of (parent
      id, name) because parent ids follow parent names;
    * ``numeric = (prefix, source column)``: ``build_numeric_dim`` for an
      integer column, carried as an order-preserving fixed-width text.
    """
    triples = dimension_members(df, specs, child, numeric)
    numbered = dense_ids(triples, ["_dim", "_k1", "_k2"], "_gid")
    first = numbered.groupBy("_dim").agg(F.min("_gid").alias("_first"))
    local = numbered.join(F.broadcast(first), "_dim").select(
        "_dim", "_k1", "_k2", (F.col("_gid") - F.col("_first") + 1).alias("_id")
    )
    local = with_parent_ids(local, child)
    if materialize_fn is not None:
        local = materialize_fn(local)
    return dimensions_of(local, df, specs, child, numeric)


#: shift that maps any 32-bit integer to a non-negative value whose
#: zero-padded 10-digit text sorts in numeric order
_INT_SHIFT = 2**31
