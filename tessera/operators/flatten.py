"""Flattening and typed extraction of semi-structured (variant) records.

The raw layer keeps each landed document as one ``VARIANT`` value. These
operators turn ``{"data": [[...], ...]}`` documents into one row per inner
array (PRJ-1), flatten a second nested level (PRJ-2) and extract typed
columns either by array position (PRJ-3) or by JSON path (PRJ-4).

All of them are narrow transformations (a ``Generate`` plus projections):
no shuffle, and the variant column is dropped as soon as the typed columns
exist so nothing downstream carries the document.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import round_to_int

#: (position, output column, type) - the type is one of the keys of
#: ``_EXTRACTORS``.
PositionSpec = Sequence[tuple[int, str, str]]


def flatten(
    df: DataFrame,
    variant_col: str = "json_data",
    path: str = "$.data",
    pos_col: str = "pos",
    value_col: str = "value",
    keep_source: bool = False,
    outer: bool = False,
) -> DataFrame:
    """One output row per element of the array at ``path`` (LATERAL FLATTEN).

    Keeps every other input column (file, row, load time lineage), adds the
    element index ``pos_col`` and the element itself ``value_col``.
    Documents without the array produce no rows unless ``outer``.
    """
    arr = F.try_variant_get(F.col(variant_col), path, "array<variant>")
    gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
    others = [F.col(c) for c in df.columns if keep_source or c != variant_col]
    return df.select(*others, gen.alias(pos_col, value_col))


def flatten_nested(
    df: DataFrame,
    outer_col: str,
    outer_path: str,
    inner_path: str,
    outer_alias: str = "outer_value",
    inner_alias: str = "inner_value",
) -> DataFrame:
    """Two chained flattens: every element of ``outer_path`` and, for each,
    every element of ``inner_path`` inside it (PRJ-2)."""
    first = df.select(
        *[F.col(c) for c in df.columns if c != outer_col],
        F.explode(F.try_variant_get(F.col(outer_col), outer_path, "array<variant>")).alias(outer_alias),
    )
    return first.select(
        "*",
        F.explode(F.try_variant_get(F.col(outer_alias), inner_path, "array<variant>")).alias(inner_alias),
    )


def _getter(strict: bool):
    return F.variant_get if strict else F.try_variant_get


def typed_value(value: Column, path: str, kind: str, strict: bool = True) -> Column:
    """Typed read of one path of a variant value.

    Integer kinds round half away from zero before narrowing (the warehouse
    rounds on a NUMBER->INT cast, Spark would truncate); in strict mode a
    value that cannot be cast raises, otherwise it becomes NULL.
    """
    get = _getter(strict)
    if kind in ("int", "integer"):
        return round_to_int(get(value, path, "double"))
    if kind in ("bigint", "long"):
        return F.round(get(value, path, "double"), 0).cast("long")
    if kind in ("double", "float"):
        return get(value, path, "double")
    if kind in ("string", "varchar"):
        return get(value, path, "string")
    if kind == "variant":
        return get(value, path, "variant")
    return get(value, path, kind)


def extract_positions(
    df: DataFrame,
    spec: PositionSpec,
    value_col: str = "value",
    keep: Iterable[str] = (),
    strict: bool = True,
) -> DataFrame:
    """Typed columns from positions of an array element (``value[8]::VARCHAR``).

    ``keep`` lists input columns to carry along (lineage, position, or the
    raw element for quarantine rows).
    """
    v = F.col(value_col)
    cols = [F.col(c) for c in keep]
    cols += [typed_value(v, f"$[{pos}]", kind, strict).alias(name) for pos, name, kind in spec]
    return df.select(*cols)


def extract_paths(
    df: DataFrame,
    value_col: str,
    spec: Sequence[tuple[str, str, str]],
    keep: Iterable[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Typed columns from named JSON paths (``value:"objectName"::STRING``);
    ``spec`` holds (json path, output column, type)."""
    v = F.col(value_col)
    cols = [F.col(c) for c in keep]
    cols += [typed_value(v, path, kind, strict).alias(name) for path, name, kind in spec]
    return df.select(*cols)


def cast_errors(df: DataFrame, spec: PositionSpec, value_col: str = "value") -> Column:
    """Boolean column: some position holds a value that the strict cast
    would reject (present, not JSON null, yet the lenient cast gives NULL)."""
    v = F.col(value_col)
    flags = []
    for pos, _name, kind in spec:
        path = f"$[{pos}]"
        raw = F.try_variant_get(v, path, "variant")
        present = raw.isNotNull() & ~F.is_variant_null(raw)
        flags.append(present & typed_value(v, path, kind, strict=False).isNull())
    out = F.lit(False)
    for f in flags:
        out = out | f
    return out
