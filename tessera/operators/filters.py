"""Row filters and projections used between layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose (already cast) key columns are NULL (PRJ-5). Testing
    the cast value treats a JSON ``null`` and a missing position alike."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def stamp(df: DataFrame, as_of, col: str = "load_timestamp") -> DataFrame:
    """Constant load timestamp (PRJ-6). ``as_of`` is passed in, never read
    from the clock inside the operator, so reruns are reproducible."""
    value = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.withColumn(col, value)


def tagged_rows(
    df: DataFrame,
    tags: Mapping[str, str],
    mapping: Mapping[str, Column | str | None],
    schema: Sequence[tuple[str, str]],
) -> DataFrame:
    """Project ``df`` onto a fixed schema with constant tag columns (PRJ-9).

    ``schema`` is the output (name, type) list; a name found in ``tags``
    becomes a literal, one found in ``mapping`` takes that column or
    expression (``None`` = typed NULL), anything else is taken by name.
    """
    cols = []
    for name, typ in schema:
        if name in tags:
            cols.append(F.lit(tags[name]).cast(typ).alias(name))
        elif name in mapping:
            src = mapping[name]
            expr = F.lit(None) if src is None else (F.col(src) if isinstance(src, str) else src)
            cols.append(expr.cast(typ).alias(name))
        else:
            cols.append(F.col(name).cast(typ).alias(name))
    return df.select(*cols)


def publish(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Governed projection: only the listed columns leave (SNK-7)."""
    return df.select(*cols)
