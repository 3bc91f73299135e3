"""Scalar column helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_name(c: ColumnOrName) -> Column:
    """Lookup form of a free-text name: upper case, outer blanks removed."""
    return F.upper(F.trim(_col(c)))


def business_code(c: ColumnOrName) -> Column:
    """Business code from a name: upper, trim, each run of characters other
    than A-Z / 0-9 becomes one underscore (codes may collide, see
    ``operators.keys.code_collisions``)."""
    return F.regexp_replace(normalize_name(c), "[^A-Z0-9]+", "_")


def non_blank(c: ColumnOrName) -> Column:
    """Value present and not only blanks."""
    col = _col(c)
    return col.isNotNull() & (F.trim(col) != F.lit(""))


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is 0 or NULL (NULLIF guard)."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def pct(part: ColumnOrName, total: ColumnOrName, scale: int = 2) -> Column:
    """Percentage of a total rounded half-up, NULL for a zero total."""
    return F.round(safe_divide(_col(part).cast("double") * F.lit(100.0), total), scale)


_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def micros_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Exact microseconds from ``start`` to ``end`` (time-zone free: the
    difference of two TIMESTAMP_NTZ values is a day-time interval whose
    fields are summed)."""
    iv = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    part = lambda f: F.extract(F.lit(f), iv)
    return (
        part("DAY").cast("long") * F.lit(86_400_000_000)
        + part("HOUR").cast("long") * F.lit(3_600_000_000)
        + part("MINUTE").cast("long") * F.lit(60_000_000)
        + (part("SECOND") * F.lit(1_000_000)).cast("long")
    )


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed minutes as a fraction."""
    return micros_between(start, end) / F.lit(60_000_000.0)


def boundaries_between(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of ``unit`` boundaries crossed going from ``start`` to ``end``.

    Warehouse DATEDIFF counts boundaries (00:59 -> 01:01 is one hour), while
    Spark's elapsed-time difference counts whole units; truncating both
    operands to the unit first gives the boundary count.
    """
    u = unit.lower()
    s, e = _col(start), _col(end)
    if u in _MICROS:
        t = u.upper()
        return (micros_between(F.date_trunc(t, s), F.date_trunc(t, e)) / F.lit(_MICROS[u])).cast("long")
    if u == "day":
        return F.datediff(F.to_date(e), F.to_date(s)).cast("long")
    if u == "week":
        weeks = F.datediff(F.to_date(F.date_trunc("WEEK", e)), F.to_date(F.date_trunc("WEEK", s)))
        return (weeks / F.lit(7)).cast("long")
    if u == "month":
        return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("long")
    if u == "quarter":
        return ((F.year(e) * 4 + F.quarter(e)) - (F.year(s) * 4 + F.quarter(s))).cast("long")
    if u == "year":
        return (F.year(e) - F.year(s)).cast("long")
    raise ValueError(f"unsupported unit {unit}")


def round_to_int(c: ColumnOrName) -> Column:
    """Numeric to INT the warehouse way: round half away from zero first
    (Spark's cast truncates)."""
    return F.round(_col(c).cast("double"), 0).cast("int")


def half_even(c: ColumnOrName, scale: int = 0) -> Column:
    """Banker's rounding, as Python's ``round``."""
    return F.bround(_col(c), scale)


def days_left_in_month(d: ColumnOrName) -> Column:
    """Days from ``d`` to the first day of the next month."""
    day = F.to_date(_col(d))
    return F.datediff(F.add_months(F.trunc(day, "MM"), 1), day)
