"""Per-group linear trend forecast (FC-1).

Least squares of a yearly count on the year, per group, ``horizon``
steps past the last year; groups with fewer than ``min_points`` years get
no forecast, a group whose years do not vary gets slope 0, predictions are
rounded half to even and clamped at 0.

Counts and years are integers, so the fitted value is an exact rational:

    pred(x) = (Sy * D + N * (n * x - Sx)) / (n * D)
    D = n * Sxx - Sx^2,  N = n * Sxy - Sx * Sy     (D = 0 -> Sy / n)

The five sums are ordinary partial aggregates (one row per group leaves
each map task) and the rounding is done on the exact numerator and
denominator in DECIMAL(38,0), so a value that is exactly k + 0.5 rounds to
even instead of landing on either side through floating-point noise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_D = "decimal(38,0)"


def _half_even_ratio(p: Column, q: Column) -> Column:
    """round_half_even(p / q) for q > 0, p > 0 (exact)."""
    f = F.floor(p / q)  # refined below: the decimal quotient may be rounded
    f = F.when((f * q) > p, f - 1).otherwise(f)
    f = F.when(((f + 1) * q) <= p, f + 1).otherwise(f).cast(_D)
    r2 = (p - f * q) * 2
    up = (r2 > q) | ((r2 == q) & (F.pmod(f, F.lit(2).cast(_D)) == 1))
    return (f + F.when(up, 1).otherwise(0)).cast("long")


def linear_forecast(
    series: DataFrame,
    group: Sequence[str],
    x: str,
    y: str,
    horizon: int = 3,
    min_points: int = 3,
    out_x: str | None = None,
    out_y: str = "forecast",
) -> DataFrame:
    out_x = out_x or x
    xd, yd = F.col(x).cast(_D), F.col(y).cast(_D)
    fit = (
        series.groupBy(*group)
        .agg(
            F.count(F.lit(1)).cast(_D).alias("_n"),
            F.max(x).alias("_last_x"),
            F.sum(xd).cast(_D).alias("_sx"),
            F.sum(yd).cast(_D).alias("_sy"),
            F.sum(xd * xd).cast(_D).alias("_sxx"),
            F.sum(xd * yd).cast(_D).alias("_sxy"),
        )
        .where(F.col("_n") >= min_points)
    )
    n, sx, sy, sxx, sxy = (F.col(c) for c in ["_n", "_sx", "_sy", "_sxx", "_sxy"])
    fit = fit.withColumn("_den", (n * sxx - sx * sx).cast(_D)).withColumn("_num", (n * sxy - sx * sy).cast(_D))
    steps = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_step"))
    target = (F.col("_last_x") + F.col("_step")).cast("int")
    flat = F.col("_den") == 0
    p = F.when(flat, sy).otherwise(sy * F.col("_den") + F.col("_num") * (n * target.cast(_D) - sx)).cast(_D)
    q = F.when(flat, n).otherwise(n * F.col("_den")).cast(_D)
    pred = F.when(p <= 0, F.lit(0).cast("long")).otherwise(_half_even_ratio(p, q))
    return steps.select(*group, target.alias(out_x), pred.alias(out_y))
