"""Null-safe arithmetic rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = int | float


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite(value: Column | str) -> Column:
    """``value`` as double with NaN and the infinities turned into NULL.

    Spark sorts NaN above every number, so a NaN that reaches a threshold would land
    in the top band.
    """
    x = column(value).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def known(value: Column | str) -> Column:
    """``value`` as double with NaN as NULL; infinities keep their place at the ends."""
    x = column(value).cast("double")
    return F.when(~F.isnan(x), x)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation as an aggregate; NULL for flat or one-row groups.

    Built from mergeable moments, so a hot group is combined on the map side. Both
    inputs are masked to complete pairs first: the deviations would otherwise count
    rows the covariance skips.
    """
    a, b = finite(x), finite(y)
    left, right = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right))


def minmax_norm(value: Column | str, low: Number, high: Number) -> Column:
    """Position of ``value`` between two fixed limits, capped to [0, 1]; NULL stays NULL.

    Limits that coincide mean full risk for every known value.
    """
    x = column(value).cast("double")
    if high <= low:
        return F.when(x.isNotNull(), F.lit(1.0))
    scaled = (x - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)))


def weighted_index(
    terms: Mapping[str, Column], weights: Mapping[str, Number], scale: int = 100, digits: int | None = 3
) -> Column:
    """Weighted sum of normalised terms; a NULL term contributes nothing.

    ``digits`` rounds the 0-1 sum before scaling (three decimals give index steps of
    0.1); ``None`` keeps full precision.
    """
    parts = [F.coalesce(terms[name], F.lit(0.0)) * F.lit(float(w)) for name, w in weights.items()]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    if digits is not None:
        total = total.cast(f"decimal({digits + 3},{digits})")
    return total * F.lit(scale)


def gap(a: Column | str, b: Column | str, missing: str = "zero") -> Column:
    """``a - b``; a missing side counts as zero, or makes the gap NULL."""
    left, right = column(a), column(b)
    if missing == "zero":
        return F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0))
    if missing == "null":
        return left - right
    raise ValueError("missing must be 'zero' or 'null'")


def clip(value: Column | str, low: Number, high: Number) -> Column:
    x = column(value)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def complement(value: Column | str, whole: Number = 100.0) -> Column:
    return F.lit(float(whole)) - column(value)


def one_in_n(pct: Column | str) -> Column:
    """'1 in N': N for a positive percentage, at least 1, halves rounded to even."""
    x = column(pct).cast("double")
    n = F.bround(F.try_divide(F.lit(100.0), x)).cast("bigint")
    return F.when(x > 0, F.greatest(F.lit(1).cast("bigint"), n))

