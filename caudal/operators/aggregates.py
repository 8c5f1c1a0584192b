"""Aggregations. All combine on the map side, so a hot group shuffles as partial rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.bands import signed_band, trend_label
from caudal.functions.numeric import Number, column, safe_corr


def exact(name: str) -> Column:
    """A measure as a decimal; what is no finite number is unknown."""
    return F.col(name).try_cast("decimal(24,6)")


def monthly_rollup(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], avgs: Mapping[str, str], digits: int | None = 2
) -> DataFrame:
    """Daily rows to one row per key. ``sums``/``avgs`` map output to input columns.

    Summed measures count as zero where unknown, also in their averages. Measures are
    added up as decimals, so neither totals nor the flags set by them depend on row order.
    """
    filled = df.na.fill(0.0, subset=sorted(set(sums.values())))
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    aggs = [rounded(F.sum(exact(src))).cast("double").alias(out) for out, src in sums.items()]
    aggs += [rounded(F.avg(exact(src))).cast("double").alias(out) for out, src in avgs.items()]
    return filled.groupBy(*keys).agg(*aggs)


def annual_rollup(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    monthly_means: Mapping[str, str],
    avgs: Mapping[str, str],
    flags: Mapping[str, str],
    flag_rates: Mapping[str, str],
    months: int = 12,
) -> DataFrame:
    """Monthly rows to one row per key: totals, totals over 12, means, flag counts and rates.

    Measures are averaged as decimals, so the result does not depend on row order.
    Rates divide by 12 whatever the number of rows; with several provinces per country
    they can exceed 1.
    """
    per_year = F.lit(months).cast("decimal(4,0)")
    aggs = [F.sum(exact(src)).alias(out) for out, src in sums.items()]
    aggs += [(F.sum(exact(src)) / per_year).alias(out) for out, src in monthly_means.items()]
    aggs += [F.avg(exact(src)).alias(out) for out, src in avgs.items()]
    aggs += [F.count_if(F.col(src)).alias(out) for out, src in flags.items()]
    aggs += [(F.count_if(F.col(src)).cast("decimal(18,0)") / per_year).alias(out) for out, src in flag_rates.items()]
    return df.groupBy(*keys).agg(*aggs)


def share_of_levels(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    level_col: str,
    levels: Sequence[str],
    agg: str = "sum",
    out: str | None = None,
) -> DataFrame:
    """Coverage of the selected levels per key: their sum, or the largest one."""
    if agg not in ("sum", "max"):
        raise ValueError("agg must be 'sum' or 'max'")
    picked = df.where(F.col(level_col).isin(list(levels)) & F.col(value).isNotNull())
    return picked.groupBy(*keys).agg(getattr(F, agg)(value).alias(out or value))


def conditional_sum(df: DataFrame, keys: Sequence[str], value: str, sides: Mapping[str, Column], missing: Number | None = None) -> DataFrame:
    """Several filtered sums of one column in a single scan.

    With ``missing`` a row outside a side adds that value, so a side without rows is
    not NULL.
    """
    terms = []
    for out, condition in sides.items():
        picked = F.when(condition, F.col(value))
        terms.append(F.sum(picked if missing is None else F.coalesce(picked, F.lit(missing))).alias(out))
    return df.groupBy(*keys).agg(*terms)


def weighted_population(df: DataFrame, keys: Sequence[str], population: str, pct: str, out: str) -> DataFrame:
    """People affected: population times percentage."""
    return df.groupBy(*keys).agg(F.sum(F.col(population) * F.col(pct) / 100).alias(out))


def pivot_values(
    df: DataFrame, keys: Sequence[str], name_col: str, values: Mapping[str, str] | Sequence[str], value_col: str,
    agg: str = "max", fill: Number | None = None,
) -> DataFrame:
    """Rows to columns for a declared value list (no extra job to discover it).

    ``values`` may map stored names to output names. ``max`` makes repeated keys
    independent of row order.
    """
    names = dict(values) if isinstance(values, Mapping) else {v: str(v) for v in values}
    wide = df.groupBy(*keys).pivot(name_col, list(names)).agg(getattr(F, agg)(value_col))
    wide = wide.withColumnsRenamed({str(k): v for k, v in names.items()})
    return wide if fill is None else wide.na.fill(fill, subset=list(names.values()))


def rollup_total(df: DataFrame, key: str, aggs: Mapping[str, Column], total_label: str = "Regional") -> DataFrame:
    """One row per key and a grand total over the raw rows, in one pass."""
    rolled = df.rollup(key).agg(F.grouping(key).alias("_total"), *[c.alias(n) for n, c in aggs.items()])
    label = F.when(F.col("_total") == 1, F.lit(total_label)).otherwise(F.col(key))
    return rolled.select(label.alias(key), *aggs)


def distribution(df: DataFrame, col: str, order: Sequence[str] | None = None) -> DataFrame:
    """Count and percentage per level, with the position of a fixed order."""
    counts = df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    position = F.lit(None).cast("int")
    if order:
        position = F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), F.col("level")), F.lit(0).cast("bigint")).cast("int")
    return counts.select("level", "n", (F.col("n") * F.lit(100.0) / total).cast("double").alias("pct"), position.alias("position"))


def status_counts(df: DataFrame, keys: Sequence[str], status_col: str, statuses: Mapping[str, str], entity: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct entities and rows per status, for the given keys (or overall)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(status_col) == status).alias(out) for out, status in statuses.items()]
    if entity:
        aggs.append(F.count_distinct(*[F.col(c) for c in entity]).alias("n_entities"))
    return df.groupBy(*keys).agg(*aggs)


def first_last_change(df: DataFrame, keys: Sequence[str], order: str, value: str, eps: Number = 1.0,
                      labels: Sequence[str] = ("improved", "stable", "worsened")) -> DataFrame:
    """Change from the first to the last period of a series, and whether it matters.

    Groups need two periods at least, as a single one has no change.
    """
    ends = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.min(order).alias("first_period"),
        F.max(order).alias("last_period"),
        F.min_by(value, order).alias("first_value"),
        F.max_by(value, order).alias("last_value"),
    )
    changed = ends.where(F.col("first_period") < F.col("last_period"))
    changed = changed.withColumn("change", F.col("last_value") - F.col("first_value"))
    return changed.withColumn("direction", signed_band("change", eps, labels))


def trend_class(df: DataFrame, keys: Sequence[str], x: str, y: str, min_n: int = 3, low: Number = -0.3, high: Number = 0.3) -> DataFrame:
    """Correlation of a series with its period, and the direction it implies."""
    stats = df.groupBy(*keys).agg(F.count_distinct(x).alias("n_periods"), safe_corr(x, y).alias("corr"))
    return stats.withColumn("trend", trend_label("n_periods", "corr", min_n, low, high))


def correlate(df: DataFrame, keys: Sequence[str], x: str, y: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), safe_corr(x, y).alias("corr"), *more)


def bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("low"), F.max(col).alias("high"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def constant_in_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key for columns that do not vary within it (largest value if they do)."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def mean_by(df: DataFrame, keys: Sequence[str], value: Column | str, out: str, absolute: bool = False) -> DataFrame:
    v = column(value)
    return df.groupBy(*keys).agg(F.avg(F.abs(v) if absolute else v).alias(out))
