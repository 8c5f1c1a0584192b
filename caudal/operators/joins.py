"""Equi-joins. No join here forces a broadcast.

Spark broadcasts a side when its size, from statistics or measured at run time, is
below its threshold, and otherwise sorts and merges, splitting skewed keys of the
detail side. A forced hint would skip that check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.dates import key_of_date


def _names(on: Sequence[str] | str) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def unique_on(dim: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``dim`` with a check, inside the plan, that ``on`` identifies one row."""
    names = _names(on)
    rest = [c for c in dim.columns if c not in names]
    message = F.concat(F.lit("duplicate key in lookup: "), F.concat_ws(", ", *[F.col(n).cast("string") for n in names]))
    checked = dim.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    return checked.where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).select(dim.columns)


def attach(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | str,
    cols: Sequence[str] | None = None,
    how: str = "left",
    verify: bool = False,
    salt: int = 1,
) -> DataFrame:
    """Bring columns of a lookup to detail rows; ``on`` must be unique in the lookup.

    ``verify`` checks uniqueness in the plan. ``salt`` > 1 spreads every key over that
    many join partitions: each lookup row is repeated once per salt and each detail row
    takes the salt of the task that produced it, which a re-run task reproduces. It is
    for lookups too large to broadcast where one key holds much of the detail, so the
    repeated rows are shuffled and sorted: measured before they are repeated they can
    look small, and a broadcast would hold ``salt`` times the lookup in every task.
    """
    names = _names(on)
    wanted = dim.select(*names, *[c for c in (cols or dim.columns) if c not in names])
    if verify:
        wanted = unique_on(wanted, names)
    if salt <= 1:
        return df.join(wanted, on=names, how=how)
    if how.replace("_", "") not in ("inner", "left", "leftouter"):
        raise ValueError(f"salt repeats lookup rows, so it cannot go with a {how} join")
    salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salt)).cast("int"))
    copies = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return salted.join(copies.hint("merge"), on=[*names, "_salt"], how=how).drop("_salt")


def attach_all(df: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str] | str, Sequence[str]]], how: str = "left", verify: bool = False) -> DataFrame:
    """A chain of lookups, as in foreign-key resolution."""
    for dim, on, cols in lookups:
        df = attach(df, dim, on, cols, how, verify)
    return df


def attach_places(df: DataFrame, places: DataFrame, on: Sequence[str] | str, drop_unknown: bool = True) -> DataFrame:
    """Coordinates from a place table; rows without any are dropped or kept with NULLs."""
    return attach(df, places, on, how="inner" if drop_unknown else "left")


def anchor_dates(calendar: DataFrame, grain: str = "year") -> DataFrame:
    """``date_key`` that stands for a period: 31 December, or the last day of a month."""
    if grain == "year":
        last = calendar.where((F.month("date") == 12) & (F.dayofmonth("date") == 31))
        return last.select("year", "date_key")
    if grain == "month":
        return calendar.where(F.col("date") == F.last_day("date")).select("year", "month", key_of_date("date").alias("date_key"))
    raise ValueError("grain must be 'year' or 'month'")


def match_series(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Two yearly series side by side, where both have the key."""
    return left.join(right, on=list(on), how="inner")


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; keeps the columns of ``left`` and the rest of ``right``."""
    rest = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *rest)
    same = [left[k].eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, same, how).select(*[left[c] for c in left.columns], *rest)


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Detail rows with aggregates of their group.

    Aggregate and join back rather than a window: the aggregate combines on the map
    side and the join can split a hot group, where a window would put all of it in one
    task.
    """
    grouped = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return join_same(df, grouped, keys)


def orphans(df: DataFrame, dim: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key the lookup does not have."""
    names = _names(on)
    return df.join(dim.select(*names), on=names, how="left_anti")
