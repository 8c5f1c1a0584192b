"""Star-schema builders: dimensions with stable keys, calendar, facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.dates import key_of_date
from caudal.functions.text import stable_key, wide_key
from caudal.operators.joins import attach_all
from caudal.operators.projection import with_exact_types


def build_dim(df: DataFrame, natural_keys: Sequence[str], key_col: str, attrs: Sequence[str] = (),
              constants: Mapping[str, object] | None = None) -> DataFrame:
    """One row per natural key with a stable surrogate.

    Rows with an unknown key or attribute are left out. An entity written in several
    ways keeps one row (the largest spelling), so joining the dimension never
    multiplies fact rows.
    """
    known = df.select(*natural_keys, *attrs).na.drop(subset=[*natural_keys, *attrs])
    if attrs:
        entities = known.groupBy(*natural_keys).agg(*[F.max(a).alias(a) for a in attrs])
    else:
        entities = known.distinct()
    fixed = [F.lit(v).alias(n) for n, v in (constants or {}).items()]
    return entities.select(stable_key(*natural_keys).alias(key_col), *natural_keys, *attrs, *fixed)


def merge_dim(stored: DataFrame, df: DataFrame, natural_keys: Sequence[str], key_col: str, attrs: Sequence[str] = (), constants: Mapping[str, object] | None = None) -> DataFrame:
    """A stored dimension with the members of new rows.

    The same as building it from all rows seen so far: keys are functions of the natural
    key, and of several spellings the largest stays.
    """
    cols = [*natural_keys, *attrs]
    return build_dim(stored.select(*cols).unionByName(df.select(*cols)), natural_keys, key_col, attrs, constants)


def build_calendar(spark: SparkSession, low_year: int | Column, high_year: int | Column) -> DataFrame:
    """One row per day from 1 January of the first year to 31 December of the last."""
    first = F.make_date(F.lit(low_year) if isinstance(low_year, int) else low_year, F.lit(1), F.lit(1))
    last = F.make_date(F.lit(high_year) if isinstance(high_year, int) else high_year, F.lit(12), F.lit(31))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    return days.select(
        key_of_date("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
    )


def year_bounds(frames: Sequence[DataFrame], col: str = "year") -> tuple[int, int]:
    """Smallest and largest year over several sources; sources without rows do not count.

    One job that returns one row, because the calendar has to fail on no years at all.
    """
    ends = [f.agg(F.min(col).alias("low"), F.max(col).alias("high")) for f in frames]
    stacked = ends[0]
    for e in ends[1:]:
        stacked = stacked.unionByName(e)
    row = stacked.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if row["low"] is None:
        raise ValueError("no source has a valid year to build the calendar from")
    return int(row["low"]), int(row["high"])


def build_fact(
    df: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str] | str, Sequence[str]]],
    columns: Sequence[str],
    casts: Mapping[str, str],
    id_col: str | None = None,
    grain: Sequence[str] = (),
    verify: bool = True,
) -> DataFrame:
    """Resolve foreign keys, apply the decimal contract, identify the rows by their natural grain.

    Unmatched natural keys give a NULL foreign key, which the quality report counts; the
    ids of such rows differ all the same. A lookup with a repeated key fails the job;
    ``verify=False`` leaves that check out where the lookups were checked before.
    """
    identified = df.withColumn(id_col, wide_key(*grain)) if id_col else df
    resolved = with_exact_types(attach_all(identified, lookups, verify=verify), casts)
    if id_col:
        return resolved.select(id_col, *columns)
    return resolved.select(*columns)
