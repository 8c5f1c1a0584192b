"""Data-quality reports as one frame: ``(check_name, column_name, n_bad, n_total)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.functions.numeric import Number
from caudal.operators.aggregates import union_all
from caudal.operators.joins import orphans
from caudal.operators.projection import Contract

REPORT_SCHEMA = "check_name string, column_name string, n_bad bigint, n_total bigint"


@dataclass(frozen=True)
class RowCheck:
    """A rule each row can break on its own."""

    check: str
    column: str
    broken: Column


def nulls(cols: Sequence[str]) -> list[RowCheck]:
    return [RowCheck("null", c, F.col(c).isNull()) for c in cols]


def negatives(cols: Sequence[str]) -> list[RowCheck]:
    return [RowCheck("negative", c, F.col(c) < 0) for c in cols]


def outside(col: str, low: Number, high: Number) -> list[RowCheck]:
    return [RowCheck("out_of_range", col, ~F.col(col).between(low, high))]


def not_in(col: str, allowed: Sequence) -> list[RowCheck]:
    return [RowCheck("not_in_domain", col, ~F.col(col).isin(list(allowed)))]


def date_parts_disagree(date: str, year: str | None = None, month: str | None = None, key: str | None = None) -> list[RowCheck]:
    d = F.col(date)
    checks = []
    if year:
        checks.append(RowCheck("date_part", year, F.year(d) != F.col(year)))
    if month:
        checks.append(RowCheck("date_part", month, F.month(d) != F.col(month)))
    if key:
        expected = F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
        checks.append(RowCheck("date_key", key, expected != F.col(key)))
    return checks


def not_period_end(key: str, grain: str) -> list[RowCheck]:
    day = F.try_to_date(F.col(key).cast("string"), "yyyyMMdd")
    end = F.last_day(day) if grain == "month" else F.make_date(F.year(day), F.lit(12), F.lit(31))
    return [RowCheck("anchor", key, day.isNull() | (day != end))]


def dq_report(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row rules in one aggregation, then one row per rule."""
    totals = df.agg(F.count(F.lit(1)).alias("n_total"), *[F.count_if(c.broken).alias(f"b{i}") for i, c in enumerate(checks)])
    entries = F.array(*[
        F.struct(F.lit(c.check).alias("check_name"), F.lit(c.column).alias("column_name"), F.col(f"b{i}").alias("n_bad"))
        for i, c in enumerate(checks)
    ])
    return totals.select(F.inline(entries), "n_total")


def _reported(check: str, cols: Sequence[str], n_bad: Column, n_total: Column) -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(",".join(cols)).alias("column_name"), n_bad.alias("n_bad"), n_total.alias("n_total")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Total minus distinct rows; copies collapse on the map side before the shuffle."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    n_total = F.coalesce(F.sum("_n"), F.lit(0))
    return copies.agg(*_reported("duplicate_row", ["*"], n_total - F.count(F.lit(1)), n_total))


def repeated_keys(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys of the grain that occur more than once."""
    sizes = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(*_reported("repeated_key", grain, F.count_if(F.col("_n") > 1), F.coalesce(F.sum("_n"), F.lit(0))))


def unresolved_keys(df: DataFrame, dim: DataFrame, on: Sequence[str] | str, dim_on: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose foreign key is missing in the dimension or NULL.

    Keys are counted first and looked up once each, so a hot key costs one row.
    """
    names = [on] if isinstance(on, str) else list(on)
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    keys = dim.select(*[F.col((dim_on or {}).get(n, n)).alias(n) for n in names])
    bad = orphans(counted, keys, names).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_bad"))
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return bad.select(*_reported("foreign_key", names, F.col("n_bad"), total))


def unresolved_in_one_read(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """``unresolved_keys`` for several keys, in one read of ``df``. ``dims``: by key column, the dimension that has it.

    Combinations of keys are counted first, so the lookups see each once.
    """
    known = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))
    for i, (key, dim) in enumerate(dims.items()):
        known = known.join(dim.select(F.col(key), F.lit(True).alias(f"_found{i}")).distinct(), key, "left")
    bad = [F.coalesce(F.sum(F.when(F.col(f"_found{i}").isNull(), F.col("_n"))), F.lit(0)) for i in range(len(dims))]
    total = F.coalesce(F.sum("_n"), F.lit(0))
    counts = known.agg(*[b.alias(f"_bad{i}") for i, b in enumerate(bad)], total.alias("_total"))
    rows = [F.struct(*_reported("foreign_key", [key], F.col(f"_bad{i}"), F.col("_total"))) for i, key in enumerate(dims)]
    return counts.select(F.inline(F.array(*rows)))


def schema_changes(df: DataFrame, contract: Contract) -> DataFrame:
    """Columns that are missing, new or of another type than the contract says."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    expected = {f.name: f.dataType for f in contract.schema.fields}
    rows = [("missing", n, t.simpleString(), None) for n, t in expected.items() if n not in actual]
    rows += [("unexpected", n, None, t.simpleString()) for n, t in actual.items() if n not in expected]
    rows += [("type", n, expected[n].simpleString(), t.simpleString()) for n, t in actual.items() if n in expected and t != expected[n]]
    return df.sparkSession.createDataFrame(rows, "change string, column_name string, expected string, actual string")


def full_report(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames)


def fill_by_type(df: DataFrame, number: Number = 0, text: str = "UNKNOWN") -> DataFrame:
    """Unknown numbers become ``number`` and unknown strings ``text``, by data type."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.fillna(number, subset=numeric) if numeric else df
    return df.fillna(text, subset=strings) if strings else df


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop on an empty input. Reads until the first row."""
    if df.isEmpty():
        raise ValueError(f"no rows in {name}")
    return df


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per required table, and whether it is usable."""
    counted = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()
    ]
    return union_all(counted).withColumn("is_usable", F.col("n_rows") > 0)


def require_tables(tables: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    for name, df in tables.items():
        require_rows(df, name)
    return tables
