"""Calendar keys: ``YYYYMMDD`` integers and the period anchors built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudal.functions.numeric import column


def year_of_key(key: Column | str) -> Column:
    """Year of a ``YYYYMMDD`` key by integer division, usable as a partition filter."""
    return F.call_function("div", column(key), F.lit(10000)).cast("int")


def key_of_date(day: Column | str) -> Column:
    d = column(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_end_key(year: Column | str) -> Column:
    return (column(year) * 10000 + 1231).cast("int")


def month_end_key(year: Column | str, month: Column | str) -> Column:
    return key_of_date(F.last_day(F.make_date(column(year), column(month), F.lit(1))))


def timestamp_of_micros(micros: Column | str) -> Column:
    return F.timestamp_micros(column(micros))


def timestamp_of_nanos(nanos: Column | str) -> Column:
    """For Parquet nanosecond timestamps read as integers (``spark.sql.legacy.parquet.nanosAsLong``)."""
    return F.timestamp_micros(F.call_function("div", column(nanos), F.lit(1000)))
