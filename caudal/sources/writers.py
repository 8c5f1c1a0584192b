"""Sinks: one declared layout per dataset, sized files, per-partition replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caudal.sources.publish import Publication


@dataclass(frozen=True)
class Sink:
    """Where and how a dataset is stored."""

    path: str
    keys: tuple[str, ...] = ()
    allowed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    order: tuple[str, ...] = ()


def write_partitions(
    df: DataFrame, path: str, keys: Sequence[str], mode: str = "dynamic", rebalance: bool = True, order: Sequence[str] = ()
) -> int:
    """Write partition folders and return the number of rows written.

    ``dynamic`` replaces only the partitions that occur in ``df``, so an empty frame
    changes nothing; ``static`` replaces the whole table once all of it is written, so
    a failure leaves the old one. The rebalance hint lets
    Spark split a partition that holds much of the data over several files and merge
    small ones, so neither one task nor many tiny files results. ``order`` sorts the
    rows of each file, for readers that filter on those columns.
    """
    if mode not in ("dynamic", "static", "append"):
        raise ValueError("mode must be 'dynamic', 'static' or 'append'")
    if mode == "static":
        with Publication(df.sparkSession) as publication:
            return publication.stage(df, path, keys, order)
    counter = Observation()
    out = df.hint("rebalance", *[F.col(k) for k in keys]) if rebalance and keys else df
    if order:
        out = out.sortWithinPartitions(*keys, *order)
    writer = out.observe(counter, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy")
    if mode == "append":
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*keys).parquet(path)
    return int(counter.get["rows"])


def replace_period(
    df: DataFrame, path: str, keys: Sequence[str], period: Mapping[str, int], order: Sequence[str] = (), publication: Publication | None = None
) -> int:
    """Write one period's folder anew, also if nothing is left in it; returns the number of rows written.

    ``period`` gives values of the first partition keys; all rows of ``df`` must have
    them. What the folder held before goes once the new rows are written, other folders
    stay. With a publication, the folder is switched with the others of that one.
    """
    first, rest = list(keys[: len(period)]), list(keys[len(period):])
    if set(first) != set(period):
        raise ValueError(f"a period is set by the first of {', '.join(keys)}")
    folder = "/".join([path.rstrip("/"), *[f"{k}={period[k]}" for k in first]])
    inside = df.where(reduce(lambda a, b: a & b, [F.col(k) == period[k] for k in first])).drop(*first)
    if publication is not None:
        return publication.stage(inside, folder, rest, order)
    with Publication(df.sparkSession) as own:
        return own.stage(inside, folder, rest, order)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """An unpartitioned table; returns the number of rows written. ``overwrite`` replaces the old one after success."""
    if mode == "overwrite":
        with Publication(df.sparkSession) as publication:
            return publication.stage(df, path)
    counter = Observation()
    df.observe(counter, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "snappy").parquet(path)
    return int(counter.get["rows"])


def write_to(df: DataFrame, sink: Sink, mode: str = "dynamic", period: Mapping[str, int] | None = None, publication: Publication | None = None) -> int:
    """Write by a declared sink: its allow-lists first, then its layout. With a period, that is replaced and nothing else.

    A publication takes up what replaces a period or a whole table; ``dynamic`` and
    ``append`` writes of whole tables take effect by themselves when they succeed.
    """
    for col, values in sink.allowed:
        df = df.where(F.col(col).isin(list(values)))
    if period:
        return replace_period(df, sink.path, sink.keys, period, sink.order, publication)
    if publication is not None and (mode == "static" or not sink.keys):
        return publication.stage(df, sink.path, sink.keys, sink.order)
    return write_partitions(df, sink.path, sink.keys, mode, order=sink.order) if sink.keys else write_table(df, sink.path)


def with_audit(df: DataFrame, col: str = "processed_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())
