"""As-of join: for each row, the latest earlier event of its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slot(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are not above the value: looks at one bound in every stretch, then at one stretch."""
    if not bounds:
        return F.lit(0)
    stretch = max(1, int(len(bounds) ** 0.5))
    coarse = F.size(F.filter(F.lit(bounds[::stretch]).cast("array<bigint>"), lambda b: b <= value))
    at = F.greatest(coarse - 1, F.lit(0)) * stretch
    return at + F.size(F.filter(F.slice(F.lit(bounds).cast("array<bigint>"), at + 1, stretch), lambda b: b <= value))


def latest_before(rows: DataFrame, events: DataFrame, keys: list[str], order: str, event: str) -> DataFrame:
    """rows with `event`: that of events (columns keys, order, event, a struct) with the highest order below the row's; NULL if none.

    The order is cut into slices of like numbers of events, and a key's slices are worked on apart: inside a slice by a window,
    before it by the last event of each of the key's slices. So a key with a third of all rows is many groups. Of events with
    the same order the greater counts. Rows with a NULL key or order have no event. order is a bigint.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts = events.agg(F.percentile_approx(order, shares, 10_000)).first()[0] or []
    bounds = sorted(set(cuts))
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("__row")
    kind = rows.select(whole).schema["__row"].dataType
    told = events.schema[event].dataType
    asked = rows.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(order).alias("__order"), F.lit(0).alias("__late"), whole, F.lit(None).cast(told).alias("__event"))
    known = events.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(order).alias("__order"), F.lit(1).alias("__late"), F.lit(None).cast(kind).alias("__row"), F.col(event).alias("__event"))
    names = [f"__{k}" for k in keys]
    blank = " or ".join(f"`{n}` is null" for n in [*names, "__order"])
    both = asked.filter(f"not ({blank})").unionAll(known.filter(f"not ({blank})")).withColumn("__slice", slot(F.col("__order"), bounds))
    inside = Window.partitionBy(*names, "__slice").orderBy("__order", "__late", "__event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__in", F.last("__event", ignorenulls=True).over(inside)).filter("__late = 0")
    ends = both.groupBy(*names, "__slice").agg(F.max(F.when(F.col("__late") == 1, F.struct("__order", "__event"))).alias("__end"))
    earlier = Window.partitionBy(*names).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(earlier)).filter("__carry is not null").select(*names, "__slice", F.col("__carry.__event").alias("__carry"))
    found = seen.join(carried, [*names, "__slice"], "left").select("__row.*", F.coalesce("__in", "__carry").alias(event))
    return found.unionAll(asked.filter(blank).select("__row.*", F.lit(None).cast(told).alias(event)))
