"""Series deltas, top-k and rankings.

Windows appear only where a partition is bounded: a yearly series holds one row per
year, and top-k is cut to k rows per task before the shuffle. A full ranking of a
large table goes through value counts and slices instead (``rank_by``).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.functions.numeric import Number, column, known
from caudal.operators.joins import join_same
from caudal.session import stored

#: More parts of a group than this meet in two rounds.
PARTS_AT_ONCE = 64


def yoy_delta(
    df: DataFrame,
    series_keys: Sequence[str],
    order: str,
    measures: Mapping[str, str],
    drop_first: bool = True,
    require_consecutive: bool = False,
) -> DataFrame:
    """Change of each measure against the previous row of its series.

    ``measures`` maps a measure to the name of its delta. The frame must hold one row
    per series and period. The previous row can be several years back;
    ``require_consecutive`` makes such a delta NULL. ``drop_first`` removes rows with
    any delta unknown.
    """
    series = Window.partitionBy(*series_keys).orderBy(order)
    adjacent = F.col(order) - F.lag(order).over(series) == 1
    deltas = {}
    for measure, out in measures.items():
        delta = F.col(measure) - F.lag(measure).over(series)
        deltas[out] = F.when(adjacent, delta) if require_consecutive else delta
    changed = df.withColumns(deltas)
    return changed.na.drop(how="any", subset=list(measures.values())) if drop_first else changed


def top_k(
    df: DataFrame,
    value: Column | str,
    k: int,
    by: Sequence[str] = (),
    absolute: bool = False,
    tie_break: Sequence[str] = (),
    ascending: bool = False,
) -> DataFrame:
    """The k rows with the largest value, overall or per group.

    ``tie_break`` must make the order total for a repeatable result. Overall, each
    task keeps its best k; per group Spark limits each group to k rows per task before
    the shuffle, so neither a hot group nor the whole table reaches one task. Spark does
    so up to a threshold; for a larger k each group is cut in parts first, by a hash, and
    many parts meet in two rounds, so that none gets k rows from more than about the
    square root of all parts.
    """
    v = F.abs(column(value)) if absolute else column(value)
    if isinstance(df.select(v).schema[0].dataType, (T.DoubleType, T.FloatType)):
        v = known(v)  # NaN sorts above every number
    order = [v.asc_nulls_last() if ascending else v.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    if not by:
        return df.orderBy(*order).limit(k)
    conf = df.sparkSession.conf
    if k > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = int(conf.get("spark.sql.shuffle.partitions"))
        df = df.withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts)))
        inside = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
        for n in [parts] if parts <= PARTS_AT_ONCE else [parts, math.isqrt(parts)]:
            df = df.withColumn("_part", F.col("_part") % n).withColumn("_place", inside).where(F.col("_place") <= k)
        df = df.drop("_part", "_place")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def top_1(df: DataFrame, value: Column | str, by: Sequence[str], cols: Sequence[str], absolute: bool = False) -> DataFrame:
    """Attributes of the row with the largest value per group; ties go to the smallest attributes."""
    v = F.abs(column(value)) if absolute else column(value)
    return top_k(df.select(*by, *cols, v.alias("_v")).where(F.col("_v").isNotNull()), "_v", 1, by, tie_break=cols).drop("_v")


def value_positions(df: DataFrame, value: Column | str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Distinct values per group with their count, how many rows are smaller, and the group size.

    Returns ``(*by, v, n, smaller, size)``; NULL and NaN are left out. Equal values are
    counted first, so one that holds a third of the rows becomes one row. The distinct
    values are cut into ``slices`` (two per shuffle partition by default) at
    boundaries taken from the data; running counts inside a slice plus the total of
    the lower slices give the position, so no task sorts a whole group. Boundaries are
    approximate, positions exact. Only the boundaries, at most ``slices`` numbers, pass
    through the driver: they are fixed before the plan runs, and a re-run task slices
    alike. The counts are stored, as boundaries, totals and positions all need them: the
    input is read and shuffled once for the three.
    """
    counts = df.select(*by, known(value).alias("v")).where(F.col("v").isNotNull()).groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "value-counts")
    slices = slices or max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = _boundaries(counts, slices)
    if cuts:
        splits = [-math.inf, *cuts, math.inf]
        sliced = Bucketizer(splits=splits, inputCol="v", outputCol="_slice", handleInvalid="keep").transform(counts)
        sliced = sliced.withColumn("_slice", F.col("_slice").cast("int"))
    else:
        sliced = counts.withColumn("_slice", F.lit(0))
    # One row per group and slice, so this window holds at most `slices` rows.
    totals = sliced.groupBy(*by, "_slice").agg(F.sum("n").alias("_slice_n"))
    lower = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(*by, "_slice", F.coalesce(F.sum("_slice_n").over(lower), F.lit(0)).alias("_lower"), F.sum("_slice_n").over(whole).alias("size"))
    inside = Window.partitionBy(*by, "_slice").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return join_same(placed, totals, [*by, "_slice"], "inner").select(
        *by, "v", "n", (F.col("_lower") + F.col("_inside")).alias("smaller"), "size")


def _boundaries(counts: DataFrame, slices: int, groups: int = 64) -> list[float]:
    """About equally many distinct values between neighbours; at most ``slices - 1`` of them.

    Sketches are merged in ``groups`` tasks first and their quantiles then in one, so
    that no task merges the sketches of a whole cluster.
    """
    steps = [i / slices for i in range(1, slices)]
    if not steps:
        return []
    per_group = counts.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups))).agg(F.percentile_approx("v", steps, 2 * slices).alias("q"))
    found = per_group.select(F.explode("q").alias("q")).agg(F.percentile_approx("q", steps, 2 * slices)).first()[0]
    return sorted({c for c in found or [] if math.isfinite(c)})


def rank_by(
    df: DataFrame, value: str, out: str = "rank", by: Sequence[str] = (), absolute: bool = False, slices: int | None = None
) -> DataFrame:
    """Rank of every row by descending value (ties share a rank), without a global sort.

    Rows with an unknown value have no rank. They are spread over the join by a hash.
    """
    rows = df.withColumn("_v", known(F.abs(F.col(value)) if absolute else value))
    unknown = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 20))
    rows = rows.withColumn("_spread", F.when(F.col("_v").isNull(), unknown).otherwise(F.lit(0)))
    positions = value_positions(rows, "_v", by, slices)
    ranks = positions.select(*by, F.col("v").alias("_v"), F.lit(0).cast("bigint").alias("_spread"), (F.col("size") - F.col("smaller") - F.col("n") + 1).alias(out))
    return join_same(rows, ranks, [*by, "_v", "_spread"]).select(*df.columns, out)


def quantiles_by(
    df: DataFrame, value: Column | str, quantiles: Mapping[str, float], by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, for groups of any size."""
    placed = value_positions(df, value, by, slices)
    at = lambda i: F.max(F.when((F.col("smaller") <= i) & (i < F.col("smaller") + F.col("n")), F.col("v")))
    aggs = []
    for out, q in quantiles.items():
        target = F.lit(float(q)) * (F.col("size") - 1)
        aggs += [at(F.floor(target)).alias(f"_lo_{out}"), at(F.ceil(target)).alias(f"_hi_{out}"),
                 F.max(target - F.floor(target)).alias(f"_part_{out}")]
    found = placed.groupBy(*by).agg(*aggs)
    return found.select(*by, *[
        (F.col(f"_lo_{o}") + (F.col(f"_hi_{o}") - F.col(f"_lo_{o}")) * F.col(f"_part_{o}")).alias(o) for o in quantiles
    ])


def scale_to_max(
    df: DataFrame, value: str, out: str, base: Number = 20000, span: Number = 60000, by: Sequence[str] = (),
    flat: Number = 25000,
) -> DataFrame:
    """``base`` plus the share of the group maximum times ``span``; ``flat`` when the maximum is not positive."""
    if by:
        rows = join_same(df, df.groupBy(*by).agg(F.max(value).alias("_peak")), by)
    else:
        rows = df.withColumn("_peak", df.agg(F.max(value)).scalar())
    share = F.try_divide(F.col(value).cast("double"), F.col("_peak").cast("double"))
    weight = F.when(F.col("_peak") > 0, F.lit(float(base)) + share * F.lit(float(span))).otherwise(F.lit(float(flat)))
    return rows.withColumn(out, weight).select(*df.columns, out)
