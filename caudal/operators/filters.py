"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from caudal.functions.numeric import Number


def keep_in(df: DataFrame, **allowed: Sequence) -> DataFrame:
    """Rows whose columns hold one of the allowed values; ``None`` leaves a column free."""
    for name, values in allowed.items():
        if values is not None:
            df = df.where(F.col(name).isin(list(values)))
    return df


def non_negative_or_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for name in cols:
        df = df.where((F.col(name) >= 0) | F.col(name).isNull())
    return df


def keep_known(df: DataFrame, cols: Sequence[str], observation: Observation | None = None) -> DataFrame:
    """Rows with all ``cols`` known. The dropped count rides along on the same job."""
    known = F.lit(True)
    for name in cols:
        known = known & F.col(name).isNotNull()
    if observation is not None:
        df = df.observe(observation, F.count_if(~known).alias("dropped"), F.count(F.lit(1)).alias("total"))
    return df.where(known)


def drop_incomplete(df: DataFrame, how: str, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(how=how, subset=list(subset))


def keep_matching(df: DataFrame, keys_df: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key occurs in ``keys_df``.

    A semi-join: on a partitioned fact it prunes partitions at run time, and no key
    list passes through the driver. Spark broadcasts the keys only while their size
    is below its threshold.
    """
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys_df.select(*names), on=names, how="left_semi")


def clip_to_range(df: DataFrame, ref_df: DataFrame, col: str, ref_col: str | None = None) -> DataFrame:
    """Rows within the smallest and largest value of another series (scalar subqueries)."""
    name = ref_col or col
    low = ref_df.agg(F.min(name)).scalar()
    high = ref_df.agg(F.max(name)).scalar()
    return df.where((F.col(col) >= low) & (F.col(col) <= high))


def latest(df: DataFrame, col: str = "year") -> DataFrame:
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def earliest(df: DataFrame, col: str = "year") -> DataFrame:
    return df.where(F.col(col) == df.agg(F.min(col)).scalar())


def between(df: DataFrame, col: str, low: Number | None = None, high: Number | None = None) -> DataFrame:
    if low is not None:
        df = df.where(F.col(col) >= low)
    if high is not None:
        df = df.where(F.col(col) <= high)
    return df


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0)


def groups_of_at_least(df: DataFrame, n_col: str, n: int = 2) -> DataFrame:
    """HAVING on a count already computed by the aggregation."""
    return df.where(F.col(n_col) >= n)


class Audit:
    """Counts of rows between the steps of plans, taken while the plans are written: no job of their own."""

    def __init__(self) -> None:
        self._points: list[tuple[str, str, Observation]] = []

    def count(self, df: DataFrame, source: str, step: str) -> DataFrame:
        """``df``, of which the rows left after ``step`` are counted."""
        seen = Observation()
        self._points.append((source, step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """source, position, step, n_rows, n_dropped (by this step; NULL for a source's first). Once the counted plans have run."""
        rows = [(source, i, step, _observed(seen)) for i, (source, step, seen) in enumerate(self._points)]
        before = F.lag("n_rows").over(Window.partitionBy("source").orderBy("position"))
        counted = spark.createDataFrame(rows, "source string, position int, step string, n_rows bigint")
        return counted.withColumn("n_dropped", before - F.col("n_rows"))


def _observed(seen: Observation) -> int:
    try:
        return int(seen.get["rows"])
    except Py4JJavaError:  # of a plan that Spark knows to be empty it takes no counts
        return 0


def counted(df: DataFrame, audit: Audit | None, source: str, step: str) -> DataFrame:
    return df if audit is None else audit.count(df, source, step)
