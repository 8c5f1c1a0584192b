"""Column profiles, descriptive statistics and storage reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caudal.functions.numeric import known
from caudal.operators.joins import join_same
from caudal.operators.windows import quantiles_by
from caudal.sources.readers import list_files

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
GIGABYTE = 1024**3


def profile(df: DataFrame, examples: int = 3) -> DataFrame:
    """Per column: type, missing values, distinct values and the first few of them.

    Columns are stacked to (column, value) and counted, so every distinct value is one
    row before anything is grouped by column; the examples are the smallest values.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
    counted = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    summary = counted.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.sum("n").alias("_total"),
        F.count("value").alias("n_unique"),
    )
    first = Window.partitionBy("column_name").orderBy("value")
    picked = counted.where(F.col("value").isNotNull()).withColumn("_i", F.row_number().over(first)).where(F.col("_i") <= examples)
    picked = picked.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("examples"))
    dtype = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return summary.join(picked, "column_name", "left").select(
        "column_name",
        F.try_element_at(dtype, F.col("column_name")).alias("dtype"),
        "n_missing",
        F.round(F.try_divide(F.lit(100.0) * F.col("n_missing"), F.col("_total")), 2).alias("pct_missing"),
        "n_unique",
        "examples",
    )


def value_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct known combinations, sorted: the value dictionary."""
    return df.select(*cols).na.drop().distinct().orderBy(*cols)


def null_counts_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    counted = cols or [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in counted])


def describe_by(df: DataFrame, value: str, by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, overall or per group."""
    v = known(value)
    moments = df.groupBy(*by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    quartiles = quantiles_by(df, value, QUARTILES, by, slices)
    if by:
        return join_same(moments, quartiles, by)
    row = quartiles.select(F.struct(*QUARTILES)).scalar()
    return moments.withColumn("_q", row).select(*moments.columns, *[F.col(f"_q.{name}").alias(name) for name in QUARTILES])


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Files below a root with their sizes, from the listing: no file is opened, whatever it holds."""
    return list_files(spark, root).select(F.col("path").alias("file_path"), "size_bytes")


def size_report(listings: Mapping[str, DataFrame], price_per_gb: float = 0.023) -> DataFrame:
    """Bytes, gigabytes and monthly cost per layer or table."""
    frames = [files.withColumn("layer", F.lit(name)) for name, files in listings.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    sizes = stacked.groupBy("layer").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("size_bytes"))
    gb = F.col("size_bytes") / F.lit(float(GIGABYTE))
    return sizes.withColumns({
        "size_gb": gb, "size_text": readable_size("size_bytes"), "cost_usd_month": gb * F.lit(price_per_gb)
    })


def readable_size(col: str):
    """Bytes as text in the largest fitting unit, two decimals."""
    units = F.array(*[F.lit(u) for u in ("B", "KB", "MB", "GB", "TB", "PB")])
    size = F.col(col).cast("double")
    step = F.least(F.floor(F.log2(size) / 10), F.lit(5)).cast("int")
    number = F.round(size / F.pow(F.lit(1024.0), step.cast("double")), 2)
    text = F.concat_ws(" ", number.cast("string"), F.element_at(units, step + 1))
    return F.when(size > 0, text).otherwise(F.lit("0 B"))
