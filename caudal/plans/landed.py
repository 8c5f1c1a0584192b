"""The landed sources in their folder layout, brought to the contracts of the cleaners."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.functions.dates import timestamp_of_micros
from caudal.operators.filters import Audit
from caudal.operators.projection import with_date_parts
from caudal.operators.quality import full_report
from caudal.plans.cleaning import clean_climate, clean_coverage, clean_indicators, climate_report, coverage_report, indicator_report
from caudal.sources.readers import exists, list_files, read_glob, read_roots, stored_schema

log = logging.getLogger(__name__)

# Landing folders.
SURVEY_FOLDER = "jmp"
INDICATOR_FOLDER = "world_bank"
CLIMATE_FOLDER = "open_meteo"
INDICATOR_COLUMNS = ("country_code", "date", "indicator_code", "indicator_name", "value")
#: Layouts whose folders tell the year: the first is that of ``ingest.land``.
PERIODS = r"/area=[^/]+/period=([0-9]+|__HIVE_DEFAULT_PARTITION__)/[^/]+$"
YEARS = r"/[^/=]+=[^/]+/year=([0-9]+)/[^/]+$"


def read_landed(spark: SparkSession, root: str, year: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Every Parquet file below a root, in whatever folders. With a year, folders of other years are left out where all files lie
    in folders of years; otherwise all files are read, and rows of other years are for the caller to drop.

    With a schema stored beside the files none is opened for planning.
    """
    schema = stored_schema(spark, root)
    chosen = lambda df: df.select(*columns) if columns else df
    if year is None:
        return read_roots(spark, [root], columns, schema=schema)
    files = list_files(spark, root)
    n, by_period, by_year, of_year = files.agg(
        F.count(F.lit(1)), F.count_if(F.col("path").rlike(PERIODS)), F.count_if(F.col("path").rlike(YEARS)),
        F.count_if(F.regexp_extract("path", YEARS, 1) == str(year))).first()
    if n and n == by_period:
        layout = [T.StructField("area", T.StringType()), T.StructField("period", T.IntegerType())]
        reader = spark.read.schema(T.StructType([*schema.fields, *layout])) if schema else spark.read.option("mergeSchema", True)
        return chosen(reader.parquet(root).where(F.col("period") == year).drop("area", "period"))
    if n and n == by_year:
        return chosen(read_glob(spark, f"{root}/*=*/year={year}")) if of_year else read_roots(spark, [root], columns, schema=schema).where("false")
    log.warning("%s of %s files below %s lie outside the folders of years; all are read", n - max(by_period, by_year), n, root)
    return read_roots(spark, [root], columns, schema=schema)


def read_coverage(spark: SparkSession, landing: str, year: int | None = None) -> DataFrame:
    """Survey rows of all years, or those that one year's folders hold."""
    return read_landed(spark, f"{landing}/{SURVEY_FOLDER}", year)


def read_indicators(spark: SparkSession, landing: str, year: int | None = None) -> DataFrame:
    return read_landed(spark, f"{landing}/{INDICATOR_FOLDER}", year, INDICATOR_COLUMNS)


def read_climate(spark: SparkSession, landing: str, countries: Sequence[str] | None = None, year: int | None = None) -> DataFrame:
    """Daily rows of every country that has landed, or of the named ones, of which none may be missing.

    The country comes from the folder, and year and month from the date where the
    files lack them. Dates may be stored as microseconds.
    """
    base = f"{landing}/{CLIMATE_FOLDER}"
    country = F.regexp_extract("_metadata.file_path", f"{CLIMATE_FOLDER}/(?:area=)?([A-Z]{{3}})/", 1).alias("country_iso3")
    if year is None:
        keyed = [f"{base}/area={iso3}" for iso3 in countries or ()]
        roots = [k if exists(spark, k) else f"{base}/{k.rpartition('=')[2]}" for k in keyed] or [base]
        rows = read_roots(spark, roots, schema=stored_schema(spark, base))
    else:
        rows = read_landed(spark, base, year)
        missing = [c for c in countries or () if not exists(spark, f"{base}/area={c}") and not exists(spark, f"{base}/{c}")]
        if missing:
            raise ValueError(f"countries that have not landed: {', '.join(missing)}")
    rows = rows.select("*", country)
    if year is not None and countries:
        rows = rows.where(F.col("country_iso3").isin(list(countries)))
    if "date" in rows.columns and rows.schema["date"].dataType == T.LongType():
        rows = rows.withColumn("date", timestamp_of_micros("date"))
    if "year" not in rows.columns or "month" not in rows.columns:
        rows = with_date_parts(rows, "date")
    return rows


def cleaned(
    spark: SparkSession, landing: str, countries: Sequence[str] | None = None, year: int | None = None, audit: Audit | None = None
) -> dict[str, DataFrame]:
    """All cleaned tables from one landing root; lazy. With a year, folders of other years are not read where the layout has years.

    An audit counts the rows before and after each cleaning step while the tables are written.
    """
    landing = landing.rstrip("/")
    return {
        "coverage": clean_coverage(read_coverage(spark, landing, year), audit=audit),
        "indicators": clean_indicators(read_indicators(spark, landing, year), audit=audit),
        "climate": clean_climate(read_climate(spark, landing, countries, year), audit=audit),
    }


def report(spark: SparkSession, landing: str, countries: Sequence[str] | None = None) -> DataFrame:
    """Quality of the landed sources: one row per source, check and column."""
    landing = landing.rstrip("/")
    reports = {
        "coverage": coverage_report(read_coverage(spark, landing)),
        "indicators": indicator_report(read_indicators(spark, landing)),
        "climate": climate_report(read_climate(spark, landing, countries)),
    }
    return full_report([df.select(F.lit(name).alias("source"), "*") for name, df in reports.items()])
