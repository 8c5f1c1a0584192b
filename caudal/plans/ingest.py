"""Raw files as their providers send them, landed as partitioned Parquet that ``landed`` reads.

Below a raw root: ``jmp`` holds delimited survey files, ``world_bank`` one JSON page per
file, ``open_meteo/<ISO3>/<province>.json`` the daily arrays of a place. Partitions that
occur in the raw files are replaced, so landing the same files again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.text import key_from_path
from caudal.plans.contracts import CLIMATE_LANDED, COVERAGE_LANDED
from caudal.plans.landed import CLIMATE_FOLDER, INDICATOR_FOLDER, SURVEY_FOLDER
from caudal.sources.readers import flatten_arrays, flatten_pages, read_delimited, store_schema
from caudal.sources.writers import write_partitions

# Fields of an indicator record.
RECORD = (
    "struct<countryiso3code: string, country: struct<value: string>, indicator: struct<id: string, value: string>, "
    "date: string, value: double, unit: string, obs_status: string, decimal: bigint>"
)
RECORD_FIELDS = {
    "country_code": "countryiso3code", "country_name": "country.value", "indicator_code": "indicator.id", "indicator_name": "indicator.value",
    "date": "date", "value": "value", "unit": "unit", "obs_status": "obs_status", "decimal": "decimal",
}
DAILY = "daily"


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return rows.select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("path"))


def survey(spark: SparkSession, raw: str) -> DataFrame:
    return read_delimited(spark, f"{raw}/{SURVEY_FOLDER}", COVERAGE_LANDED.schema)


def indicators(spark: SparkSession, raw: str) -> DataFrame:
    flat = flatten_pages(_payloads(spark, f"{raw}/{INDICATOR_FOLDER}"), "payload", RECORD, RECORD_FIELDS)
    return flat.withColumn("date", F.col("date").try_cast("bigint"))


def climate(spark: SparkSession, raw: str) -> DataFrame:
    """Days of all places; country and province are those of the file's path."""
    place = r"/([A-Z]{3})/([^/]+)\.json$"
    files = _payloads(spark, f"{raw}/{CLIMATE_FOLDER}").withColumns({
        "country_iso3": key_from_path("path", place, 1), "province": F.url_decode(key_from_path("path", place, 2))})
    measures = {f.name: f.dtype for f in CLIMATE_LANDED.fields if f.name not in ("province", "date")}
    days = flatten_arrays(files, "payload", DAILY, {"time": "string", **measures}, {"time": "date"}, ["country_iso3", "province"])
    return days.withColumn("date", F.col("date").try_cast("timestamp"))


def land(spark: SparkSession, raw: str, landing: str, sources: Sequence[str] = ("survey", "indicators", "climate")) -> dict[str, int]:
    """Land the named sources; returns the rows written. Folder keys have names of their own, so that files keep their columns.

    The schema is merged with that of earlier landings and stored beside the files, for readers that then open none of them.
    """
    raw, landing = raw.rstrip("/"), landing.rstrip("/")
    plans = {
        "survey": (survey, SURVEY_FOLDER, {"area": "ISO3", "period": "Year"}),
        "indicators": (indicators, INDICATOR_FOLDER, {"area": "country_code", "period": "date"}),
        "climate": (climate, CLIMATE_FOLDER, {"area": "country_iso3", "period": F.year("date")}),
    }
    written = {}
    for name in sources:
        read, folder, keys = plans[name]
        rows = read(spark, raw).withColumns({k: F.col(c) if isinstance(c, str) else c for k, c in keys.items()})
        if name == "climate":
            rows = rows.drop("country_iso3")  # read from the folder
        store_schema(spark, f"{landing}/{folder}", rows.drop(*keys).schema)
        written[name] = write_partitions(rows, f"{landing}/{folder}", list(keys))
    return written
