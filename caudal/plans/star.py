"""The star schema: seven dimensions and four facts from the cleaned tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.bands import above, below
from caudal.functions.numeric import Number
from caudal.operators.aggregates import annual_rollup, exact
from caudal.operators.joins import anchor_dates
from caudal.operators.model import build_calendar, build_dim, build_fact, merge_dim, year_bounds
from caudal.plans.cleaning import DRY_MONTH_MM, HEAVY_RAIN_MONTH_MM

Frames = dict[str, DataFrame]

REGION = "Latin America and Caribbean"


@dataclass(frozen=True)
class FactTypes:
    """Types of the fact measures."""

    monthly: Mapping[str, str]
    annual: Mapping[str, str]
    coverage: Mapping[str, str]
    indicator: Mapping[str, str]


# The decimal contracts of the fact measures.
CONTRACT = FactTypes(
    monthly={
        "precip_total_mm": "decimal(8,2)",
        "temp_max_avg_c": "decimal(5,2)",
        "temp_min_avg_c": "decimal(5,2)",
        "et0_total_mm": "decimal(8,2)",
        "et0_avg_mm": "decimal(8,2)",
    },
    annual={
        "precip_total_mm_year": "decimal(10,2)",
        "precip_avg_mm_year": "decimal(10,2)",
        "temp_max_avg_year": "decimal(5,2)",
        "temp_min_avg_year": "decimal(5,2)",
        "et0_total_mm_year": "decimal(8,2)",
        "et0_avg_mm_year": "decimal(8,2)",
        "dry_months": "decimal(10,2)",
        "heavy_rain_months": "decimal(10,2)",
        "drought_index": "decimal(6,3)",
        "heavy_rain_index": "decimal(6,3)",
    },
    coverage={"population_total": "bigint", "coverage_pct": "decimal(5,2)"},
    indicator={"indicator_value": "decimal(18,4)"},
)


def widened(types: FactTypes, digits: int = 24) -> FactTypes:
    """The same scales with room for measures that grow with the data."""
    wide = lambda cols: {n: re.sub(r"decimal\(\d+,", f"decimal({digits},", t) for n, t in cols.items()}
    return FactTypes(wide(types.monthly), wide(types.annual), dict(types.coverage), wide(types.indicator))


WIDE = widened(CONTRACT)

# What identifies a dimension row, and its natural key.
DIMENSIONS = ("country", "province", "residence_type", "service_type", "service_level", "indicator", "date")
FACTS = ("climate_monthly", "climate_annual", "wash_coverage", "socioeconomic")
FACT_GRAIN = {
    "climate_monthly": ["province_key", "date_key"],
    "climate_annual": ["country_key", "date_key"],
    "wash_coverage": ["country_key", "residence_type_key", "service_type_key", "service_level_key", "date_key"],
    "socioeconomic": ["country_key", "indicator_key", "date_key"],
}

NATURAL_GRAIN = {
    "climate_monthly": ["country_iso3", "province_name", "year", "month"],
    "climate_annual": ["country_iso3", "year"],
    "wash_coverage": ["country_iso3", "residence_type_code", "service_type_desc", "service_level_desc", "year"],
    "socioeconomic": ["country_iso3", "indicator_code", "year"],
}


def schemas(types: FactTypes = CONTRACT) -> dict[str, str]:
    """Stored schemas. Readers pass them, so opening a table looks at no file."""
    measures = lambda cols: ", ".join(f"{n} {t}" for n, t in cols.items())
    return {
        "country": "country_key bigint, country_iso3 string, country_name string, region_name string",
        "province": "province_key bigint, country_iso3 string, province_name string",
        "residence_type": "residence_type_key bigint, residence_type_code string, residence_type_desc string",
        "service_type": "service_type_key bigint, service_type_desc string",
        "service_level": "service_level_key bigint, service_level_desc string",
        "indicator": "indicator_key bigint, indicator_code string, indicator_name string",
        "date": "date_key int, date date, year int, month int, month_name string, quarter int",
        "climate_monthly": f"climate_monthly_id string, province_key bigint, date_key int, {measures(types.monthly)}, "
                           "dry_month_flag boolean, heavy_rain_month_flag boolean, year int",
        "climate_annual": f"climate_annual_id string, country_key bigint, date_key int, {measures(types.annual)}, year int",
        "wash_coverage": "wash_coverage_id string, country_key bigint, date_key int, residence_type_key bigint, service_type_key bigint, "
                         f"service_level_key bigint, {measures(types.coverage)}, year int",
        "socioeconomic": f"socioeconomic_id string, country_key bigint, date_key int, indicator_key bigint, {measures(types.indicator)}, year int",
    }


def country_dim(coverage: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Countries of the survey. ``regions`` (country_iso3, region_name) replaces the constant region."""
    if regions is None:
        return build_dim(coverage, ["country_iso3"], "country_key", ["country_name"], {"region_name": REGION})
    dim = build_dim(coverage, ["country_iso3"], "country_key", ["country_name"])
    return dim.join(regions.select("country_iso3", "region_name"), "country_iso3", "left").select(
        "country_key", "country_iso3", "country_name", "region_name")


def residence_dim(coverage: DataFrame) -> DataFrame:
    return build_dim(coverage, ["residence_type_code"], "residence_type_key", ["residence_type_desc"])


def service_type_dim(coverage: DataFrame) -> DataFrame:
    return build_dim(coverage, ["service_type_desc"], "service_type_key")


def service_level_dim(coverage: DataFrame) -> DataFrame:
    return build_dim(coverage, ["service_level_desc"], "service_level_key")


def indicator_dim(indicators: DataFrame) -> DataFrame:
    return build_dim(indicators, ["indicator_code"], "indicator_key", ["indicator_name"])


def province_dim(climate: DataFrame) -> DataFrame:
    return build_dim(climate, ["country_iso3", "province_name"], "province_key")


def date_dim(coverage: DataFrame, climate: DataFrame) -> DataFrame:
    low, high = year_bounds([coverage, climate])
    return build_calendar(coverage.sparkSession, low, high)


def build_dims(sources: Mapping[str, DataFrame], regions: DataFrame | None = None, names: Sequence[str] = DIMENSIONS) -> Frames:
    """Dimensions from the cleaned ``coverage``, ``indicators`` and ``climate``. Only the sources of the wanted ones are opened."""
    made = {
        "country": lambda: country_dim(sources["coverage"], regions),
        "residence_type": lambda: residence_dim(sources["coverage"]),
        "service_type": lambda: service_type_dim(sources["coverage"]),
        "service_level": lambda: service_level_dim(sources["coverage"]),
        "indicator": lambda: indicator_dim(sources["indicators"]),
        "province": lambda: province_dim(sources["climate"]),
        "date": lambda: date_dim(sources["coverage"], sources["climate"]),
    }
    return {name: made[name]() for name in names}


def merge_dims(stored: Frames, sources: Frames, regions: DataFrame | None = None) -> Frames:
    """The stored dimensions with the members of some of the rows, such as those of one year. Of the other rows nothing is read."""
    coverage, climate = sources["coverage"], sources["climate"]
    dims = {
        "residence_type": merge_dim(stored["residence_type"], coverage, ["residence_type_code"], "residence_type_key", ["residence_type_desc"]),
        "service_type": merge_dim(stored["service_type"], coverage, ["service_type_desc"], "service_type_key"),
        "service_level": merge_dim(stored["service_level"], coverage, ["service_level_desc"], "service_level_key"),
        "indicator": merge_dim(stored["indicator"], sources["indicators"], ["indicator_code"], "indicator_key", ["indicator_name"]),
        "province": merge_dim(stored["province"], climate, ["country_iso3", "province_name"], "province_key"),
    }
    members = stored["country"].select("country_iso3", "country_name").unionByName(coverage.select("country_iso3", "country_name"))
    dims["country"] = country_dim(members, regions)
    low, high = year_bounds([stored["date"], coverage, climate])
    dims["date"] = build_calendar(coverage.sparkSession, low, high)
    return dims


def monthly_climate_fact(
    climate: DataFrame, dims: Frames, dry_below: Number = DRY_MONTH_MM, heavy_above: Number = HEAVY_RAIN_MONTH_MM, types: FactTypes = CONTRACT, verify: bool = True
) -> DataFrame:
    """Province and month, anchored at the last day of the month."""
    months = climate.groupBy("country_iso3", "province_name", "year", "month").agg(
        F.sum(exact("precip_total_mm")).alias("precip_total_mm"),
        F.avg(exact("temp_max_avg_c")).alias("temp_max_avg_c"),
        F.avg(exact("temp_min_avg_c")).alias("temp_min_avg_c"),
        F.sum(exact("et0_total_mm")).alias("et0_total_mm"),
        F.avg(exact("et0_avg_mm")).alias("et0_avg_mm"),
    ).withColumns({
        "dry_month_flag": below("precip_total_mm", dry_below),
        "heavy_rain_month_flag": above("precip_total_mm", heavy_above),
    })
    return build_fact(
        months,
        [(dims["province"], ["country_iso3", "province_name"], ["province_key"]),
         (anchor_dates(dims["date"], "month"), ["year", "month"], ["date_key"])],
        ["province_key", "date_key", "year", *types.monthly, "dry_month_flag", "heavy_rain_month_flag"],
        types.monthly, "climate_monthly_id", NATURAL_GRAIN["climate_monthly"], verify,
    )


def annual_climate_fact(climate: DataFrame, dims: Frames, types: FactTypes = CONTRACT, verify: bool = True) -> DataFrame:
    """Country and year, anchored at 31 December."""
    years = annual_rollup(
        climate,
        ["country_iso3", "year"],
        sums={"precip_total_mm_year": "precip_total_mm", "et0_total_mm_year": "et0_total_mm"},
        monthly_means={"precip_avg_mm_year": "precip_total_mm"},
        avgs={"temp_max_avg_year": "temp_max_avg_c", "temp_min_avg_year": "temp_min_avg_c", "et0_avg_mm_year": "et0_avg_mm"},
        flags={"dry_months": "dry_month_flag", "heavy_rain_months": "heavy_rain_month_flag"},
        flag_rates={"drought_index": "dry_month_flag", "heavy_rain_index": "heavy_rain_month_flag"},
    )
    return build_fact(
        years,
        [(dims["country"], "country_iso3", ["country_key"]), (anchor_dates(dims["date"]), "year", ["date_key"])],
        ["country_key", "date_key", "year", *types.annual],
        types.annual, "climate_annual_id", NATURAL_GRAIN["climate_annual"], verify,
    )


def coverage_fact(coverage: DataFrame, dims: Frames, types: FactTypes = CONTRACT, verify: bool = True) -> DataFrame:
    """Country, year, residence, service and level, anchored at 31 December."""
    return build_fact(
        coverage,
        [(dims["country"], "country_iso3", ["country_key"]),
         (dims["residence_type"], "residence_type_code", ["residence_type_key"]),
         (dims["service_type"], "service_type_desc", ["service_type_key"]),
         (dims["service_level"], "service_level_desc", ["service_level_key"]),
         (anchor_dates(dims["date"]), "year", ["date_key"])],
        ["country_key", "date_key", "year", "residence_type_key", "service_type_key", "service_level_key", *types.coverage],
        types.coverage, "wash_coverage_id", NATURAL_GRAIN["wash_coverage"], verify,
    )


def socioeconomic_fact(indicators: DataFrame, dims: Frames, types: FactTypes = CONTRACT, verify: bool = True) -> DataFrame:
    """Country, year and indicator, anchored at 31 December."""
    return build_fact(
        indicators,
        [(dims["country"], "country_iso3", ["country_key"]),
         (dims["indicator"], "indicator_code", ["indicator_key"]),
         (anchor_dates(dims["date"]), "year", ["date_key"])],
        ["country_key", "date_key", "year", "indicator_key", *types.indicator],
        types.indicator, "socioeconomic_id", NATURAL_GRAIN["socioeconomic"], verify,
    )


def build_facts(
    sources: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], dry_below: Number = DRY_MONTH_MM, heavy_above: Number = HEAVY_RAIN_MONTH_MM,
    types: FactTypes = CONTRACT, verify: bool = True, names: Sequence[str] = FACTS,
) -> Frames:
    """Facts of the cleaned tables. Only the sources and dimensions of the wanted ones are opened."""
    made = {
        "climate_monthly": lambda: monthly_climate_fact(sources["climate"], dims, dry_below, heavy_above, types, verify),
        "climate_annual": lambda: annual_climate_fact(sources["climate"], dims, types, verify),
        "wash_coverage": lambda: coverage_fact(sources["coverage"], dims, types, verify),
        "socioeconomic": lambda: socioeconomic_fact(sources["indicators"], dims, types, verify),
    }
    return {name: made[name]() for name in names}
