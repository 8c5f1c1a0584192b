"""From landed sources to cleaned tables: one explicit function per dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from caudal.functions.bands import above, below
from caudal.functions.numeric import Number
from caudal.operators.aggregates import monthly_rollup
from caudal.operators.filters import Audit, counted, keep_in, keep_known, non_negative_or_null
from caudal.operators.projection import conform
from caudal.operators.quality import dq_report, duplicate_rows, fill_by_type, full_report, negatives, nulls
from caudal.plans.contracts import CLIMATE_DAILY, INDICATORS, coverage_contract

RESIDENCES = ("total", "urban", "rural")
DRY_MONTH_MM = 10
HEAVY_RAIN_MONTH_MM = 150


def clean_coverage(
    landed: DataFrame, residences: Sequence[str] = RESIDENCES, residence_codes: dict[str, str] | None = None, audit: Audit | None = None
) -> DataFrame:
    """Typed coverage rows without negative measures, foreign residence types or copies.

    Unknown measures count as zero and unknown texts as UNKNOWN. Copies go last, so
    rows that only differed in an unknown value fall together.
    """
    typed = counted(conform(landed, coverage_contract(residence_codes)), audit, "coverage", "landed")
    valid = counted(non_negative_or_null(typed, ["coverage_pct", "population_total"]), audit, "coverage", "not negative")
    valid = counted(keep_in(valid, residence_type_desc=residences), audit, "coverage", "known residence type")
    return counted(fill_by_type(valid).distinct(), audit, "coverage", "no copies")


def clean_indicators(landed: DataFrame, audit: Audit | None = None) -> DataFrame:
    """Typed indicator rows with a known value."""
    typed = counted(conform(landed, INDICATORS), audit, "indicators", "landed")
    return counted(keep_known(typed, ["indicator_value"]), audit, "indicators", "known value")


def clean_climate(
    daily: DataFrame, dry_below: Number = DRY_MONTH_MM, heavy_above: Number = HEAVY_RAIN_MONTH_MM, digits: int | None = 2, audit: Audit | None = None
) -> DataFrame:
    """Daily climate to one row per province and month with dry and heavy-rain flags."""
    typed = counted(conform(daily, CLIMATE_DAILY), audit, "climate", "landed")
    dated = counted(keep_known(typed, ["year", "month"]), audit, "climate", "known month")
    return monthly_climate(dated, ("country_iso3", "province_name"), dry_below, heavy_above, digits)


def monthly_climate(
    daily: DataFrame, place: Sequence[str], dry_below: Number = DRY_MONTH_MM, heavy_above: Number = HEAVY_RAIN_MONTH_MM,
    digits: int | None = 2,
) -> DataFrame:
    """The same by any columns that identify a place.

    Place names that come from a lookup are cheaper to attach to the monthly rows
    afterwards, and a place with most of the days is then already reduced. A month has
    few days of a place and they come in any order, so the rows themselves are dealt out:
    sums begun before that would take a task more memory than its rows, and more to shuffle.
    """
    months = [*place, "year", "month"]
    monthly = monthly_rollup(
        keep_known(daily, ["year", "month"]).repartition(*months),
        months,
        sums={"precip_total_mm": "precipitation_sum", "et0_total_mm": "et0_fao_evapotranspiration"},
        avgs={"temp_max_avg_c": "temperature_2m_max", "temp_min_avg_c": "temperature_2m_min", "et0_avg_mm": "et0_fao_evapotranspiration"},
        digits=digits,
    )
    return monthly.withColumns({
        "dry_month_flag": below("precip_total_mm", dry_below),
        "heavy_rain_month_flag": above("precip_total_mm", heavy_above),
    })


def coverage_report(landed: DataFrame, residence_codes: dict[str, str] | None = None) -> DataFrame:
    """What is wrong with landed coverage rows once typed: unknown, negative and repeated."""
    contract = coverage_contract(residence_codes)
    typed = conform(landed, contract)
    checks = nulls(contract.columns) + negatives(["coverage_pct", "population_total"])
    return full_report([dq_report(typed, checks), duplicate_rows(typed)])


def climate_report(daily: DataFrame) -> DataFrame:
    return dq_report(conform(daily, CLIMATE_DAILY), nulls(["year", "month", "temperature_2m_max"]))


def indicator_report(landed: DataFrame) -> DataFrame:
    return dq_report(conform(landed, INDICATORS), nulls(["indicator_value"]) + negatives(["indicator_value"]))
