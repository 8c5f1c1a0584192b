"""Contracts of the landed sources and of the cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.functions.text import RESIDENCE_CODES, UNKNOWN_RESIDENCE, code_of
from caudal.operators.projection import Contract, Field

# Column names and types of the landed coverage survey.
COVERAGE_LANDED = Contract("coverage_landed", (
    Field("ISO3", "string", description="ISO 3166-1 alpha-3 country code"),
    Field("Country", "string", description="country name"),
    Field("Residence Type", "string", description="total, urban or rural"),
    Field("Service Type", "string", description="drinking water, sanitation or hygiene"),
    Field("Year", "bigint", description="survey year"),
    Field("Coverage", "double", description="percentage of the population"),
    Field("Population", "double", description="population the row covers"),
    Field("Service level", "string", description="service ladder level"),
))

# Column names and types of the landed indicators.
INDICATORS_LANDED = Contract("indicators_landed", (
    Field("country_code", "string", description="ISO 3166-1 alpha-3 country code"),
    Field("country_name", "string", description="country name"),
    Field("indicator_code", "string", description="indicator code"),
    Field("indicator_name", "string", description="indicator name"),
    Field("date", "bigint", description="year of the observation"),
    Field("value", "double", description="observed value"),
    Field("unit", "string", description="unit of the value"),
    Field("obs_status", "string", description="observation status"),
    Field("decimal", "bigint", description="published decimals"),
))

# Column names and types of the landed daily climate.
CLIMATE_LANDED = Contract("climate_landed", (
    Field("province", "string", description="province or state"),
    Field("date", "bigint", description="day, microseconds since the epoch"),
    Field("temperature_2m_max", "double", description="daily maximum temperature"),
    Field("temperature_2m_min", "double", description="daily minimum temperature"),
    Field("precipitation_sum", "double", description="daily rain"),
    Field("et0_fao_evapotranspiration", "double", description="daily evapotranspiration"),
))


def coverage_contract(residence_codes: dict[str, str] | None = None) -> Contract:
    """Cleaned coverage survey. Built on demand: its expressions need a Spark session."""
    residence = F.lower(F.col("Residence Type"))
    code = code_of(residence, residence_codes or RESIDENCE_CODES, UNKNOWN_RESIDENCE)
    return Contract("coverage", (
        Field("country_iso3", "string", "ISO3", description="country code, joins all sources"),
        Field("country_name", "string", "Country", description="country name"),
        Field("year", "int", "Year", description="survey year"),
        Field("residence_type_code", "string", code, description="code of the residence type"),
        Field("residence_type_desc", "string", residence, description="residence type, lower case"),
        Field("service_type_desc", "string", F.lower(F.col("Service Type")), description="service, lower case"),
        Field("service_level_desc", "string", F.lower(F.col("Service level")), description="ladder level, lower case"),
        Field("coverage_pct", "decimal(5,2)", "Coverage", description="percentage of the population"),
        Field("population_total", "bigint", "Population", description="population the row covers"),
    ))


INDICATORS = Contract("indicators", (
    Field("country_iso3", "string", "country_code", description="country code, joins all sources"),
    Field("year", "int", "date", description="year of the observation"),
    Field("indicator_code", "string", description="indicator code"),
    Field("indicator_name", "string", description="indicator name"),
    Field("indicator_value", "double", "value", description="observed value"),
))

CLIMATE_DAILY = Contract("climate_daily", (
    Field("country_iso3", "string", description="country code, taken from the landing folder"),
    Field("province_name", "string", "province", required=False, default="Unknown", description="province or state"),
    Field("year", "int", description="year of the day"),
    Field("month", "int", description="month of the day"),
    Field("temperature_2m_max", "double", required=False, default=0.0, description="daily maximum temperature"),
    Field("temperature_2m_min", "double", required=False, default=0.0, description="daily minimum temperature"),
    Field("precipitation_sum", "double", description="daily rain"),
    Field("et0_fao_evapotranspiration", "double", description="daily evapotranspiration"),
))

CLIMATE_MONTHLY = Contract("climate_monthly", (
    Field("country_iso3", "string", description="country code"),
    Field("province_name", "string", description="province or state"),
    Field("year", "int", description="year"),
    Field("month", "int", description="month"),
    Field("precip_total_mm", "double", description="rain of the month"),
    Field("temp_max_avg_c", "double", description="mean daily maximum"),
    Field("temp_min_avg_c", "double", description="mean daily minimum"),
    Field("et0_total_mm", "double", description="evapotranspiration of the month"),
    Field("et0_avg_mm", "double", description="mean daily evapotranspiration"),
    Field("dry_month_flag", "boolean", description="rain below the dry threshold"),
    Field("heavy_rain_month_flag", "boolean", description="rain above the heavy-rain threshold"),
))
