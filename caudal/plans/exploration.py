"""Exploratory series on the cleaned tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from caudal.operators.aggregates import pivot_values, share_of_levels, weighted_population
from caudal.operators.filters import keep_in
from caudal.operators.joins import attach
from caudal.plans.kpis import LIMITED, OPEN_DEFECATION, SAFE, SANITATION, TOTAL, UNIMPROVED, WATER

KEYS = ("country_iso3", "year")


def analysis_base(coverage: DataFrame, indicators: DataFrame, climate_yearly: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Coverage rows with the indicators as columns and the yearly climate: two left joins."""
    wide = pivot_values(indicators, KEYS, "indicator_code", names, "indicator_value", agg="avg")
    return attach(attach(coverage, wide, KEYS), climate_yearly, KEYS)


def safe_water_trend(coverage: DataFrame, service: str = WATER, level: str = SAFE, residence: str = TOTAL, out: str = "safe_water_pct") -> DataFrame:
    rows = keep_in(coverage, service_type_desc=[service], service_level_desc=[level], residence_type_desc=[residence])
    return rows.select(*KEYS, rows["coverage_pct"].alias(out))


def limited_water_population(coverage: DataFrame, service: str = WATER, level: str = LIMITED, out: str = "limited_water_population") -> DataFrame:
    rows = keep_in(coverage, service_type_desc=[service], service_level_desc=[level])
    return weighted_population(rows, KEYS, "population_total", "coverage_pct", out)


def high_risk_sanitation(coverage: DataFrame, service: str = SANITATION, levels: Sequence[str] = (LIMITED, UNIMPROVED, OPEN_DEFECATION), out: str = "high_risk_pct") -> DataFrame:
    rows = keep_in(coverage, service_type_desc=[service])
    return share_of_levels(rows, KEYS, "coverage_pct", "service_level_desc", levels, out=out)


def distinct_series(base: DataFrame, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The distinct rows of some columns, in order."""
    return base.select(*cols).distinct().orderBy(*order)
