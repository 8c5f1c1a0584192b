"""The seven indicators, each a plan over the star schema.

A model is a dict of DataFrames named as in ``caudal.plans.star``. Filters name
services, levels and residences by description; surrogate keys never occur in a rule.
Every function returns one lazy plan and runs no action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.bands import correlation_risk, gap_risk, impact_direction, index_risk, level_risk, yearly_trend, TRAFFIC_ES
from caudal.functions.dates import year_of_key
from caudal.functions.numeric import Number, complement, gap, minmax_norm, safe_corr, weighted_index
from caudal.functions.text import clean_text, stable_key
from caudal.operators.aggregates import conditional_sum, pivot_values, trend_class
from caudal.operators.filters import clip_to_range, drop_incomplete, groups_of_at_least, keep_matching
from caudal.operators.joins import attach, match_series, with_group_stats
from caudal.operators.projection import with_exact_types
from caudal.operators.windows import yoy_delta

Model = Mapping[str, DataFrame]

# Descriptions in the survey, lower case.
WATER = "drinking water"
SANITATION = "sanitation"
AT_LEAST_BASIC = "at least basic"
BASIC = "basic service"
SAFE = "safely managed service"
LIMITED = "limited service"
UNIMPROVED = "unimproved"
OPEN_DEFECATION = "open defecation"
URBAN, RURAL, TOTAL = "urban", "rural", "total"

# Indicator codes.
POPULATION = "SP.POP.TOTL"
CHILD_MORTALITY = "SH.DYN.MORT"
POVERTY = "SI.POV.DDAY"
GDP_PER_CAPITA = "NY.GDP.PCAP.CD"


@dataclass(frozen=True)
class Pick:
    """Which coverage rows an indicator looks at. ``None`` leaves a side free."""

    service: str | None
    levels: Sequence[str] | None = None
    residences: Sequence[str] | None = (TOTAL,)
    countries: Sequence[str] | None = None


def with_year(fact: DataFrame) -> DataFrame:
    """The year of a fact row: its layout column, or derived from ``date_key``."""
    return fact if "year" in fact.columns else fact.withColumn("year", year_of_key("date_key"))


def with_keys_of(model: Model, rows: DataFrame, dim: str, natural_key: str, wanted: Sequence[str] | None) -> DataFrame:
    """Fact rows of some dimension members; ``None`` keeps all.

    A model that says its keys are stable lets the keys be written as literals, which
    reach the scan and skip row groups of facts sorted by them. Any other model is
    narrowed by a semi-join with the dimension.
    """
    key = f"{dim}_key"
    if wanted is None:
        return rows
    if getattr(model, "stable_keys", False):
        return rows.where(F.col(key).isin([stable_key(F.lit(w)) for w in wanted]))
    return keep_matching(rows, model[dim].where(F.col(natural_key).isin(list(wanted))), key)


def coverage_rows(model: Model, pick: Pick) -> DataFrame:
    """Coverage facts of a pick."""
    rows = with_year(model["wash_coverage"])
    rows = with_keys_of(model, rows, "service_type", "service_type_desc", None if pick.service is None else [pick.service])
    rows = with_keys_of(model, rows, "service_level", "service_level_desc", pick.levels)
    rows = with_keys_of(model, rows, "country", "country_iso3", pick.countries)
    if pick.residences is not None:
        # keyed by code, picked by description
        rows = keep_matching(rows, model["residence_type"].where(clean_text("residence_type_desc").isin(list(pick.residences))), "residence_type_key")
    return rows


def coverage_by(model: Model, pick: Pick, keys: Sequence[str], out: str, agg: str = "sum") -> DataFrame:
    rows = coverage_rows(model, pick).where(F.col("coverage_pct").isNotNull())
    return rows.groupBy(*keys).agg(getattr(F, agg)(F.col("coverage_pct").cast("decimal(10,4)")).alias(out))


def name_country(model: Model, df: DataFrame, how: str, *cols: str) -> DataFrame:
    return attach(df, model["country"], "country_key", cols or ("country_name",), how)


def indicator_values(model: Model, codes: Sequence[str]) -> DataFrame:
    """Yearly values of some indicators with their codes."""
    wanted = model["indicator"].where(F.col("indicator_code").isin(list(codes)))
    rows = with_year(model["socioeconomic"])
    if getattr(model, "stable_keys", False):
        rows = with_keys_of(model, rows, "indicator", "indicator_code", codes)
    rows = attach(rows, wanted, "indicator_key", ["indicator_code"], "inner")
    return rows.select("country_key", "year", "indicator_code", "indicator_value")


SERIES = ("country_key", "residence_type_key")


@dataclass(frozen=True)
class ClimateWater:
    pick: Pick = Pick(WATER, (AT_LEAST_BASIC,), (URBAN, RURAL), ("MEX", "ARG"))


def kpi_01(model: Model, params: ClimateWater = ClimateWater()) -> DataFrame:
    """Does safe-water access move with rain? Yearly changes per country and residence type,
    their correlation, and how strong and in which direction it is."""
    water = coverage_by(model, params.pick, [*SERIES, "year"], "safe_water_pct", "max")
    water = water.withColumn("safe_water_pct", F.col("safe_water_pct").cast("double"))
    rain = with_year(model["climate_annual"]).select(
        "country_key", "year", F.col("precip_total_mm_year").cast("double").alias("precip_total_mm_year"))
    changes = yoy_delta(
        match_series(rain, water, ["country_key", "year"]), SERIES, "year",
        {"precip_total_mm_year": "delta_precip_mm", "safe_water_pct": "delta_safe_water_pp"},
    )
    related = with_group_stats(changes, SERIES, {
        "years_observed": F.count(F.lit(1)),
        "corr_precip_vs_water": safe_corr("delta_precip_mm", "delta_safe_water_pp"),
    })
    named = attach(name_country(model, related, "left"), model["residence_type"], "residence_type_key", ["residence_type_desc"])
    return named.select(
        "country_key", "country_name", "residence_type_key", "residence_type_desc", "year",
        "precip_total_mm_year", "delta_precip_mm", "safe_water_pct", "delta_safe_water_pp",
        "years_observed", "corr_precip_vs_water",
        F.abs("corr_precip_vs_water").alias("corr_abs_value"),
        correlation_risk("corr_precip_vs_water").alias("risk_level"),
        impact_direction("corr_precip_vs_water").alias("impact_direction"),
    )


@dataclass(frozen=True)
class WaterMobility:
    pick: Pick = Pick(WATER, (LIMITED,), (URBAN, RURAL))
    trend_limit: Number = 0.5
    level_edges: Sequence[Number] = (5, 20)


def kpi_02(model: Model, params: WaterMobility = WaterMobility()) -> DataFrame:
    """Share of people more than 30 minutes from water, its yearly trend and risk."""
    share = coverage_by(model, params.pick, [*SERIES, "year"], "pct_over_30min", "max")
    share = share.withColumn("pct_over_30min", F.col("pct_over_30min").cast("double"))
    changes = yoy_delta(share, SERIES, "year", {"pct_over_30min": "delta_pct_over_30min_pp"})
    named = attach(name_country(model, changes, "left"), model["residence_type"], "residence_type_key", ["residence_type_desc"])
    return named.select(
        "country_key", "country_name", "residence_type_key", "residence_type_desc", "year",
        "pct_over_30min", "delta_pct_over_30min_pp",
        yearly_trend("delta_pct_over_30min_pp", params.trend_limit).alias("mobility_trend"),
        level_risk("pct_over_30min", params.level_edges).alias("risk_level"),
    )


@dataclass(frozen=True)
class CriticalZones:
    pick: Pick = Pick(SANITATION, None, (URBAN,), ("MEX", "ARG"))
    bad_levels: Sequence[str] = (LIMITED, UNIMPROVED, OPEN_DEFECATION)
    adequate_pct: Number = 80.0
    min_years: int = 3
    decreasing: Number = -0.3
    increasing: Number = 0.3


def kpi_03(model: Model, params: CriticalZones = CriticalZones()) -> DataFrame:
    """Provinces where sanitation is low and rain is falling.

    Sanitation is known per country only, so each province takes its country's value.
    """
    levels = model["service_level"].select("service_level_key", clean_text("service_level_desc").isin(list(params.bad_levels)).alias("is_bad"))
    rows = attach(coverage_rows(model, params.pick), levels, "service_level_key", ["is_bad"])
    sanitation = conditional_sum(rows, ["country_key", "year"], "coverage_pct", {"bad": F.col("is_bad")}, missing=0)
    # subtracted as decimals: a country exactly at the threshold must not depend on float error
    sanitation = sanitation.withColumn("sanitation_basic_pct", (F.lit(100) - F.col("bad")).cast("double"))
    sanitation = sanitation.select("country_key", "year", "sanitation_basic_pct",
                                   (F.col("sanitation_basic_pct") < params.adequate_pct).alias("is_low_sanitation"))

    countries = model["country"]
    if params.pick.countries is not None:
        countries = countries.where(F.col("country_iso3").isin(list(params.pick.countries)))
    zones = attach(model["province"], countries, "country_iso3", ["country_key", "country_name"], "inner")
    rain = clip_to_range(with_year(model["climate_monthly"]), sanitation, "year")
    yearly = keep_matching(rain, zones, "province_key").groupBy("province_key", "year").agg(
        F.sum("precip_total_mm").cast("double").alias("precip_total_mm_year"))
    trend = trend_class(yearly, ["province_key"], "year", "precip_total_mm_year", params.min_years, params.decreasing, params.increasing)
    trend = trend.select("province_key", F.col("trend").alias("climate_trend"), (F.col("trend") == "decreasing").alias("is_climate_neg_trend"))
    placed = attach(attach(yearly, trend, "province_key"), zones, "province_key", ["province_name", "country_key", "country_name"], "inner")
    both = placed.join(sanitation, ["country_key", "year"]).where(F.col("sanitation_basic_pct").isNotNull())
    return both.select(
        "country_key", "country_name", "province_key", "province_name", "year", "sanitation_basic_pct", "is_low_sanitation",
        "precip_total_mm_year", "climate_trend", "is_climate_neg_trend",
        (F.col("is_low_sanitation") & F.col("is_climate_neg_trend")).alias("is_critical_zone"),
    )


@dataclass(frozen=True)
class HealthRisk:
    """Weights, limits and edges of the index."""

    pick: Pick = Pick(SANITATION, (BASIC, SAFE))
    mortality: str = CHILD_MORTALITY
    poverty: str = POVERTY
    population: str = POPULATION
    weights: Mapping[str, Number] = field(default_factory=lambda: {"sanitation": 0.5, "mortality": 0.3, "poverty": 0.2})
    limits: Mapping[str, tuple[Number, Number]] = field(
        default_factory=lambda: {"sanitation": (0, 100), "mortality": (0, 150), "poverty": (0, 100)})
    types: Mapping[str, str] = field(default_factory=lambda: {
        "child_mortality_rate": "decimal(8,3)", "poverty_rate": "decimal(5,2)", "population_total": "bigint"})
    edges: Sequence[Number] = (20, 40)
    digits: int | None = 3


def kpi_04(model: Model, params: HealthRisk = HealthRisk()) -> DataFrame:
    """Weighted health-risk index from 0 to 100: lacking sanitation, child mortality, poverty.

    An unknown term adds no risk; the row stays.
    """
    covered = coverage_by(model, params.pick, ["country_key", "year"], "sanitation_coverage_pct")
    names = {params.mortality: "child_mortality_rate", params.poverty: "poverty_rate", params.population: "population_total"}
    values = pivot_values(indicator_values(model, list(names)), ["country_key", "year"], "indicator_code", names, "indicator_value")
    both = match_series(covered, with_exact_types(values, params.types), ["country_key", "year"])
    sources = {"sanitation": complement("sanitation_coverage_pct"), "mortality": F.col("child_mortality_rate"), "poverty": F.col("poverty_rate")}
    terms = {name: minmax_norm(sources[name], *params.limits[name]) for name in params.weights}
    scored = both.withColumn("health_risk_index", weighted_index(terms, params.weights, digits=params.digits))
    return name_country(model, scored, "inner").select(
        "country_key", "country_name", F.col("year").cast("int").alias("year"),
        F.col("sanitation_coverage_pct").cast("decimal(5,2)").alias("sanitation_coverage_pct"),
        "child_mortality_rate", "poverty_rate", "population_total",
        F.col("health_risk_index").cast("decimal(6,3)").alias("health_risk_index"),
        index_risk("health_risk_index", params.edges).alias("risk_level"),
    )


@dataclass(frozen=True)
class UrbanRuralGap:
    pick: Pick = Pick(WATER, (BASIC, SAFE), (URBAN, RURAL))
    edges: Sequence[Number] = (10, 20)
    missing: str = "zero"


def kpi_05(model: Model, params: UrbanRuralGap = UrbanRuralGap()) -> DataFrame:
    """Gap in safe water between two residence types (urban minus rural).

    A missing side counts as zero by default; ``missing='null'`` leaves the gap open.
    """
    urban, rural = params.pick.residences
    share = coverage_by(model, params.pick, ["country_key", "year", "residence_type_key"], "pct")
    share = attach(share, model["residence_type"], "residence_type_key", ["residence_type_desc"], "inner")
    share = share.withColumn("side", clean_text("residence_type_desc"))
    wide = pivot_values(share, ["country_key", "year"], "side", {urban: "water_urban_pct", rural: "water_rural_pct"}, "pct")
    wide = drop_incomplete(wide, "all", ["water_urban_pct", "water_rural_pct"])
    wide = wide.withColumn("gap", gap("water_urban_pct", "water_rural_pct", params.missing))
    return name_country(model, wide, "inner").select(
        "country_key", "country_name", F.col("year").cast("int").alias("year"),
        F.col("water_urban_pct").cast("decimal(5,2)").alias("water_urban_pct"),
        F.col("water_rural_pct").cast("decimal(5,2)").alias("water_rural_pct"),
        F.col("gap").cast("decimal(6,3)").alias("gap_urban_rural_pp"),
        gap_risk("gap", params.edges).alias("risk_level"),
    )


@dataclass(frozen=True)
class WaterGdp:
    pick: Pick = Pick(WATER, (BASIC, SAFE))
    indicator: str = GDP_PER_CAPITA
    min_countries: int = 2
    unknown_label: str | None = "Verde"


def kpi_06(model: Model, params: WaterGdp = WaterGdp()) -> DataFrame:
    """Correlation of safe water and income across the countries of a region, per year."""
    water = coverage_by(model, params.pick, ["country_key", "year"], "water")
    income = indicator_values(model, [params.indicator]).select(
        "country_key", "year", F.col("indicator_value").cast("decimal(18,2)").alias("gdp"))
    both = drop_incomplete(match_series(water, income, ["country_key", "year"]), "any", ["water", "gdp"])
    stats = name_country(model, both, "inner", "region_name").groupBy("region_name", "year").agg(
        F.count_distinct("country_key").alias("n_countries"),
        safe_corr("water", "gdp").alias("corr"),
        F.avg("water").alias("avg_water"),
        F.avg("gdp").alias("avg_gdp"),
    )
    return groups_of_at_least(stats, "n_countries", params.min_countries).select(
        "region_name", F.col("year").cast("int").alias("year"), F.col("n_countries").cast("int").alias("n_countries"),
        F.col("corr").cast("decimal(6,3)").alias("corr_water_vs_gdp"),
        F.abs("corr").cast("decimal(6,3)").alias("corr_abs_value"),
        F.col("avg_water").cast("decimal(5,2)").alias("avg_safe_water_pct"),
        F.col("avg_gdp").cast("decimal(18,2)").alias("avg_gdp_per_capita"),
        correlation_risk("corr", TRAFFIC_ES, params.unknown_label).alias("risk_level"),
    )


@dataclass(frozen=True)
class WaterSanitationGap:
    water: Pick = Pick(WATER, (BASIC, SAFE))
    sanitation: Pick = Pick(SANITATION, (BASIC, SAFE))
    edges: Sequence[Number] = (10, 15)


def kpi_07(model: Model, params: WaterSanitationGap = WaterSanitationGap()) -> DataFrame:
    """Gap between safe water and safe sanitation, both from one scan of the coverage fact."""
    rows = coverage_rows(model, Pick(None, None, params.water.residences, params.water.countries))
    rows = with_keys_of(model, rows, "service_type", "service_type_desc", [params.water.service, params.sanitation.service])
    rows = with_keys_of(model, rows, "service_level", "service_level_desc", [*params.water.levels, *params.sanitation.levels])
    rows = attach(rows, model["service_type"], "service_type_key", ["service_type_desc"])
    rows = attach(rows, model["service_level"], "service_level_key", ["service_level_desc"])
    side = lambda p: (clean_text("service_type_desc") == p.service) & clean_text("service_level_desc").isin(list(p.levels))
    rows = rows.withColumn("pct", F.col("coverage_pct").cast("decimal(10,4)")).where(side(params.water) | side(params.sanitation))
    sums = conditional_sum(rows, ["country_key", "year"], "pct", {"water": side(params.water), "sanitation": side(params.sanitation)})
    both = drop_incomplete(sums, "any", ["water", "sanitation"]).withColumn("gap", gap("water", "sanitation", "null"))
    return name_country(model, both, "inner").select(
        "country_key", "country_name", F.col("year").cast("int").alias("year"),
        F.col("water").cast("decimal(5,2)").alias("water_basic_safe_pct"),
        F.col("sanitation").cast("decimal(5,2)").alias("sanitation_basic_safe_pct"),
        F.col("gap").cast("decimal(6,3)").alias("gap_water_sanitation_pp"),
        gap_risk("gap", params.edges).alias("risk_level"),
    )


KPIS = {
    "kpi_01": kpi_01, "kpi_02": kpi_02, "kpi_03": kpi_03, "kpi_04": kpi_04,
    "kpi_05": kpi_05, "kpi_06": kpi_06, "kpi_07": kpi_07,
}
REQUIRED_TABLES = ("country", "province", "residence_type", "service_type", "service_level", "indicator",
                   "climate_monthly", "climate_annual", "wash_coverage", "socioeconomic")
