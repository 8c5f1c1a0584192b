"""The numbers behind the dashboards, one frame per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.bands import (
    CLIMATE_STATUS, RISK_LABELS, SANITATION_STATUS, TRAFFIC_ES, TRAFFIC_ES_LONG, correlation_direction, correlation_risk,
    correlation_strength, flag_label, gap_trend, index_risk, quadrant, signed_band, zone_count_risk, zone_status,
)
from caudal.functions.numeric import Number, clip, one_in_n
from caudal.functions.text import joined_label, label_of
from caudal.operators.aggregates import constant_in_group, distribution, first_last_change, mean_by, rollup_total, status_counts
from caudal.operators.filters import drop_incomplete, earliest, latest, positive
from caudal.operators.windows import rank_by, top_1, top_k, yoy_delta

ZONE = ("country_name", "residence_type_desc")


def zone_summary(kpi1: DataFrame) -> DataFrame:
    """One row per zone with its correlation, labels and wording."""
    cols = ["corr_precip_vs_water", "corr_abs_value", "risk_level", "impact_direction", "years_observed"]
    zones = constant_in_group(kpi1, ZONE, cols)
    return zones.withColumns({
        "area": joined_label(ZONE),
        "risk_label": label_of("risk_level", RISK_LABELS),
        "strength": correlation_strength("corr_precip_vs_water"),
        "direction": correlation_direction("corr_precip_vs_water"),
    })


def change_patterns(kpi1: DataFrame) -> DataFrame:
    """How rain and water moved together in each year."""
    return kpi1.withColumn("pattern", quadrant("delta_precip_mm", "delta_safe_water_pp"))


def most_sensitive_zones(kpi1: DataFrame, k: int = 3) -> DataFrame:
    return top_k(zone_summary(kpi1), "corr_abs_value", k, tie_break=ZONE)


def mobility_by_year(kpi2: DataFrame) -> DataFrame:
    """Zones, mean share and number of zones per risk, for every year."""
    counts = status_counts(kpi2, ["year"], "risk_level", {"n_red": "red", "n_yellow": "yellow"}, ZONE)
    return counts.join(mean_by(kpi2, ["year"], "pct_over_30min", "avg_pct"), "year")


def mobility_ranking(kpi2: DataFrame) -> DataFrame:
    """Zones with any forced mobility, ranked within the year, as '1 in N people'."""
    ranked = rank_by(positive(kpi2, "pct_over_30min"), "pct_over_30min", "place", ["year"])
    return ranked.withColumns({"country_zone": joined_label(ZONE), "one_in_n": one_in_n("pct_over_30min")})


def worst_zone(kpi2: DataFrame) -> DataFrame:
    return top_1(kpi2, "pct_over_30min", ["year"], [*ZONE, "pct_over_30min"])


def zone_map(kpi3: DataFrame) -> DataFrame:
    """Status of each province: map colour and the two plain labels."""
    return kpi3.withColumns({
        "zone_status": zone_status("is_critical_zone", "is_low_sanitation", "is_climate_neg_trend"),
        "sanitation_status": flag_label("is_low_sanitation", SANITATION_STATUS),
        "climate_status": flag_label("is_climate_neg_trend", CLIMATE_STATUS),
    })


def critical_zone_counts(kpi3: DataFrame) -> DataFrame:
    """Critical zones per country and year, with a traffic light."""
    counts = kpi3.groupBy("country_name", "year").agg(
        F.count_if("is_critical_zone").alias("n_critical_zones"),
        F.count_distinct("province_name").alias("n_zones"),
    )
    return counts.withColumn("zone_risk", zone_count_risk("n_critical_zones"))


def index_for_display(kpi4: DataFrame, edges: Sequence[Number] = (20, 40)) -> DataFrame:
    """Index clipped to 0-100 with its long label."""
    clipped = kpi4.withColumn("health_risk_index", clip(F.col("health_risk_index").cast("double"), 0.0, 100.0))
    return clipped.withColumn("risk_level", index_risk("health_risk_index", edges, TRAFFIC_ES_LONG, None))


def index_change(kpi4: DataFrame, eps: Number = 1.0) -> DataFrame:
    return first_last_change(kpi4.withColumn("index", F.col("health_risk_index").cast("double")), ["country_name"], "year", "index", eps)


def gap_history(gaps: DataFrame, gap_col: str) -> DataFrame:
    """Yearly change of a gap per country and whether it closes."""
    history = yoy_delta(gaps, ["country_name"], "year", {gap_col: "delta_gap"}, drop_first=False)
    return history.withColumn("gap_trend", gap_trend("delta_gap"))


def widest_gap(gaps: DataFrame, gap_col: str, sides: Sequence[str]) -> DataFrame:
    """Per year: mean absolute gap, and the country where it is widest."""
    complete = drop_incomplete(gaps, "any", [*sides, gap_col])
    means = mean_by(complete, ["year"], gap_col, "avg_abs_gap", absolute=True)
    return means.join(top_1(complete, gap_col, ["year"], ["country_name", gap_col, "risk_level"], absolute=True), "year")


def regional_change(gaps: DataFrame, gap_col: str, eps: Number = 1.0, absolute: bool = True) -> DataFrame:
    """Mean gap of the first and of the last year, and whether the difference matters."""
    first = mean_by(earliest(gaps), [], gap_col, "first_value", absolute)
    last = mean_by(latest(gaps), [], gap_col, "last_value", absolute)
    ends = last.withColumn("first_value", first.scalar())
    change = (F.col("last_value") - F.col("first_value")).cast("double")
    return ends.select(
        F.col("first_value").cast("double").alias("first_value"), F.col("last_value").cast("double").alias("last_value"),
        change.alias("change"), signed_band(change, eps, ("decreased", "stable", "increased")).alias("direction"),
    )


def risk_shares(gaps: DataFrame) -> DataFrame:
    """Countries per risk level in the latest year, red first."""
    return distribution(latest(gaps), "risk_level", ("Rojo", "Amarillo", "Verde"))


def income_regions(kpi6: DataFrame) -> DataFrame:
    """Correlation per region over all years and a regional total over the yearly rows."""
    r: Column = F.avg(F.col("corr_water_vs_gdp").cast("double"))
    rolled = rollup_total(kpi6, "region_name", {
        "n_countries": F.max("n_countries"),
        "correlation_coefficient": r,
        "avg_safe_water_pct": F.avg(F.col("avg_safe_water_pct").cast("double")),
        "avg_gdp_per_capita": F.avg(F.col("avg_gdp_per_capita").cast("double")),
    })
    return rolled.withColumns({
        "corr_abs_value": F.abs("correlation_coefficient"),
        "risk_level": correlation_risk("correlation_coefficient", TRAFFIC_ES, "Verde"),
    })


def income_strength_change(kpi6: DataFrame, eps: Number = 0.1) -> DataFrame:
    """Did the relation of a region become stronger? First against last year."""
    strength = kpi6.withColumn("strength", F.col("corr_abs_value").cast("double"))
    return first_last_change(strength, ["region_name"], "year", "strength", eps, ("weaker", "stable", "stronger"))
