"""Indicators, their summaries and the exploratory series."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from caudal.operators.projection import serve
from caudal.operators.aggregates import pivot_values
from caudal.operators.windows import rank_by, scale_to_max, top_k
from caudal.plans import exploration, kpis, registry, summaries
from caudal.plans.refresh import read_gold
from workload import bindings, lake
from workload.bindings import PARAMS
from workload.catalog import query
from workload.oracle import ES, correlation_risk, r6, with_parts

K1 = (f"country_key, country_name, residence_type_key, residence_type_desc, year, precip_total_mm_year, {r6('delta_precip_mm')} AS delta_precip_mm, "
      f"safe_water_pct, {r6('delta_safe_water_pp')} AS delta_safe_water_pp, years_observed, {r6('corr_precip_vs_water')} AS corr_precip_vs_water, "
      f"{r6('corr_abs_value')} AS corr_abs_value, risk_level, impact_direction")


@query("KPI-01 JOI-04 JOI-06 JOI-08 AGG-05 AGG-08 WIN-01 FIL-01 FIL-08 RUL-01 RUL-03", with_parts(f"SELECT {K1} FROM kpi_01", "kpi_01"))
def kpi_01_climate_water(spark, d):
    return kpis.kpi_01(lake.model(spark, d), PARAMS["kpi_01"])


@query("SRC-15", with_parts(f"SELECT {K1} FROM kpi_01 WHERE country_name = 'NOWHERE'", "kpi_01"))
def kpi_01_without_match(spark, d):
    params = PARAMS["kpi_01"]
    return kpis.kpi_01(lake.model(spark, d), replace(params, pick=replace(params.pick, countries=("NOWHERE",))))


K2 = (f"country_key, country_name, residence_type_key, residence_type_desc, year, pct_over_30min, {r6('delta_pct_over_30min_pp')} AS delta_pct_over_30min_pp, "
      "mobility_trend, risk_level")


@query("KPI-02 AGG-05 WIN-01 FIL-08 RUL-04 RUL-05 JOI-04 PRJ-07", with_parts(f"SELECT {K2} FROM kpi_02", "kpi_02"))
def kpi_02_mobility(spark, d):
    return kpis.kpi_02(lake.model(spark, d), PARAMS["kpi_02"])


@query("KPI-03 FIL-06 FIL-07 AGG-06 AGG-09 AGG-11 JOI-05 JOI-09 JOI-10 RUL-09 RUL-10 RUL-11", with_parts("SELECT * FROM kpi_03", "kpi_03"))
def kpi_03_critical_zones(spark, d):
    return kpis.kpi_03(lake.model(spark, d), PARAMS["kpi_03"])


@query("KPI-04 AGG-07 AGG-13 JOI-06 JOI-07 RUL-08 RUL-10 RUL-12 RUL-13 PRJ-08 PRJ-09", with_parts("SELECT * FROM kpi_04", "kpi_04"))
def kpi_04_health_risk(spark, d):
    return kpis.kpi_04(lake.model(spark, d), PARAMS["kpi_04"])


@query("KPI-05 AGG-07 AGG-13 FIL-05 RUL-07 RUL-14 PRJ-05", with_parts("SELECT * FROM kpi_05", "kpi_05"))
def kpi_05_urban_rural_gap(spark, d):
    return kpis.kpi_05(lake.model(spark, d), PARAMS["kpi_05"])


@query("RUL-14", with_parts("""SELECT country_key, country_name, year, water_urban_pct, water_rural_pct,
        CAST(CASE WHEN water_urban_pct IS NOT NULL AND water_rural_pct IS NOT NULL THEN gap_urban_rural_pp END AS DECIMAL(6,3)) AS gap_urban_rural_pp,
        CASE WHEN water_urban_pct IS NOT NULL AND water_rural_pct IS NOT NULL THEN risk_level ELSE 'Verde' END AS risk_level FROM kpi_05""", "kpi_05"))
def kpi_05_open_gap(spark, d):
    return kpis.kpi_05(lake.model(spark, d), replace(PARAMS["kpi_05"], missing="null"))


@query("KPI-06 AGG-07 AGG-10 FIL-09 RUL-02 JOI-07", with_parts("SELECT * FROM kpi_06", "kpi_06"))
def kpi_06_water_income(spark, d):
    return kpis.kpi_06(lake.model(spark, d), PARAMS["kpi_06"])


@query("KPI-07 AGG-07 JOI-06 RUL-07 RUL-14", with_parts("SELECT * FROM kpi_07", "kpi_07"))
def kpi_07_water_sanitation_gap(spark, d):
    return kpis.kpi_07(lake.model(spark, d), PARAMS["kpi_07"])


# ---- summaries on the stored indicators ------------------------------------------

ZONES = with_parts("""SELECT *, country_name || ' – ' || residence_type_desc AS area,
    CASE risk_level WHEN 'green' THEN 'Bajo, relación débil' WHEN 'yellow' THEN 'Medio, relación moderada' WHEN 'red' THEN 'Alto, relación fuerte' ELSE risk_level END AS risk_label,
    CASE WHEN corr_abs_value IS NULL THEN NULL WHEN corr_abs_value < 0.3 THEN 'baja' WHEN corr_abs_value < 0.6 THEN 'media' ELSE 'alta' END AS strength,
    CASE WHEN corr_precip_vs_water > 0 THEN 'positiva' WHEN corr_precip_vs_water < 0 THEN 'negativa' WHEN corr_precip_vs_water IS NOT NULL THEN 'sin dirección clara' END AS direction
    FROM (SELECT country_name, residence_type_desc, round(max(corr_precip_vs_water), 6) AS corr_precip_vs_water, round(max(corr_abs_value), 6) AS corr_abs_value,
    max(risk_level) AS risk_level, max(impact_direction) AS impact_direction, max(years_observed) AS years_observed FROM kpi_01 GROUP BY 1, 2)""", "kpi_01")


@query("AGG-16 PRJ-10 PRJ-11 RUL-18 EXP-03", ZONES)
def zone_summary(spark, d):
    return summaries.zone_summary(lake.gold(spark, d, "kpi_01"))


@query("WIN-04 WIN-03 EXP-03", f"SELECT * FROM ({ZONES}) ORDER BY corr_abs_value DESC NULLS LAST, country_name, residence_type_desc LIMIT 3")
def most_sensitive_zones(spark, d):
    return summaries.most_sensitive_zones(lake.gold(spark, d, "kpi_01"))


@query("RUL-17", with_parts(f"""SELECT country_name, residence_type_desc, year, {r6('delta_precip_mm')} AS delta_precip_mm, {r6('delta_safe_water_pp')} AS delta_safe_water_pp,
    CASE WHEN delta_precip_mm > 0 AND delta_safe_water_pp > 0 THEN 'Más lluvia, mejora agua' WHEN delta_precip_mm < 0 AND delta_safe_water_pp > 0 THEN 'Menos lluvia, mejora agua'
         WHEN delta_precip_mm > 0 AND delta_safe_water_pp < 0 THEN 'Más lluvia, baja agua' WHEN delta_precip_mm < 0 AND delta_safe_water_pp < 0 THEN 'Menos lluvia, baja agua'
         ELSE 'Cambios pequeños' END AS pattern FROM kpi_01""", "kpi_01"))
def change_patterns(spark, d):
    return summaries.change_patterns(lake.gold(spark, d, "kpi_01")).select(
        "country_name", "residence_type_desc", "year", "delta_precip_mm", "delta_safe_water_pp", "pattern")


@query("AGG-18 AGG-20 EXP-03", with_parts(f"""SELECT year, count(*) AS n_rows, count(*) FILTER (risk_level = 'red') AS n_red, count(*) FILTER (risk_level = 'yellow') AS n_yellow,
    count(DISTINCT (country_name, residence_type_desc)) AS n_entities, {r6('avg(pct_over_30min)')} AS avg_pct FROM kpi_02 GROUP BY year""", "kpi_02"))
def mobility_by_year(spark, d):
    return summaries.mobility_by_year(lake.gold(spark, d, "kpi_02"))


@query("WIN-05 RUL-20 FIL-10 PRJ-10", with_parts(f"""SELECT {K2}, country_name || ' – ' || residence_type_desc AS country_zone,
    CAST(rank() OVER (PARTITION BY year ORDER BY pct_over_30min DESC) AS BIGINT) AS place, CAST(greatest(1, round_even(100.0 / pct_over_30min, 0)) AS BIGINT) AS one_in_n
    FROM kpi_02 WHERE pct_over_30min > 0""", "kpi_02"))
def mobility_ranking(spark, d):
    return summaries.mobility_ranking(lake.gold(spark, d, "kpi_02"))


@query("WIN-03", with_parts("""SELECT year, country_name, residence_type_desc, pct_over_30min FROM kpi_02
    QUALIFY row_number() OVER (PARTITION BY year ORDER BY pct_over_30min DESC, country_name, residence_type_desc) = 1""", "kpi_02"))
def worst_zone_by_year(spark, d):
    return summaries.worst_zone(lake.gold(spark, d, "kpi_02"))


@query("WIN-06", with_parts(f"""SELECT country_name, residence_type_desc, year, pct_over_30min, {r6('20000 + pct_over_30min / max(pct_over_30min) OVER (PARTITION BY year) * 60000')} AS radius FROM kpi_02""", "kpi_02"))
def map_radius_by_year(spark, d):
    rows = lake.gold(spark, d, "kpi_02").select("country_name", "residence_type_desc", "year", "pct_over_30min")
    return scale_to_max(rows, "pct_over_30min", "radius", by=["year"])


@query("WIN-06", with_parts(f"""SELECT country_name, year, gap_water_sanitation_pp, {r6('25000 + CAST(gap_water_sanitation_pp AS DOUBLE) / (SELECT CAST(max(gap_water_sanitation_pp) AS DOUBLE) FROM kpi_07) * 60000')} AS radius FROM kpi_07""", "kpi_07"))
def map_radius_overall(spark, d):
    rows = lake.gold(spark, d, "kpi_07").select("country_name", "year", "gap_water_sanitation_pp")
    return scale_to_max(rows, "gap_water_sanitation_pp", "radius", base=25000)


@query("RUL-19", with_parts("""SELECT *, CASE WHEN is_critical_zone THEN 'red' WHEN is_low_sanitation OR is_climate_neg_trend THEN 'yellow' ELSE 'green' END AS zone_status,
    CASE WHEN is_low_sanitation THEN 'Bajo saneamiento (debajo del umbral)' ELSE 'Saneamiento adecuado' END AS sanitation_status,
    CASE WHEN is_climate_neg_trend THEN 'Lluvias en descenso' ELSE 'Lluvias estables o en aumento' END AS climate_status FROM kpi_03""", "kpi_03"))
def zone_map(spark, d):
    return summaries.zone_map(lake.gold(spark, d, "kpi_03"))


@query("AGG-21 AGG-20", with_parts("""SELECT *, CASE WHEN n_critical_zones <= 5 THEN 'Verde' WHEN n_critical_zones <= 20 THEN 'Amarillo' ELSE 'Rojo' END AS zone_risk
    FROM (SELECT country_name, year, count(*) FILTER (is_critical_zone) AS n_critical_zones, count(DISTINCT province_name) AS n_zones FROM kpi_03 GROUP BY 1, 2)""", "kpi_03"))
def critical_zone_counts(spark, d):
    return summaries.critical_zone_counts(lake.gold(spark, d, "kpi_03"))


@query("WIN-04", with_parts("""SELECT country_name, province_name, year, precip_total_mm_year FROM kpi_03
    QUALIFY row_number() OVER (PARTITION BY country_name, year ORDER BY precip_total_mm_year DESC, province_name) <= 3""", "kpi_03"))
def rainiest_provinces(spark, d):
    return top_k(lake.gold(spark, d, "kpi_03").select("country_name", "province_name", "year", "precip_total_mm_year"),
                 "precip_total_mm_year", 3, ["country_name", "year"], tie_break=["province_name"])


@query("RUL-15 RUL-08", with_parts(f"""SELECT country_name, year, CAST(least(greatest(CAST(health_risk_index AS DOUBLE), 0), 100) AS DOUBLE) AS health_risk_index,
    CASE WHEN health_risk_index <= 60 THEN 'Verde (Riesgo Bajo)' WHEN health_risk_index <= 62 THEN 'Amarillo (Riesgo Moderado)' ELSE 'Rojo (Riesgo Alto)' END AS risk_level FROM kpi_04""", "kpi_04"))
def index_for_display(spark, d):
    return summaries.index_for_display(lake.gold(spark, d, "kpi_04"), (60, 62)).select("country_name", "year", "health_risk_index", "risk_level")


@query("AGG-22", with_parts(f"""SELECT country_name, first_period, last_period, {r6('first_value')} AS first_value, {r6('last_value')} AS last_value, {r6('last_value - first_value')} AS change,
    CASE WHEN last_value - first_value > 1 THEN 'worsened' WHEN last_value - first_value < -1 THEN 'improved' ELSE 'stable' END AS direction
    FROM (SELECT country_name, min(year) AS first_period, max(year) AS last_period, arg_min(CAST(health_risk_index AS DOUBLE), year) AS first_value,
          arg_max(CAST(health_risk_index AS DOUBLE), year) AS last_value FROM kpi_04 GROUP BY 1) WHERE first_period < last_period""", "kpi_04"))
def index_change(spark, d):
    return summaries.index_change(lake.gold(spark, d, "kpi_04"))


def _gap_history(kpi: str, gap: str) -> str:
    return with_parts(f"""SELECT country_name, year, {gap}, CAST(delta AS DECIMAL(7,3)) AS delta_gap,
        CASE WHEN delta IS NULL THEN 'Sin datos previos' WHEN delta > 0.1 THEN 'Empeorando' WHEN delta < -0.1 THEN 'Mejorando' ELSE 'Estable' END AS gap_trend
        FROM (SELECT *, {gap} - lag({gap}) OVER (PARTITION BY country_name ORDER BY year) AS delta FROM {kpi})""", kpi)


@query("WIN-02 RUL-06", _gap_history("kpi_05", "gap_urban_rural_pp"))
def urban_rural_gap_history(spark, d):
    return summaries.gap_history(lake.gold(spark, d, "kpi_05"), "gap_urban_rural_pp").select("country_name", "year", "gap_urban_rural_pp", "delta_gap", "gap_trend")


@query("WIN-02 RUL-06", _gap_history("kpi_07", "gap_water_sanitation_pp"))
def water_sanitation_gap_history(spark, d):
    return summaries.gap_history(lake.gold(spark, d, "kpi_07"), "gap_water_sanitation_pp").select("country_name", "year", "gap_water_sanitation_pp", "delta_gap", "gap_trend")


@query("WIN-03 AGG-18 EXP-03",
       with_parts("""SELECT year, avg_abs_gap, country_name, gap_urban_rural_pp, risk_level FROM (
    SELECT *, round(avg(abs(CAST(gap_urban_rural_pp AS DOUBLE))) OVER (PARTITION BY year), 4) AS avg_abs_gap,
           row_number() OVER (PARTITION BY year ORDER BY abs(gap_urban_rural_pp) DESC, country_name, gap_urban_rural_pp, risk_level) AS place
    FROM kpi_05 WHERE water_urban_pct IS NOT NULL AND water_rural_pct IS NOT NULL) WHERE place = 1""", "kpi_05"))
def widest_gap_by_year(spark, d):
    gaps = lake.gold(spark, d, "kpi_05")
    widest = summaries.widest_gap(gaps, "gap_urban_rural_pp", ["water_urban_pct", "water_rural_pct"])
    return widest.withColumn("avg_abs_gap", F.round(F.col("avg_abs_gap").cast("double"), 4))


@query("AGG-22 AGG-18 EXP-03", with_parts("""SELECT round(f, 4) AS first_value, round(l, 4) AS last_value, round(l - f, 4) AS change,
    CASE WHEN l - f > 1 THEN 'increased' WHEN l - f < -1 THEN 'decreased' ELSE 'stable' END AS direction FROM (
    SELECT avg(CAST(gap_water_sanitation_pp AS DOUBLE)) FILTER (year = (SELECT min(year) FROM kpi_07)) AS f,
           avg(CAST(gap_water_sanitation_pp AS DOUBLE)) FILTER (year = (SELECT max(year) FROM kpi_07)) AS l FROM kpi_07)""", "kpi_07"))
def regional_gap_change(spark, d):
    change = summaries.regional_change(lake.gold(spark, d, "kpi_07"), "gap_water_sanitation_pp", absolute=False)
    return change.select(*[F.round(c, 4).alias(c) for c in ("first_value", "last_value", "change")], "direction")


@query("AGG-19 FIL-10", with_parts(f"""SELECT risk_level AS level, count(*) AS n, {r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct,
    CASE risk_level WHEN 'Rojo' THEN 1 WHEN 'Amarillo' THEN 2 WHEN 'Verde' THEN 3 END AS position
    FROM kpi_07 WHERE year = (SELECT max(year) FROM kpi_07) GROUP BY risk_level""", "kpi_07"))
def risk_distribution_latest_year(spark, d):
    return summaries.risk_shares(lake.gold(spark, d, "kpi_07"))


@query("AGG-17 SET-02 RUL-02", with_parts(f"""SELECT coalesce(region_name, 'Regional') AS region_name, max(n_countries) AS n_countries, {r6('avg(CAST(corr_water_vs_gdp AS DOUBLE))')} AS correlation_coefficient,
    {r6('avg(CAST(avg_safe_water_pct AS DOUBLE))')} AS avg_safe_water_pct, round(avg(CAST(avg_gdp_per_capita AS DOUBLE)), 4) AS avg_gdp_per_capita,
    {r6('abs(avg(CAST(corr_water_vs_gdp AS DOUBLE)))')} AS corr_abs_value, {correlation_risk('avg(CAST(corr_water_vs_gdp AS DOUBLE))', ES, "'Verde'")} AS risk_level
    FROM kpi_06 GROUP BY ROLLUP (region_name)""", "kpi_06"))
def income_regions_with_total(spark, d):
    return summaries.income_regions(lake.gold(spark, d, "kpi_06")).withColumn("avg_gdp_per_capita", F.round("avg_gdp_per_capita", 4))


@query("AGG-22", with_parts(f"""SELECT region_name, min(year) AS first_period, max(year) AS last_period, arg_min(CAST(corr_abs_value AS DOUBLE), year) AS first_value,
    arg_max(CAST(corr_abs_value AS DOUBLE), year) AS last_value, {r6('arg_max(CAST(corr_abs_value AS DOUBLE), year) - arg_min(CAST(corr_abs_value AS DOUBLE), year)')} AS change,
    CASE WHEN arg_max(CAST(corr_abs_value AS DOUBLE), year) - arg_min(CAST(corr_abs_value AS DOUBLE), year) > 0.1 THEN 'stronger'
         WHEN arg_max(CAST(corr_abs_value AS DOUBLE), year) - arg_min(CAST(corr_abs_value AS DOUBLE), year) < -0.1 THEN 'weaker' ELSE 'stable' END AS direction
    FROM kpi_06 GROUP BY 1 HAVING min(year) < max(year)""", "kpi_06"))
def income_strength_change(spark, d):
    return summaries.income_strength_change(lake.gold(spark, d, "kpi_06"))


YEARS = tuple(range(1995, 2002))


@query("AGG-14", with_parts("SELECT region_name, " + ", ".join(
    f"coalesce(CAST(avg(corr_water_vs_gdp) FILTER (year = {y}) AS DOUBLE), 0) AS y{y}" for y in YEARS) + " FROM kpi_06 GROUP BY 1", "kpi_06"))
def correlation_heatmap(spark, d):
    rows = lake.gold(spark, d, "kpi_06").withColumn("r", F.col("corr_water_vs_gdp").cast("double"))
    return pivot_values(rows, ["region_name"], "year", {y: f"y{y}" for y in YEARS}, "r", agg="avg", fill=0.0)


@query("AGG-14 AGG-13", with_parts("SELECT country_iso3, year, " + ", ".join(
    f"{r6(f'avg(coverage_pct) FILTER (residence_type_desc = {chr(39)}{v}{chr(39)})')} AS {v}" for v in bindings.RESIDENCES)
    + " FROM coverage WHERE service_type_desc = 'expedited' AND service_level_desc = 'f' GROUP BY 1, 2", "coverage"))
def residence_pivot(spark, d):
    rows = lake.clean_table(spark, d, "coverage").where("service_type_desc = 'expedited' AND service_level_desc = 'f'")
    return pivot_values(rows.withColumn("pct", F.col("coverage_pct").cast("double")), ["country_iso3", "year"], "residence_type_desc", bindings.RESIDENCES, "pct", agg="avg")


@query("SRC-16 PRJ-13 PRJ-12", with_parts("""SELECT country_key, country_name, year, CAST(water_urban_pct AS DOUBLE) AS water_urban_pct, CAST(water_rural_pct AS DOUBLE) AS water_rural_pct,
    CAST(gap_urban_rural_pp AS DOUBLE) AS gap_urban_rural_pp, risk_level FROM kpi_05""", "kpi_05"))
def served_kpi_05(spark, d):
    return serve(read_gold(spark, lake.gold_layer(spark, d, ["kpi_05"]), "kpi_05"))


@query("WIN-05", with_parts("""SELECT country_name, year, gap_urban_rural_pp, CAST(rank() OVER (PARTITION BY year ORDER BY abs(gap_urban_rural_pp) DESC) AS BIGINT) AS place FROM kpi_05""", "kpi_05"))
def gap_ranking(spark, d):
    rows = lake.gold(spark, d, "kpi_05").select("country_name", "year", "gap_urban_rural_pp")
    return rank_by(rows, "gap_urban_rural_pp", "place", ["year"], absolute=True)


# ---- exploration --------------------------------------------------------------------


@query("EXP-01 SET-04", with_parts("""SELECT country_iso3, year, coverage_pct AS safe_water_pct FROM coverage
    WHERE service_type_desc = 'expedited' AND service_level_desc = 'o' AND residence_type_desc = 'total'""", "coverage"))
def explored_safe_water(spark, d):
    return exploration.safe_water_trend(lake.clean_table(spark, d, "coverage"), bindings.WATER, "o", "total")


@query("EXP-01 AGG-15", with_parts(f"""SELECT country_iso3, year, round(CAST(sum(population_total * coverage_pct / 100) AS DOUBLE), 4) AS limited_water_population FROM coverage
    WHERE service_type_desc = 'expedited' AND service_level_desc = 'p' GROUP BY 1, 2""", "coverage"))
def explored_limited_population(spark, d):
    people = exploration.limited_water_population(lake.clean_table(spark, d, "coverage"), bindings.WATER, "p")
    return people.withColumn("limited_water_population", F.round(F.col("limited_water_population").cast("double"), 4))


@query("EXP-01 AGG-07", with_parts("""SELECT country_iso3, year, CAST(sum(coverage_pct) AS DOUBLE) AS high_risk_pct FROM coverage
    WHERE service_type_desc = 'regular' AND service_level_desc IN ('o', 'p') GROUP BY 1, 2""", "coverage"))
def explored_high_risk_sanitation(spark, d):
    risk = exploration.high_risk_sanitation(lake.clean_table(spark, d, "coverage"), bindings.SANITATION, ("o", "p"))
    return risk.withColumn("high_risk_pct", F.col("high_risk_pct").cast("double"))


BASE = """SELECT c.country_iso3, c.year, residence_type_desc, service_type_desc, service_level_desc, coverage_pct, population_total, price, balance, round(rain, 4) AS rain
    FROM coverage c LEFT JOIN (SELECT country_iso3, year, avg(indicator_value) FILTER (indicator_code = 'OR.PRC.AVG') AS price, avg(indicator_value) FILTER (indicator_code = 'CU.BAL.AVG') AS balance FROM indicators GROUP BY 1, 2) i USING (country_iso3, year)
    LEFT JOIN (SELECT country_iso3, year, sum(precip_total_mm) AS rain FROM climate GROUP BY 1, 2) w USING (country_iso3, year)"""


def _base(spark, d):
    rain = lake.clean_table(spark, d, "climate").groupBy("country_iso3", "year").agg(F.sum("precip_total_mm").alias("rain"))
    names = {bindings.PRICE: "price", bindings.BALANCE: "balance"}
    base = exploration.analysis_base(lake.clean_table(spark, d, "coverage"), lake.clean_table(spark, d, "indicators"), rain, names)
    return base.withColumn("rain", F.round("rain", 4)).drop("country_name", "residence_type_code")


@query("JOI-12 AGG-14", with_parts(BASE, "coverage", "indicators", "climate"))
def analysis_base(spark, d):
    return _base(spark, d)


@query("SET-04 SET-05", with_parts(f"SELECT DISTINCT country_iso3, year, price, balance FROM ({BASE})", "coverage", "indicators", "climate"))
def income_series(spark, d):
    return exploration.distinct_series(_base(spark, d), ["country_iso3", "year", "price", "balance"], ["country_iso3", "year"])


METRIC_QUERIES = (
    registry.Metric("m_pair", (bindings.WATER,), ("f",), ("building", "machinery")),
    registry.Metric("m_people", (bindings.WATER,), ("p",), ("total",), "population"),
    registry.Metric("m_risk", (bindings.SANITATION,), ("o", "p"), ("total",), "sum_of_coverage"),
    registry.Metric("m_both", (bindings.WATER, bindings.SANITATION), ("f",), ("total",)),
)


def _metric_sql(m: registry.Metric) -> str:
    measure = {"coverage": "CAST(max(coverage_pct) AS DOUBLE)", "sum_of_coverage": "CAST(sum(coverage_pct) AS DOUBLE)",
               "population": "round(CAST(sum(population_total * coverage_pct / 100) AS DOUBLE), 4)"}[m.measure]
    inside = lambda values: ", ".join(f"'{v}'" for v in values)
    return (f"SELECT '{m.name}' AS metric, country_iso3, year, residence_type_desc, service_type_desc, {measure} AS value FROM coverage "
            f"WHERE service_type_desc IN ({inside(m.services)}) AND service_level_desc IN ({inside(m.levels)}) AND residence_type_desc IN ({inside(m.residences)}) GROUP BY ALL")


@query("EXP-02 FIL-01 SET-01", with_parts(" UNION ALL ".join(_metric_sql(m) for m in METRIC_QUERIES), "coverage"))
def metric_registry(spark, d):
    values = registry.evaluate(lake.clean_table(spark, d, "coverage"), METRIC_QUERIES)
    return values.withColumn("value", F.when(F.col("metric") == "m_people", F.round("value", 4)).otherwise(F.col("value")))
