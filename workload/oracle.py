"""SQL text for the oracle: the bindings and the star schema re-derived from the raw tables."""

from __future__ import annotations

from workload.bindings import BALANCE, DRY_BELOW, HEAVY_ABOVE, INDICATOR_NAMES, ORDERS, PRICE, RESIDENCE_CODES


def half_up(num: str, den: str) -> str:
    """Integer division rounded half away from zero, for a positive divisor."""
    return f"(CASE WHEN ({num}) < 0 THEN -((2 * -({num}) + ({den})) // (2 * ({den}))) ELSE (2 * ({num}) + ({den})) // (2 * ({den})) END)"


def fixed(units: str, digits: int, dtype: str) -> str:
    """An integer number of 10^-digits as decimal."""
    return f"CAST(CAST({units} AS DOUBLE) / {10 ** digits} AS {dtype})"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def corr(x: str, y: str) -> str:
    """Correlation with flat and one-row groups as NULL."""
    return f"(CASE WHEN isfinite(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))) THEN corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) END)"


def key(*parts: str) -> str:
    return f"CAST('0x' || substr({wide_key(*parts)}, 1, 15) AS BIGINT)"


def wide_key(*parts: str) -> str:
    text = ", ".join(f"coalesce(CAST({p} AS VARCHAR), chr(30))" for p in parts)
    return f"md5(concat_ws(chr(31), {text}))"


def _case(value: str, table: dict[str, str]) -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def correlation_risk(r: str, labels=("green", "yellow", "red"), unknown: str = "'gray'") -> str:
    return (f"CASE WHEN {r} IS NULL THEN {unknown} WHEN abs({r}) < 0.3 THEN '{labels[0]}' "
            f"WHEN abs({r}) < 0.6 THEN '{labels[1]}' ELSE '{labels[2]}' END")


ES = ("Verde", "Amarillo", "Rojo")

# name -> (SQL of the common table expression, what it needs)
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_coverage": (f"""
        SELECT n_name AS country_iso3, replace(n_name, '_', ' ') AS country_name, lower(c_mktsegment) AS segment,
               CAST(year(o_orderdate) AS INTEGER) AS year, lower(o_orderstatus) AS level,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expedited' ELSE 'regular' END AS service,
               CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents, CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""", ()),
    "cells": ("""
        SELECT country_iso3, country_name, residence, service, level, year, count(*) AS n
        FROM (SELECT *, unnest([segment, 'total']) AS residence FROM raw_coverage) GROUP BY ALL""", ("raw_coverage",)),
    "coverage": (f"""
        SELECT country_iso3, country_name, year, {_case('residence', RESIDENCE_CODES)} AS residence_type_code,
               residence AS residence_type_desc, service AS service_type_desc, level AS service_level_desc,
               {fixed(half_up('10000 * n', 'whole'), 2, 'DECIMAL(5,2)')} AS coverage_pct, whole AS population_total
        FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY country_iso3, residence, service, year) AS BIGINT) AS whole FROM cells)""", ("cells",)),
    "indicator_sums": ("""
        SELECT country_iso3, country_name, year, count(*) AS n, CAST(sum(price_cents) AS BIGINT) AS price, CAST(sum(balance_cents) AS BIGINT) AS balance
        FROM raw_coverage GROUP BY ALL""", ("raw_coverage",)),
    # values in millionths
    "indicator_units": (f"""
        SELECT country_iso3, country_name, year, '{PRICE}' AS indicator_code, '{INDICATOR_NAMES[PRICE]}' AS indicator_name, {half_up('price * 10000', 'n')} AS micro FROM indicator_sums
        UNION ALL SELECT country_iso3, country_name, year, '{ORDERS}', '{INDICATOR_NAMES[ORDERS]}', n * 1000000 FROM indicator_sums
        UNION ALL SELECT country_iso3, country_name, year, '{BALANCE}', '{INDICATOR_NAMES[BALANCE]}', {half_up('balance * 10000', 'n')} FROM indicator_sums""", ("indicator_sums",)),
    "indicators": ("""
        SELECT country_iso3, year, indicator_code, indicator_name, CAST(micro AS DOUBLE) / 1000000 AS indicator_value FROM indicator_units""", ("indicator_units",)),
    "climate": (f"""
        SELECT *, precip_total_mm < {DRY_BELOW} AS dry_month_flag, precip_total_mm > {HEAVY_ABOVE} AS heavy_rain_month_flag FROM (
            SELECT n_name AS country_iso3, s_name AS province_name, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                   round(sum(l_quantity), 2) AS precip_total_mm, round(sum(round(l_discount * 100)), 2) AS et0_total_mm,
                   round(avg(CAST(l_linenumber * 5 AS DOUBLE)), 2) AS temp_max_avg_c, round(avg(round(l_tax * 100)), 2) AS temp_min_avg_c,
                   round(avg(round(l_discount * 100)), 2) AS et0_avg_mm
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 4)""", ()),
    "country": (f"""
        SELECT {key('c.country_iso3')} AS country_key, c.country_iso3, c.country_name, r_name AS region_name
        FROM (SELECT DISTINCT country_iso3, country_name FROM coverage) c JOIN nation ON n_name = c.country_iso3 JOIN region ON n_regionkey = r_regionkey""", ("coverage",)),
    "residence_type": (f"""
        SELECT DISTINCT {key('residence_type_code')} AS residence_type_key, residence_type_code, residence_type_desc FROM coverage""", ("coverage",)),
    "service_type": (f"SELECT DISTINCT {key('service_type_desc')} AS service_type_key, service_type_desc FROM coverage", ("coverage",)),
    "service_level": (f"SELECT DISTINCT {key('service_level_desc')} AS service_level_key, service_level_desc FROM coverage", ("coverage",)),
    "indicator": (f"SELECT DISTINCT {key('indicator_code')} AS indicator_key, indicator_code, indicator_name FROM indicators", ("indicators",)),
    "province": (f"SELECT DISTINCT {key('country_iso3', 'province_name')} AS province_key, country_iso3, province_name FROM climate", ("climate",)),
    "calendar": ("""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter
        FROM (SELECT unnest(generate_series(make_date(lo, 1, 1), make_date(hi, 12, 31), INTERVAL 1 DAY)) AS d
              FROM (SELECT min(year) AS lo, max(year) AS hi FROM (SELECT year FROM coverage UNION ALL SELECT year FROM climate)))""", ("coverage", "climate")),
    "fact_monthly": (f"""
        SELECT * FROM (
            SELECT {wide_key('country_iso3', 'province_name', 'year', 'month')} AS climate_monthly_id, {key('country_iso3', 'province_name')} AS province_key,
                   CAST(strftime(last_day(make_date(year, month, 1)), '%Y%m%d') AS INTEGER) AS date_key, year,
                   CAST(precip_total_mm AS DECIMAL(24,2)) AS precip_total_mm, CAST(temp_max_avg_c AS DECIMAL(24,2)) AS temp_max_avg_c,
                   CAST(temp_min_avg_c AS DECIMAL(24,2)) AS temp_min_avg_c, CAST(et0_total_mm AS DECIMAL(24,2)) AS et0_total_mm,
                   CAST(et0_avg_mm AS DECIMAL(24,2)) AS et0_avg_mm, dry_month_flag, heavy_rain_month_flag
            FROM climate)""", ("climate",)),
    "annual_sums": ("""
        SELECT country_iso3, year, count(*) AS n, CAST(sum(round(precip_total_mm * 100)) AS BIGINT) AS rain,
               CAST(sum(round(temp_max_avg_c * 100)) AS BIGINT) AS tmax, CAST(sum(round(temp_min_avg_c * 100)) AS BIGINT) AS tmin,
               CAST(sum(round(et0_total_mm * 100)) AS BIGINT) AS et0, CAST(sum(round(et0_avg_mm * 100)) AS BIGINT) AS et0_avg,
               count(*) FILTER (dry_month_flag) AS dry, count(*) FILTER (heavy_rain_month_flag) AS heavy
        FROM climate GROUP BY 1, 2""", ("climate",)),
    "fact_annual": (f"""
        SELECT * FROM (
            SELECT {wide_key('country_iso3', 'year')} AS climate_annual_id, {key('country_iso3')} AS country_key, year * 10000 + 1231 AS date_key, year,
                   {fixed('rain', 2, 'DECIMAL(24,2)')} AS precip_total_mm_year, {fixed(half_up('rain', '12'), 2, 'DECIMAL(24,2)')} AS precip_avg_mm_year,
                   {fixed(half_up('tmax', 'n'), 2, 'DECIMAL(24,2)')} AS temp_max_avg_year, {fixed(half_up('tmin', 'n'), 2, 'DECIMAL(24,2)')} AS temp_min_avg_year,
                   {fixed('et0', 2, 'DECIMAL(24,2)')} AS et0_total_mm_year, {fixed(half_up('et0_avg', 'n'), 2, 'DECIMAL(24,2)')} AS et0_avg_mm_year,
                   CAST(dry AS DECIMAL(24,2)) AS dry_months, CAST(heavy AS DECIMAL(24,2)) AS heavy_rain_months,
                   {fixed(half_up('1000 * dry', '12'), 3, 'DECIMAL(24,3)')} AS drought_index, {fixed(half_up('1000 * heavy', '12'), 3, 'DECIMAL(24,3)')} AS heavy_rain_index
            FROM annual_sums)""", ("annual_sums",)),
    "fact_coverage": (f"""
        SELECT * FROM (
            SELECT {wide_key('country_iso3', 'residence_type_code', 'service_type_desc', 'service_level_desc', 'year')} AS wash_coverage_id, {key('country_iso3')} AS country_key, year * 10000 + 1231 AS date_key, year, {key('residence_type_code')} AS residence_type_key,
                   {key('service_type_desc')} AS service_type_key, {key('service_level_desc')} AS service_level_key, population_total, coverage_pct
            FROM coverage)""", ("coverage",)),
    "fact_socioeconomic": (f"""
        SELECT * FROM (
            SELECT {wide_key('country_iso3', 'indicator_code', 'year')} AS socioeconomic_id, {key('country_iso3')} AS country_key, year * 10000 + 1231 AS date_key, year, {key('indicator_code')} AS indicator_key,
                   {fixed(half_up('micro', '100'), 4, 'DECIMAL(24,4)')} AS indicator_value FROM indicator_units)""", ("indicator_units",)),
    "water_f": ("""
        SELECT country_iso3, country_name, residence_type_code, residence_type_desc, year, CAST(coverage_pct AS DOUBLE) AS pct
        FROM coverage WHERE service_type_desc = 'expedited' AND service_level_desc = 'f' AND residence_type_desc IN ('building', 'machinery')""", ("coverage",)),
    "kpi_01": (f"""
        SELECT {key('country_iso3')} AS country_key, country_name, {key('residence_type_code')} AS residence_type_key, residence_type_desc, year,
               precip AS precip_total_mm_year, dp AS delta_precip_mm, pct AS safe_water_pct, dw AS delta_safe_water_pp,
               count(*) OVER s AS years_observed, r AS corr_precip_vs_water, abs(r) AS corr_abs_value,
               {correlation_risk('r')} AS risk_level,
               CASE WHEN r IS NULL THEN 'uncertain' WHEN r >= 0.2 THEN 'direct' WHEN r <= -0.2 THEN 'inverse' ELSE 'uncertain' END AS impact_direction
        FROM (SELECT *, (SELECT {corr('i.dp', 'i.dw')} FROM deltas_01 i WHERE i.country_iso3 = d.country_iso3 AND i.residence_type_code = d.residence_type_code AND i.dp IS NOT NULL AND i.dw IS NOT NULL) AS r
              FROM deltas_01 d WHERE dp IS NOT NULL AND dw IS NOT NULL)
        WINDOW s AS (PARTITION BY country_iso3, residence_type_code)""", ("deltas_01",)),
    "deltas_01": ("""
        SELECT w.*, CAST(a.rain AS DOUBLE) / 100 AS precip,
               CAST(a.rain AS DOUBLE) / 100 - lag(CAST(a.rain AS DOUBLE) / 100) OVER s AS dp, pct - lag(pct) OVER s AS dw
        FROM water_f w JOIN annual_sums a USING (country_iso3, year)
        WINDOW s AS (PARTITION BY country_iso3, residence_type_code ORDER BY year)""", ("water_f", "annual_sums")),
    "kpi_02": (f"""
        SELECT {key('country_iso3')} AS country_key, country_name, {key('residence_type_code')} AS residence_type_key, residence_type_desc, year,
               pct AS pct_over_30min, d AS delta_pct_over_30min_pp,
               CASE WHEN d > 5 THEN 'worsened' WHEN d < -5 THEN 'improved' ELSE 'stable' END AS mobility_trend,
               CASE WHEN pct <= 30 THEN 'green' WHEN pct <= 36 THEN 'yellow' ELSE 'red' END AS risk_level
        FROM (SELECT *, pct - lag(pct) OVER (PARTITION BY country_iso3, residence_type_code ORDER BY year) AS d
              FROM (SELECT *, CAST(coverage_pct AS DOUBLE) AS pct FROM coverage
                    WHERE service_type_desc = 'expedited' AND service_level_desc = 'p' AND residence_type_desc IN ('building', 'machinery')))
        WHERE d IS NOT NULL""", ("coverage",)),
    "sanitation_03": ("""
        SELECT country_iso3, country_name, year, CAST(100 - sum(CASE WHEN service_level_desc = 'p' THEN coverage_pct ELSE 0 END) AS DOUBLE) AS pct
        FROM coverage WHERE service_type_desc = 'regular' AND residence_type_desc = 'building' GROUP BY 1, 2, 3""", ("coverage",)),
    "rain_03": ("""
        SELECT country_iso3, province_name, year, sum(precip_total_mm) AS rain FROM climate
        WHERE year BETWEEN (SELECT min(year) FROM sanitation_03) AND (SELECT max(year) FROM sanitation_03) GROUP BY 1, 2, 3""", ("climate", "sanitation_03")),
    "trend_03": (f"""
        SELECT country_iso3, province_name, CASE WHEN n < 3 THEN 'uncertain' WHEN r <= -0.3 THEN 'decreasing' WHEN r >= 0.3 THEN 'increasing' ELSE 'stable' END AS trend
        FROM (SELECT country_iso3, province_name, count(DISTINCT year) AS n, {corr('year', 'rain')} AS r FROM rain_03 GROUP BY 1, 2)""", ("rain_03",)),
    "kpi_03": (f"""
        SELECT {key('r.country_iso3')} AS country_key, country_name, {key('r.country_iso3', 'province_name')} AS province_key, province_name, r.year,
               pct AS sanitation_basic_pct, pct < 66 AS is_low_sanitation, rain AS precip_total_mm_year, trend AS climate_trend,
               trend = 'decreasing' AS is_climate_neg_trend, pct < 66 AND trend = 'decreasing' AS is_critical_zone
        FROM rain_03 r JOIN trend_03 USING (country_iso3, province_name) JOIN sanitation_03 s ON s.country_iso3 = r.country_iso3 AND s.year = r.year""", ("rain_03", "trend_03", "sanitation_03")),
    "wide_04": (f"""
        SELECT country_iso3, year, max({half_up('micro', '1000')}) FILTER (indicator_code = '{PRICE}') AS mortality,
               max({half_up('micro', '10000')}) FILTER (indicator_code = '{BALANCE}') AS poverty, max(micro // 1000000) FILTER (indicator_code = '{ORDERS}') AS population
        FROM (SELECT country_iso3, year, indicator_code, {half_up('micro', '100')} * 100 AS micro FROM indicator_units) GROUP BY 1, 2""", ("indicator_units",)),
    "kpi_04": (f"""
        SELECT {key('country_iso3')} AS country_key, country_name, year, CAST(cov AS DECIMAL(5,2)) AS sanitation_coverage_pct,
               CAST(mort AS DECIMAL(12,3)) AS child_mortality_rate, CAST(pov AS DECIMAL(8,2)) AS poverty_rate, CAST(population AS BIGINT) AS population_total,
               CAST(idx AS DECIMAL(6,3)) AS health_risk_index, CASE WHEN idx > 62 THEN 'Rojo' WHEN idx > 60 THEN 'Amarillo' ELSE 'Verde' END AS risk_level
        FROM (SELECT *, CAST(((100.0 - CAST(cov AS DOUBLE)) / 100.0) * 0.5 + greatest(0.0, least(1.0, mort / 400000.0)) * 0.3 + greatest(0.0, least(1.0, pov / 10000.0)) * 0.2 AS DECIMAL(6,3)) * 100 AS idx
              FROM (SELECT c.country_iso3, country_name, c.year, sum(coverage_pct) AS cov, any_value(mortality) / 1000.0 AS mort, any_value(poverty) / 100.0 AS pov, any_value(population) AS population
                    FROM coverage c JOIN wide_04 w USING (country_iso3, year)
                    WHERE service_type_desc = 'regular' AND service_level_desc = 'f' AND residence_type_desc = 'total' GROUP BY 1, 2, 3))""", ("coverage", "wide_04")),
    "kpi_05": (f"""
        SELECT {key('country_iso3')} AS country_key, country_name, year, CAST(u AS DECIMAL(5,2)) AS water_urban_pct, CAST(r AS DECIMAL(5,2)) AS water_rural_pct,
               CAST(coalesce(u, 0) - coalesce(r, 0) AS DECIMAL(6,3)) AS gap_urban_rural_pp,
               CASE WHEN abs(coalesce(u, 0) - coalesce(r, 0)) >= 20 THEN 'Rojo' WHEN abs(coalesce(u, 0) - coalesce(r, 0)) >= 10 THEN 'Amarillo' ELSE 'Verde' END AS risk_level
        FROM (SELECT country_iso3, country_name, year, sum(coverage_pct) FILTER (residence_type_desc = 'building') AS u, sum(coverage_pct) FILTER (residence_type_desc = 'machinery') AS r
              FROM coverage WHERE service_type_desc = 'expedited' AND service_level_desc IN ('f', 'o') AND residence_type_desc IN ('building', 'machinery') GROUP BY 1, 2, 3)""", ("coverage",)),
    "base_06": (f"""
        SELECT r_name AS region_name, c.country_iso3, c.year, c.w, {half_up(half_up('micro', '100'), '100')} AS gdp_cents
        FROM (SELECT country_iso3, year, sum(coverage_pct) AS w FROM coverage WHERE service_type_desc = 'expedited' AND service_level_desc IN ('f', 'o') AND residence_type_desc = 'total' GROUP BY 1, 2) c
        JOIN indicator_units i ON i.country_iso3 = c.country_iso3 AND i.year = c.year AND indicator_code = '{PRICE}'
        JOIN nation ON n_name = c.country_iso3 JOIN region ON n_regionkey = r_regionkey""", ("coverage", "indicator_units")),
    "kpi_06": (f"""
        SELECT region_name, year, CAST(n AS INTEGER) AS n_countries, CAST(r AS DECIMAL(6,3)) AS corr_water_vs_gdp, CAST(abs(r) AS DECIMAL(6,3)) AS corr_abs_value,
               {fixed(half_up('w', 'n'), 2, 'DECIMAL(5,2)')} AS avg_safe_water_pct, {fixed(half_up('g', 'n'), 2, 'DECIMAL(18,2)')} AS avg_gdp_per_capita,
               {correlation_risk('r', ES, "'Verde'")} AS risk_level
        FROM (SELECT region_name, year, count(DISTINCT country_iso3) AS n, {corr('w', 'gdp_cents')} AS r, CAST(sum(CAST(w * 100 AS BIGINT)) AS BIGINT) AS w, CAST(sum(gdp_cents) AS BIGINT) AS g
              FROM base_06 GROUP BY 1, 2) WHERE n >= 2""", ("base_06",)),
    "kpi_07": (f"""
        SELECT {key('country_iso3')} AS country_key, country_name, year, CAST(w AS DECIMAL(5,2)) AS water_basic_safe_pct, CAST(s AS DECIMAL(5,2)) AS sanitation_basic_safe_pct,
               CAST(w - s AS DECIMAL(6,3)) AS gap_water_sanitation_pp, CASE WHEN abs(w - s) >= 5 THEN 'Rojo' WHEN abs(w - s) >= 2.5 THEN 'Amarillo' ELSE 'Verde' END AS risk_level
        FROM (SELECT country_iso3, country_name, year, sum(coverage_pct) FILTER (service_type_desc = 'expedited') AS w, sum(coverage_pct) FILTER (service_type_desc = 'regular') AS s
              FROM coverage WHERE service_level_desc IN ('f', 'o') AND residence_type_desc = 'total' GROUP BY 1, 2, 3) WHERE w IS NOT NULL AND s IS NOT NULL""", ("coverage",)),
}


def with_parts(select: str, *needed: str) -> str:
    """``select`` preceded by the table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in PARTS[name][1]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in ordered) + "\n" + select
