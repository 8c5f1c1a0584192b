"""The indicators on survey-like data, against an independent pandas computation."""

import numpy as np
import pandas as pd
import pytest

from caudal.plans import cleaning, exploration, kpis, places, registry, star, summaries

from conftest import values

YEARS = range(2015, 2021)
COUNTRIES = {"MEX": "Mexico", "ARG": "Argentina", "BRA": "Brazil"}
LEVELS = {
    "Drinking water": ["Safely managed service", "Basic service", "Limited service", "At least basic"],
    "Sanitation": ["Safely managed service", "Basic service", "Limited service", "Unimproved", "Open defecation"],
}


def landed_coverage():
    rng = np.random.default_rng(7)
    rows = []
    for iso, name in COUNTRIES.items():
        for year in YEARS:
            for residence in ("Total", "Urban", "Rural"):
                for service, levels in LEVELS.items():
                    for level in levels:
                        rows.append((iso, name, residence, service, int(year), float(np.round(rng.uniform(0, 40), 2)), 1e6, level))
    rows.append(rows[0])  # a copy
    rows.append(("MEX", "Mexico", "Total", "Hygiene", 2016, -1.0, 1.0, "Basic service"))  # negative
    rows.append(("MEX", "Mexico", "Suburban", "Hygiene", 2016, 1.0, 1.0, "Basic service"))  # foreign residence
    rows.append(("ARG", "Argentina", "Total", "Hygiene", 2016, None, None, "Basic service"))  # unknown measures
    return pd.DataFrame(rows, columns=["ISO3", "Country", "Residence Type", "Service Type", "Year", "Coverage", "Population", "Service level"])


def daily_climate():
    rng = np.random.default_rng(11)
    rows = []
    for iso in ("MEX", "ARG"):
        for p in range(3):
            for year in range(2014, 2022):
                for month in range(1, 13):
                    for day in (1, 15):
                        rain = float(np.round(rng.uniform(0, 90) - (year - 2014) * 3 * p, 1))
                        rows.append((iso, f"{iso}-{p}", year, month, 25.0 + day, 10.0, max(rain, 0.0) if day == 1 else None, 2.5))
    rows.append(("MEX", "MEX-0", None, 3, 20.0, 10.0, 500.0, 1.0))  # no year
    return pd.DataFrame(rows, columns=["country_iso3", "province", "year", "month", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "et0_fao_evapotranspiration"])


def landed_indicators():
    rng = np.random.default_rng(13)
    rows = []
    for iso, name in COUNTRIES.items():
        for year in YEARS:
            for code, high in ((kpis.POPULATION, 1e8), (kpis.CHILD_MORTALITY, 200.0), (kpis.POVERTY, 60.0), (kpis.GDP_PER_CAPITA, 20000.0)):
                value = None if (iso, code, year) == ("BRA", kpis.POVERTY, 2016) else float(np.round(rng.uniform(0, high), 3))
                rows.append((iso, name, code, code.lower(), year, value))
    return pd.DataFrame(rows, columns=["country_code", "country_name", "indicator_code", "indicator_name", "date", "value"])


def _frame(spark, pdf, schema):
    """A DataFrame of a pandas frame with NaN as NULL and whole numbers as integers."""
    whole = {c.strip("`").split()[0] for c in schema.replace(" bigint", " int").split(", ") if c.endswith(" int")}
    rows = [tuple(None if pd.isna(v) else int(v) if c in whole else v for c, v in zip(pdf.columns, row)) for row in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def sources(spark):
    coverage = _frame(spark, landed_coverage(), "ISO3 string, Country string, `Residence Type` string, `Service Type` string, Year bigint, Coverage double, Population double, `Service level` string")
    climate = _frame(spark, daily_climate(),
                     "country_iso3 string, province string, year int, month int, temperature_2m_max double, temperature_2m_min double, precipitation_sum double, et0_fao_evapotranspiration double")
    indicators = _frame(spark, landed_indicators(),
                        "country_code string, country_name string, indicator_code string, indicator_name string, date bigint, value double")
    cleaned = {"coverage": cleaning.clean_coverage(coverage), "climate": cleaning.clean_climate(climate), "indicators": cleaning.clean_indicators(indicators)}
    return {name: df.cache() for name, df in cleaned.items()}


@pytest.fixture(scope="module")
def model(sources):
    dims = star.build_dims(sources)
    return {name: df.cache() for name, df in {**dims, **star.build_facts(sources, dims)}.items()}


@pytest.fixture(scope="module")
def pandas_coverage(sources):
    pdf = sources["coverage"].toPandas()
    pdf["coverage_pct"] = pdf["coverage_pct"].astype(float)
    return pdf


def test_clean_coverage(sources, pandas_coverage):
    raw = landed_coverage()
    assert len(pandas_coverage) == len(raw) - 3  # copy, negative, foreign residence
    unknown = pandas_coverage[(pandas_coverage.service_type_desc == "hygiene")]
    assert list(unknown.coverage_pct) == [0.0] and list(unknown.population_total) == [0]
    assert set(pandas_coverage.residence_type_code) == {"TOT", "URB", "RUR"}


def test_clean_climate(sources):
    monthly = sources["climate"].toPandas()
    assert len(monthly) == 2 * 3 * 8 * 12
    raw = daily_climate().dropna(subset=["year"])
    raw["precipitation_sum"] = raw["precipitation_sum"].fillna(0)
    expected = raw.groupby(["province", "year", "month"])["precipitation_sum"].sum().round(2)
    got = monthly.set_index(["province_name", "year", "month"])["precip_total_mm"]
    assert np.allclose(got.loc[list(expected.index)], expected)
    assert (monthly.dry_month_flag == (monthly.precip_total_mm < 10)).all() and (monthly.et0_total_mm == 5.0).all()


def test_facts_resolve_every_key(model):
    for fact in star.FACTS:
        df = model[fact]
        keys = star.FACT_GRAIN[fact]
        rows = df.select(*keys, df.columns[0]).toPandas()
        assert rows[[k for k in keys if (fact, k) != ("climate_annual", "x")]].notna().all().all(), fact
        assert not rows.duplicated(keys).any() and rows[df.columns[0]].is_unique, fact


def test_stored_schemas_match_the_builders(model, spark):
    for name, ddl in star.schemas().items():
        declared = {f.name: f.dataType for f in spark.createDataFrame([], ddl).schema}
        assert declared == {f.name: f.dataType for f in model[name].schema}, name


def test_kpi_01(model, pandas_coverage):
    got = kpis.kpi_01(model).toPandas()
    water = pandas_coverage[(pandas_coverage.service_type_desc == "drinking water") & (pandas_coverage.service_level_desc == "at least basic")
                            & pandas_coverage.residence_type_desc.isin(["urban", "rural"]) & pandas_coverage.country_iso3.isin(["MEX", "ARG"])]
    rain = model["climate_annual"].join(model["country"], "country_key").toPandas()
    rain["rain"] = rain["precip_total_mm_year"].astype(float)
    both = water.merge(rain[["country_iso3", "year", "rain"]], on=["country_iso3", "year"]).sort_values("year")
    groups = both.groupby(["country_name", "residence_type_desc"])
    both["dr"], both["dw"] = groups["rain"].diff(), groups["coverage_pct"].diff()
    both = both.dropna(subset=["dr", "dw"])
    assert len(got) == len(both) == 4 * 5
    for (country, residence), part in both.groupby(["country_name", "residence_type_desc"]):
        ours = got[(got.country_name == country) & (got.residence_type_desc == residence)]
        r = np.corrcoef(part.dr, part.dw)[0, 1]
        assert np.allclose(ours.corr_precip_vs_water, r) and (ours.years_observed == 5).all()
        assert set(ours.risk_level) == {"green" if abs(r) < 0.3 else "yellow" if abs(r) < 0.6 else "red"}
        assert set(ours.impact_direction) == {"direct" if r >= 0.2 else "inverse" if r <= -0.2 else "uncertain"}


def test_kpi_02(model, pandas_coverage):
    got = kpis.kpi_02(model).toPandas().sort_values(["country_name", "residence_type_desc", "year"])
    rows = pandas_coverage[(pandas_coverage.service_type_desc == "drinking water") & (pandas_coverage.service_level_desc == "limited service")
                           & pandas_coverage.residence_type_desc.isin(["urban", "rural"])].sort_values(["country_name", "residence_type_desc", "year"])
    rows["d"] = rows.groupby(["country_name", "residence_type_desc"])["coverage_pct"].diff()
    rows = rows.dropna(subset=["d"])
    assert np.allclose(got.delta_pct_over_30min_pp, rows.d) and np.allclose(got.pct_over_30min, rows.coverage_pct)
    assert list(got.risk_level) == ["green" if p <= 5 else "yellow" if p <= 20 else "red" for p in rows.coverage_pct]
    assert list(got.mobility_trend) == ["worsened" if d > 0.5 else "improved" if d < -0.5 else "stable" for d in rows.d]


def test_kpi_03(model, sources, pandas_coverage):
    got = kpis.kpi_03(model).toPandas()
    bad = pandas_coverage[(pandas_coverage.service_type_desc == "sanitation") & (pandas_coverage.residence_type_desc == "urban")
                          & pandas_coverage.service_level_desc.isin(["limited service", "unimproved", "open defecation"])]
    basic = 100 - bad.groupby(["country_name", "year"])["coverage_pct"].sum()
    rain = sources["climate"].toPandas()
    rain = rain[rain.year.between(2015, 2020)].groupby(["province_name", "year"])["precip_total_mm"].sum().reset_index()
    assert len(got) == len(rain) == 6 * 6
    for province, part in rain.groupby("province_name"):
        r = np.corrcoef(part.year, part.precip_total_mm)[0, 1]
        trend = "decreasing" if r <= -0.3 else "increasing" if r >= 0.3 else "stable"
        ours = got[got.province_name == province].sort_values("year")
        assert set(ours.climate_trend) == {trend} and np.allclose(ours.precip_total_mm_year, part.sort_values("year").precip_total_mm)
        expected = [basic[(row.country_name, row.year)] for row in ours.itertuples()]
        assert np.allclose(ours.sanitation_basic_pct, expected)
        assert list(ours.is_critical_zone) == [b < 80 and trend == "decreasing" for b in expected]


def test_kpi_04(model, pandas_coverage):
    got = kpis.kpi_04(model).toPandas().set_index(["country_name", "year"])
    rows = pandas_coverage[(pandas_coverage.service_type_desc == "sanitation") & (pandas_coverage.residence_type_desc == "total")
                           & pandas_coverage.service_level_desc.isin(["basic service", "safely managed service"])]
    covered = rows.groupby(["country_name", "year"])["coverage_pct"].sum()
    facts = landed_indicators().pivot_table(index=["country_name", "date"], columns="indicator_code", values="value")
    assert len(got) == 18 and got.loc[("Brazil", 2016), "poverty_rate"] is None
    for key, row in got.iterrows():
        mortality, poverty = facts.loc[key, kpis.CHILD_MORTALITY], facts.loc[key, kpis.POVERTY]
        norm = lambda v, high: 0.0 if np.isnan(v) else min(1.0, max(0.0, v / high))
        index = 0.5 * norm(100 - covered[key], 100) + 0.3 * norm(round(mortality, 3), 150) + 0.2 * norm(round(poverty, 2), 100)
        assert float(row.health_risk_index) == pytest.approx(round(index, 3) * 100, abs=0.11)
        value = float(row.health_risk_index)
        assert row.risk_level == ("Rojo" if value > 40 else "Amarillo" if value > 20 else "Verde")


def test_kpi_05_and_missing_side(model, pandas_coverage):
    got = kpis.kpi_05(model).toPandas().set_index(["country_name", "year"])
    rows = pandas_coverage[(pandas_coverage.service_type_desc == "drinking water") & pandas_coverage.service_level_desc.isin(["basic service", "safely managed service"])]
    wide = rows.pivot_table(index=["country_name", "year"], columns="residence_type_desc", values="coverage_pct", aggfunc="sum")
    for key, row in got.iterrows():
        gap = round(wide.loc[key, "urban"] - wide.loc[key, "rural"], 2)
        assert float(row.gap_urban_rural_pp) == pytest.approx(gap)
        assert row.risk_level == ("Rojo" if abs(gap) >= 20 else "Amarillo" if abs(gap) >= 10 else "Verde")
    one_sided = dict(model)
    rural = [r.residence_type_key for r in model["residence_type"].where("residence_type_desc = 'rural'").collect()][0]
    one_sided["wash_coverage"] = model["wash_coverage"].where(f"residence_type_key <> {rural}")
    zero = kpis.kpi_05(one_sided).toPandas()
    assert (zero.gap_urban_rural_pp.astype(float) == zero.water_urban_pct.astype(float)).all() and zero.water_rural_pct.isna().all()
    assert kpis.kpi_05(one_sided, kpis.UrbanRuralGap(missing="null")).toPandas().gap_urban_rural_pp.isna().all()


def test_kpi_06(model, pandas_coverage):
    got = kpis.kpi_06(model).toPandas().set_index("year")
    rows = pandas_coverage[(pandas_coverage.service_type_desc == "drinking water") & (pandas_coverage.residence_type_desc == "total")
                           & pandas_coverage.service_level_desc.isin(["basic service", "safely managed service"])]
    water = rows.groupby(["country_iso3", "year"])["coverage_pct"].sum().reset_index()
    gdp = landed_indicators().query("indicator_code == @kpis.GDP_PER_CAPITA")
    both = water.merge(gdp, left_on=["country_iso3", "year"], right_on=["country_code", "date"])
    assert set(got.region_name) == {star.REGION}
    for year, part in both.groupby("year"):
        r = np.corrcoef(part.coverage_pct, part.value)[0, 1]
        row = got.loc[year]
        assert float(row.corr_water_vs_gdp) == pytest.approx(r, abs=6e-4) and row.n_countries == 3
        assert row.risk_level == ("Rojo" if abs(r) >= 0.6 else "Amarillo" if abs(r) >= 0.3 else "Verde")


def test_kpi_07(model, pandas_coverage):
    got = kpis.kpi_07(model).toPandas().set_index(["country_name", "year"])
    rows = pandas_coverage[(pandas_coverage.residence_type_desc == "total") & pandas_coverage.service_level_desc.isin(["basic service", "safely managed service"])]
    wide = rows.pivot_table(index=["country_name", "year"], columns="service_type_desc", values="coverage_pct", aggfunc="sum")
    assert len(got) == 18
    for key, row in got.iterrows():
        gap = round(wide.loc[key, "drinking water"] - wide.loc[key, "sanitation"], 2)
        assert float(row.gap_water_sanitation_pp) == pytest.approx(gap)
        assert row.risk_level == ("Rojo" if abs(gap) >= 15 else "Amarillo" if abs(gap) >= 10 else "Verde")


def test_no_rows_give_an_empty_typed_result(model):
    for name, kpi in kpis.KPIS.items():
        empty = {k: (df.where("1 = 0") if k == "wash_coverage" else df) for k, df in model.items()}
        assert kpi(empty).count() == 0 and kpi(empty).schema == kpi(model).schema, name


def test_facts_with_a_date_key_only(model):
    keyed = {k: (df.drop("year") if k in star.FACTS else df) for k, df in model.items()}
    for name, kpi in kpis.KPIS.items():
        assert kpi(keyed).count() == kpi(model).count(), name


def test_registry_covers_the_questions(sources):
    counts = registry.evaluate(sources["coverage"]).groupBy("metric").count().toPandas().set_index("metric")["count"]
    assert counts.to_dict() == {"p1_agua_segura_rur_urb": 36, "p2_movilidad_limitada": 18, "p3_4_riesgo_sanitario": 18,
                                "p5_agua_segura_brecha": 36, "p6_agua_segura_total": 18, "p7_saneamiento_seg_total": 36}
    assert registry.as_rows(sources["coverage"].sparkSession).count() == len(registry.METRICS)


def test_exploration_on_survey_names(sources, pandas_coverage):
    assert exploration.safe_water_trend(sources["coverage"]).count() == 18
    people = exploration.limited_water_population(sources["coverage"]).toPandas()
    limited = pandas_coverage[(pandas_coverage.service_type_desc == "drinking water") & (pandas_coverage.service_level_desc == "limited service")]
    expected = (limited.population_total * limited.coverage_pct / 100).sum()
    assert float(people.limited_water_population.sum()) == pytest.approx(expected)
    assert exploration.high_risk_sanitation(sources["coverage"]).count() == 18


def test_maps(spark):
    df = spark.createDataFrame([("Mexico", "Oaxaca"), ("Mexico", "Nowhere"), ("Atlantis", "Oaxaca")], "country_name string, province_name string")
    assert values(places.on_country_map(df), "province_name", "lat") == [("Nowhere", 23.0), ("Oaxaca", 23.0)]
    assert values(places.on_province_map(df), "province_name", "lon") == [("Oaxaca", -96.5)]
    assert places.countries(spark).count() == 33 and places.provinces(spark).count() == 55


def test_summaries_run_on_survey_names(model):
    zones = summaries.zone_summary(kpis.kpi_01(model)).toPandas()
    assert len(zones) == 4 and set(zones.area) == {"Mexico – urban", "Mexico – rural", "Argentina – urban", "Argentina – rural"}
    assert summaries.regional_change(kpis.kpi_05(model), "gap_urban_rural_pp").count() == 1
    assert {"Regional", star.REGION} == set(summaries.income_regions(kpis.kpi_06(model)).toPandas().region_name)
