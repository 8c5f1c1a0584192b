"""Landing folders to stored indicators, whole and one period at a time."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from caudal import jobs
from caudal.plans import cleaning, ingest, kpis, landed, star
from caudal.plans.refresh import Layers, foreign_key_report, read_clean, read_gold, read_model, refresh_clean, refresh_star, require_resolved_keys

from conftest import values
from test_wash import _frame, daily_climate, landed_coverage, landed_indicators


def land(spark, landing):
    coverage = _frame(spark, landed_coverage(), "ISO3 string, Country string, `Residence Type` string, `Service Type` string, Year bigint, Coverage double, Population double, `Service level` string")
    keyed = coverage.select("*", F.col("ISO3").alias("folder"), F.col("Year").alias("period"))
    for iso in ("MEX", "ARG", "BRA"):
        for year in range(2015, 2021, 3):
            part = keyed.where(f"folder = '{iso}' AND period BETWEEN {year} AND {year + 2}").drop("folder", "period")
            part.coalesce(1).write.parquet(f"{landing}/jmp/country={iso}/year={year}")
    indicators = _frame(spark, landed_indicators(), "country_code string, country_name string, indicator_code string, indicator_name string, date bigint, value double")
    indicators.coalesce(1).write.parquet(f"{landing}/world_bank/country=all/year=all")
    climate = _frame(spark, daily_climate().dropna(subset=["year"]), "country_iso3 string, province string, year int, month int, temperature_2m_max double, temperature_2m_min double, precipitation_sum double, et0_fao_evapotranspiration double")
    dated = climate.withColumn("date", F.make_timestamp("year", "month", F.lit(15), F.lit(0), F.lit(0), F.lit(0))).drop("year", "month")
    for iso in ("MEX", "ARG"):
        dated.where(f"country_iso3 = '{iso}'").drop("country_iso3").coalesce(1).write.parquet(f"{landing}/open_meteo/{iso}/province=any")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    landing, root = f"{base}/bronze", f"{base}/lake"
    land(spark, landing)
    return landing, root, jobs.run(spark, "all", root, landing)


def snapshot(spark, root, table):
    df = read_model(spark, Layers(root))[table]
    return values(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]))


def test_all_layers_are_written(spark, built):
    landing, root, written = built
    assert written["clean"] == {"coverage": 487, "indicators": 71, "climate": 576}
    assert written["star"]["wash_coverage"] == 487 and written["star"]["climate_annual"] == 16 and written["star"]["date"] == 2922
    assert written["gold"]["kpi_01"] == 20 and written["gold"]["kpi_04"] == 18 and set(written["gold"]) == set(kpis.KPIS)
    report = foreign_key_report(read_model(spark, Layers(root))).collect()
    assert [r for r in report if r.n_bad] == []
    assert read_gold(spark, Layers(root), "kpi_05", limit=3).count() == 3


def test_rerun_and_one_period_leave_the_same_tables(spark, built):
    landing, root, _ = built
    before = {t: snapshot(spark, root, t) for t in (*star.DIMENSIONS, *star.FACTS)}
    gold = {k: values(read_gold(spark, Layers(root), k).select(*[F.col(c).cast("string") for c in read_gold(spark, Layers(root), k).columns])) for k in kpis.KPIS}
    written = jobs.run(spark, "all", root, landing, year=2018)
    assert written["star"]["wash_coverage"] < 487
    jobs.run(spark, "clean", root, landing, year=2018, month=6)
    jobs.run(spark, "star", root, year=2018)
    assert {t: snapshot(spark, root, t) for t in before} == before
    for k, rows in gold.items():
        again = read_gold(spark, Layers(root), k)
        assert len(values(again)) == len(rows), k


def test_one_month_replaces_one_month(spark, built):
    landing, root, _ = built
    written = jobs.run(spark, "clean", root, landing, year=2018, month=6)
    assert written["clean"]["climate"] == 6  # one row per province
    assert read_clean(spark, Layers(root))["climate"].count() == 576


def test_report_on_the_landed_sources(spark, built):
    rows = {(r.source, r.check_name, r.column_name): r.n_bad for r in landed.report(spark, built[0]).collect()}
    assert rows[("coverage", "duplicate_row", "*")] == 1 and rows[("coverage", "negative", "coverage_pct")] == 1
    assert rows[("coverage", "null", "coverage_pct")] == 1 and rows[("indicators", "null", "indicator_value")] == 1
    assert rows[("climate", "null", "year")] == 0 and rows[("indicators", "negative", "indicator_value")] == 0


def test_a_retracted_year_goes_from_all_layers(spark, tmp_path):
    landing, root = f"{tmp_path}/bronze", f"{tmp_path}/lake"
    land(spark, landing)
    jobs.run(spark, "all", root, landing)
    layers = Layers(root)
    gone = {name: df.where("year <> 2019") for name, df in landed.cleaned(spark, landing).items()}
    refresh_clean(layers, gone, year=2019)
    refresh_star(spark, layers, year=2019)
    for name in star.FACTS:
        years = values(read_model(spark, layers)[name].select("year").distinct())
        assert (2019,) not in years and (2018,) in years, name


def test_every_landed_country_is_read(spark, built, tmp_path):
    landing = built[0]
    other = f"{tmp_path}/bronze"
    for iso in ("ARG", "MEX", "BRA"):
        rows = spark.read.parquet(f"{landing}/open_meteo/MEX").withColumn("date", F.unix_micros(F.col("date").cast("timestamp")))
        rows.write.parquet(f"{other}/open_meteo/{iso}/province=any")
    read = landed.read_climate(spark, other)
    assert values(read.select("country_iso3").distinct()) == [("ARG",), ("BRA",), ("MEX",)]
    assert read.where("year is null").count() == 0 and cleaning.clean_climate(read).count() > 0
    with pytest.raises(AnalysisException):
        landed.read_climate(spark, other, ["MEX", "CHL"])


def test_one_year_of_the_survey_reads_its_folders_only(spark, built):
    files = landed.read_coverage(spark, built[0], 2018).select("_metadata.file_path").distinct().collect()
    assert len(files) == 3 and all("year=2018" in r.file_path for r in files)


def test_unresolved_rows_keep_ids_of_their_own_and_stop_the_indicators(spark, built):
    layers = Layers(built[1])
    sources = read_clean(spark, layers)
    dims = {name: layers.read(spark, "model", name) for name in star.DIMENSIONS}
    facts = star.build_facts(sources, {**dims, "province": dims["province"].where("false")})["climate_monthly"]
    assert facts.where("province_key is not null").count() == 0
    assert facts.select("climate_monthly_id").distinct().count() == facts.count() == 576
    model = {**{n: read_model(spark, layers)[n] for n in (*star.DIMENSIONS, *star.FACTS)}, "climate_monthly": facts}
    with pytest.raises(ValueError, match="province_key: 576 of 576"):
        require_resolved_keys(model)
    with pytest.raises(Exception, match="duplicate key in lookup"):
        star.build_facts(sources, {**dims, "country": dims["country"].union(dims["country"])})["wash_coverage"].collect()


def test_raw_files_land_and_are_cleaned(spark, tmp_path):
    raw, landing = tmp_path / "raw", f"{tmp_path}/bronze"
    for folder in ("jmp", "world_bank", "open_meteo/MEX", "open_meteo/BRA"):
        (raw / folder).mkdir(parents=True)
    (raw / "jmp" / "a.csv").write_text("Year,ISO3,Country,Residence Type,Service Type,Coverage,Population,Service level\n2020,MEX,Mexico,total,Sanitation,12.5,100,Basic service\n2021,BRA,Brazil,total,Sanitation,50,10,Basic service\n")
    record = lambda y, v: {"countryiso3code": "MEX", "country": {"value": "Mexico"}, "indicator": {"id": "X", "value": "name"}, "date": y, "value": v}
    (raw / "world_bank" / "p1.json").write_text(json.dumps([{"page": 1}, [record("2020", 1.5), record("2021", 2.5)]]))
    day = {"daily": {"time": ["2020-01-01", "2020-02-01"], "temperature_2m_max": [1.0, 2.0], "temperature_2m_min": [0.0, None], "precipitation_sum": [3.0, 4.0], "et0_fao_evapotranspiration": [1.0, 1.0]}}
    for place in ("MEX/Nuevo Leon", "BRA/Bahia"):
        (raw / "open_meteo" / f"{place}.json").write_text(json.dumps(day))
    for _ in range(2):  # landing again changes nothing
        assert ingest.land(spark, str(raw), landing) == {"survey": 2, "indicators": 2, "climate": 4}
    clean = landed.cleaned(spark, landing)
    assert values(clean["coverage"].select("country_iso3", "year")) == [("BRA", 2021), ("MEX", 2020)]
    assert values(landed.cleaned(spark, landing, year=2020)["coverage"].select("country_iso3")) == [("MEX",)]
    assert values(clean["indicators"].select("country_iso3", "year", "indicator_value")) == [("MEX", 2020, 1.5), ("MEX", 2021, 2.5)]
    assert values(clean["climate"].select("country_iso3", "province_name", "month", "precip_total_mm"))[0] == ("BRA", "Bahia", 1, 3.0) and clean["climate"].count() == 4
    assert values(landed.read_climate(spark, landing, ["MEX"]).select("province").distinct()) == [("Nuevo Leon",)]


def test_clean_needs_a_landing_root(spark, tmp_path):
    with pytest.raises(ValueError, match="landing root"):
        jobs.run(spark, "clean", str(tmp_path))


def test_literal_mode_adds_up_all_residences(spark, built):
    model = read_model(spark, Layers(built[1]))
    one = kpis.kpi_07(model).toPandas().set_index(["country_name", "year"])
    everything = kpis.Pick(kpis.WATER, (kpis.BASIC, kpis.SAFE), None)
    all_three = kpis.kpi_07(model, kpis.WaterSanitationGap(water=everything)).toPandas().set_index(["country_name", "year"])
    assert (all_three.water_basic_safe_pct.loc[one.index] >= one.water_basic_safe_pct).all()
