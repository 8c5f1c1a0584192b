"""Failed refreshes leave stored data alone; periods, layouts and schemas of a landing."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from caudal import jobs
from caudal.operators.filters import Audit
from caudal.operators.profile import file_listing
from caudal.plans import cleaning, ingest, kpis, landed, star
from caudal.plans.refresh import Layers, read_clean, read_gold, read_model, refresh_clean, refresh_gold, refresh_star
from caudal.sources import readers, writers
from caudal.sources.publish import Publication, recover
from caudal.streaming.landing import refresh_from_landing
from workload import lake as workload_lake

from conftest import values
from test_jobs import land

ROWS = [(2000, 1, "a"), (2000, 2, "b"), (2001, 1, "c")]
SCHEMA = "year int, month int, v string"


def failing(df):
    return df.withColumn("v", F.when(F.col("v") == "c", F.raise_error(F.lit("no good")).cast("string")).otherwise(F.lit("new")))


def hidden(path):
    parent = os.path.dirname(path)
    return [n for folder in (path, parent) if os.path.isdir(folder) for n in os.listdir(folder) if n.startswith(("_staging", "_previous"))]


def test_failed_writes_leave_the_old_rows(spark, new_path):
    df, plain, parted = spark.createDataFrame(ROWS, SCHEMA), new_path(), new_path()
    writers.write_table(df, plain)
    writers.write_partitions(df, parted, ["year"], "static")
    for write in (
        lambda: writers.write_table(failing(df), plain), lambda: writers.write_partitions(failing(df), parted, ["year"], "static"),
        lambda: writers.replace_period(failing(df).where("year = 2001"), parted, ["year"], {"year": 2001}),
    ):
        with pytest.raises(Exception, match="no good"):
            write()
    for path in (plain, parted):
        assert values(spark.read.schema(SCHEMA).parquet(path), "year", "month", "v") == ROWS and hidden(path) == []


def test_a_table_may_be_replaced_by_a_plan_that_reads_it(spark, new_path):
    path = new_path()
    writers.write_table(spark.createDataFrame(ROWS, SCHEMA), path)
    assert writers.write_table(spark.read.schema(SCHEMA).parquet(path).where("year = 2000"), path) == 2
    assert spark.read.parquet(path).count() == 2


def test_a_publication_is_one_switch(spark, new_path, monkeypatch):
    from caudal.sources.publish import Files

    first, second = new_path("first"), new_path("second")
    df = spark.createDataFrame(ROWS, SCHEMA)
    writers.write_table(df, first)
    writers.write_table(df, second)
    move = Files.move

    def broken(self, source, target):
        if target == second and "_staging" in source:
            raise OSError("the store is away")
        move(self, source, target)

    monkeypatch.setattr(Files, "move", broken)
    with pytest.raises(OSError, match="away"), Publication(spark) as publication:
        publication.stage(df.where("year = 2000"), first)
        publication.stage(df.where("year = 2000"), second)
        assert publication.read(first, SCHEMA).count() == 2 and spark.read.parquet(first).count() == 3
    assert [spark.read.parquet(p).count() for p in (first, second)] == [3, 3] and hidden(first) == []


def test_an_interrupted_switch_is_taken_back(spark, tmp_path):
    path = f"{tmp_path}/layer/table"
    writers.write_table(spark.createDataFrame(ROWS, SCHEMA), path)
    os.makedirs(f"{tmp_path}/layer/_previous-abc")
    shutil.copytree(path, f"{tmp_path}/layer/_previous-abc/table")
    assert not recover(spark, path)  # the table is there
    shutil.move(path, f"{tmp_path}/elsewhere")
    assert recover(spark, path) and spark.read.parquet(path).count() == 3
    assert not recover(spark, f"{tmp_path}/layer/other")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("published")
    land(spark, f"{base}/bronze")
    jobs.run(spark, "all", f"{base}/lake", f"{base}/bronze")
    return f"{base}/bronze", f"{base}/lake"


def counts(spark, layers):
    model = read_model(spark, layers)
    return {n: model[n].count() for n in (*star.DIMENSIONS, *star.FACTS)} | {k: read_gold(spark, layers, k).count() for k in kpis.KPIS} | {
        n: df.count() for n, df in read_clean(spark, layers).items()}


def test_a_failed_refresh_leaves_every_layer(spark, lake, monkeypatch):
    layers = Layers(lake[1])
    before = counts(spark, layers)
    build = star.build_dims
    with monkeypatch.context() as patch:  # the same key twice in one dimension
        patch.setattr(star, "build_dims", lambda *a: {n: df.unionAll(df) if n == "indicator" else df for n, df in build(*a).items()})
        with pytest.raises(Exception, match="duplicate key in lookup"):
            refresh_star(spark, layers)
    facts = star.build_facts
    with monkeypatch.context() as patch:  # a fact that does not fit, when all dimensions are written
        patch.setattr(star, "build_facts", lambda *a, **k: {n: df.withColumn("year", F.when(df.year > 0, F.raise_error(F.lit("does not fit")).cast("int"))) for n, df in facts(*a, **k).items()})
        for year in (None, 2018):
            with pytest.raises(Exception, match="does not fit"):
                refresh_star(spark, layers, year)
    with monkeypatch.context() as patch:
        patch.setitem(kpis.KPIS, "kpi_07", lambda model: model["date"].select(F.raise_error(F.lit("no indicator")).cast("int").alias("x")))
        with pytest.raises(Exception, match="no indicator"):
            refresh_gold(spark, layers)
    clean = read_clean(spark, layers)
    broken = clean["climate"].withColumn("month", F.raise_error(F.lit("no month")).cast("int"))
    with pytest.raises(Exception, match="no month"):
        refresh_clean(layers, {"coverage": clean["coverage"].where("false"), "climate": broken}, year=2018)
    assert counts(spark, layers) == before


def test_one_year_reads_no_other_year(spark, lake, tmp_path):
    """Files of other years are no Parquet at all; the year's new member still reaches the dimension."""
    root = f"{tmp_path}/lake"
    shutil.copytree(lake[1], root)
    layers = Layers(root)
    before = counts(spark, layers)
    new = read_clean(spark, layers)["coverage"].where("year = 2018").limit(1).withColumns({"country_iso3": F.lit("ZZZ"), "country_name": F.lit("Nowhere")})
    rows = read_clean(spark, layers)["coverage"].where("year = 2018").unionByName(new)
    refresh_clean(layers, {"coverage": rows}, year=2018)
    for folder, _, names in os.walk(f"{root}/clean"):
        for name in names:
            if name.endswith(".parquet") and "year=2018" not in folder:
                with open(f"{folder}/{name}", "w") as f:
                    f.write("no Parquet")
                crc = f"{folder}/.{name}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
    refresh_star(spark, layers, 2018)
    model = read_model(spark, layers)
    assert model["country"].count() == before["country"] + 1 and values(model["country"].where("country_iso3 = 'ZZZ'").select("country_name")) == [("Nowhere",)]
    assert model["wash_coverage"].count() == before["wash_coverage"] + 1
    assert {n: model[n].count() for n in ("date", "province", "indicator", "climate_monthly")} == {n: before[n] for n in ("date", "province", "indicator", "climate_monthly")}


def test_clean_job_stores_what_each_step_dropped(spark, lake):
    rows = {(r.source, r.step): (r.n_rows, r.n_dropped) for r in spark.read.parquet(f"{lake[1]}/audit/clean").where("year is null").collect()}
    landed_rows = landed.read_coverage(spark, lake[0]).count()
    assert rows[("coverage", "landed")] == (landed_rows, None) and rows[("coverage", "no copies")][0] == 487
    assert sum(d or 0 for (s, _), (_, d) in rows.items() if s == "coverage") == landed_rows - 487
    assert rows[("indicators", "known value")][0] == 71 and rows[("climate", "known month")][1] == 0


def test_audit_counts_ride_along(spark):
    audit, df = Audit(), spark.range(10)
    kept = audit.count(audit.count(df, "ids", "landed").where("id > 3"), "ids", "large")
    assert kept.count() == 6
    assert sorted(map(tuple, audit.report(spark).select("step", "n_rows", "n_dropped").collect())) == [("landed", 10, None), ("large", 6, 4)]
    nothing = Audit()
    assert nothing.count(df.where("false"), "ids", "landed").count() == 0 and [r.n_rows for r in nothing.report(spark).collect()] == [0]


def test_stream_empties_a_retracted_partition(spark, new_path):
    landing, target, checkpoint = new_path("landing"), new_path("target"), new_path("ckpt")
    schema = "v string, place string, year int"

    def clean(df):
        gone = df.where("v = 'retract'").select("place", "year").distinct()
        return df.where("v <> 'retract'").join(gone, (df.place.eqNullSafe(gone.place)) & (df.year == gone.year), "left_anti").select("v", "place", "year")

    def arrive(*rows):
        writers.write_partitions(spark.createDataFrame(list(rows), schema), landing, ["place", "year"], "append")
        return refresh_from_landing(spark, landing, schema, clean, target, ["place", "year"], checkpoint)

    stored = lambda: sorted(map(tuple, spark.read.schema(schema).parquet(target).collect()), key=repr)
    assert arrive(("x", "a b/c", 2000), ("y", None, 2000), ("z", "ü+%", 2001)) == 1
    assert stored() == sorted([("x", "a b/c", 2000), ("y", None, 2000), ("z", "ü+%", 2001)], key=repr)
    assert arrive(("retract", "a b/c", 2000), ("w", "ü+%", 2001)) == 1
    assert stored() == sorted([("y", None, 2000), ("z", "ü+%", 2001), ("w", "ü+%", 2001)], key=repr)
    assert arrive(("retract", None, 2000)) == 1 and len(stored()) == 2 and hidden(target) == []
    moved = lambda df: df.withColumn("year", F.col("year") + 1)
    writers.write_partitions(spark.createDataFrame([("q", "b", 2005)], schema), landing, ["place", "year"], "append")
    with pytest.raises(Exception, match="not touched"):
        refresh_from_landing(spark, landing, schema, moved, target, ["place", "year"], checkpoint)
    assert len(stored()) == 2


def raw_files(raw):
    for folder in ("jmp", "world_bank", "open_meteo/MEX", "open_meteo/BRA"):
        (raw / folder).mkdir(parents=True)
    (raw / "jmp" / "a.csv").write_text("Year,ISO3,Country,Residence Type,Service Type,Coverage,Population,Service level\n2020,MEX,Mexico,total,Sanitation,12.5,100,Basic service\n2021,BRA,Brazil,total,Sanitation,50,10,Basic service\n")
    record = lambda y: {"countryiso3code": "MEX", "country": {"value": "Mexico"}, "indicator": {"id": "X", "value": "name"}, "date": y, "value": 1.5}
    (raw / "world_bank" / "p1.json").write_text(json.dumps([{"page": 1}, [record("2020"), record("2021")]]))
    day = {"daily": {"time": ["2020-01-01", "2021-02-01"], "temperature_2m_max": [1.0, 2.0], "temperature_2m_min": [0.0, None], "precipitation_sum": [3.0, 4.0], "et0_fao_evapotranspiration": [1.0, 1.0]}}
    for place in ("MEX/Nuevo Leon", "BRA/Bahia"):
        (raw / "open_meteo" / f"{place}.json").write_text(json.dumps(day))


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landing")
    raw_files(base / "raw")
    ingest.land(spark, str(base / "raw"), f"{base}/bronze")
    return f"{base}/bronze"


def test_one_period_prunes_all_three_sources(spark, landing):
    reads = {"coverage": landed.read_coverage(spark, landing, 2020), "indicators": landed.read_indicators(spark, landing, 2020), "climate": landed.read_climate(spark, landing, None, 2020)}
    for name, df in reads.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(period" in plan and "(period#" in plan and "= 2020)]" in plan, name
        assert df.count() == {"coverage": 1, "indicators": 1, "climate": 2}[name]
    clean = landed.cleaned(spark, landing, year=2021)
    assert {n: values(df.select("year").distinct()) for n, df in clean.items()} == {n: [(2021,)] for n in clean}
    assert values(landed.read_climate(spark, landing, ["MEX"], 2020).select("country_iso3", "province")) == [("MEX", "Nuevo Leon")]
    with pytest.raises(ValueError, match="CHL"):
        landed.read_climate(spark, landing, ["CHL"], 2020)


def test_a_year_that_has_not_landed_is_empty(spark, landing, lake, tmp_path):
    assert {n: df.count() for n, df in landed.cleaned(spark, landing, year=1999).items()} == {"coverage": 0, "indicators": 0, "climate": 0}
    assert landed.read_coverage(spark, lake[0], 1999).count() == 0
    root = f"{tmp_path}/lake"
    shutil.copytree(lake[1], root)
    jobs.run(spark, "clean", root, lake[0], year=1999)  # other years stay
    assert counts(spark, Layers(root)) == counts(spark, Layers(lake[1]))


def test_files_outside_the_layout_are_read(spark, lake, landing, tmp_path):
    other = f"{tmp_path}/bronze"
    shutil.copytree(lake[0], other)
    before = landed.read_coverage(spark, other).count()
    rows = landed.read_coverage(spark, other).where("Year = 2018").limit(2)
    rows.coalesce(1).write.parquet(f"{other}/jmp/ARG/2022")
    rows.coalesce(1).write.parquet(f"{other}/jmp/country=ARG/year=2022/late/more")
    assert landed.read_coverage(spark, other).count() == before + 4
    mine = landed.read_coverage(spark, other, 2018)
    assert mine.where("Year = 2018").count() == landed.read_coverage(spark, lake[0], 2018).where("Year = 2018").count() + 4
    keyed = f"{tmp_path}/keyed"
    shutil.copytree(landing, keyed)
    spark.read.parquet(f"{landing}/world_bank/area=MEX/period=2020").write.parquet(f"{keyed}/world_bank/by hand")
    assert landed.read_indicators(spark, keyed, 2020).where("date = 2020").count() == 2 and landed.read_indicators(spark, keyed).count() == 3


def test_opening_a_landing_opens_no_file(spark, landing, tmp_path):
    bronze = f"{tmp_path}/bronze"
    shutil.copytree(landing, bronze)
    for folder, _, names in os.walk(bronze):
        for name in names:
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "w") as f:
                    f.write("no Parquet")
    clean = landed.cleaned(spark, bronze)
    assert clean["coverage"].columns == cleaning.coverage_contract().columns and landed.cleaned(spark, bronze, year=2020)["climate"].columns == clean["climate"].columns
    with pytest.raises(Exception):
        clean["coverage"].collect()
    sizes = {os.path.join(folder, n): os.path.getsize(os.path.join(folder, n)) for folder, _, names in os.walk(bronze) for n in names if n.endswith(".parquet")}
    assert {r.file_path.removeprefix("file:"): r.size_bytes for r in file_listing(spark, bronze).collect()} == sizes


def test_schemas_of_landings_merge(spark, tmp_path):
    root = str(tmp_path)
    of = lambda ddl: spark.createDataFrame([], ddl).schema
    assert readers.stored_schema(spark, root) is None
    readers.store_schema(spark, root, of("a int, b string"))
    assert readers.store_schema(spark, root, of("c double, a int")).names == ["a", "b", "c"] == readers.stored_schema(spark, root).names
    with pytest.raises(ValueError, match="a int, now string"):
        readers.store_schema(spark, root, of("a string, d int"))
    assert readers.stored_schema(spark, root).names == ["a", "b", "c"]


def test_layers_are_built_anew_when_a_table_folder_changes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workload_lake, "_built", {})
    folder, built = f"{tmp_path}/tables", []
    build = lambda: built.append(len(built)) or Layers(f"{tmp_path}/lake-{len(built)}")
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    first = workload_lake._once(spark, folder, "clean", build)
    assert workload_lake._once(spark, folder, "clean", build) is first and len(built) == 1
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert workload_lake._once(spark, folder, "clean", build) is not first and len(built) == 2
