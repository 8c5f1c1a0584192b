import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from caudal.plans import cleaning, contracts
from caudal.plans.refresh import Layers, run_job
from caudal.session import new_table_path, shared_folder
from caudal.sources import readers, writers
from caudal.streaming.landing import refresh_from_landing

from conftest import values


def test_roots(spark, new_path):
    base = new_path("open_meteo")
    for iso in ("ARG", "MEX"):
        spark.range(3).select(F.lit("p").alias("province"), F.col("id").alias("year"), F.lit(1.0).alias("extra")).write.parquet(f"{base}/{iso}/year=2020")
    out = readers.read_roots(spark, [f"{base}/ARG", f"{base}/MEX"], ["province", "year"], r"/([A-Z]{3})/", "country_iso3")
    assert values(out.groupBy("country_iso3").count()) == [("ARG", 3), ("MEX", 3)] and "extra" not in out.columns
    with pytest.raises(AnalysisException):
        readers.read_roots(spark, [f"{base}/ARG", f"{base}/BRA"])
    assert readers.read_roots(spark, [f"{base}/ARG", f"{base}/BRA"], on_missing="skip").count() == 3
    with pytest.raises(ValueError, match="none of the roots"):
        readers.read_roots(spark, [f"{base}/BRA"], on_missing="skip")


def test_only_asked_columns_are_scanned(spark, new_path):
    base = new_path()
    spark.range(3).select("id", F.lit("x").alias("wide")).write.parquet(f"{base}/a")
    plan = readers.read_roots(spark, [f"{base}/a"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_glob_keeps_file_columns(spark, new_path):
    base = new_path()
    spark.createDataFrame([("ARG", 2001, "ARG", 2001), ("MEX", 2002, "MEX", 2002)], "ISO3 string, Year int, country string, y int").write.partitionBy("country", "y").parquet(base)
    out = readers.read_glob(spark, f"{base}/country=*/y=*")
    assert out.columns == ["ISO3", "Year"] and values(out) == [("ARG", 2001), ("MEX", 2002)]


def test_delimited(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "jmp.csv").write_text("ISO3,Country,Residence Type,Service Type,Year,Coverage,Population,Service level\nARG,Argentina,total,Sanitation,2020,12.5,100,Basic service\n")
    row = readers.read_delimited(spark, str(tmp_path), contracts.COVERAGE_LANDED.schema).first()
    assert (row.ISO3, row.Year, row.Coverage, row["Service level"]) == ("ARG", 2020, 12.5, "Basic service")


def test_delimited_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,Year,ISO3\nMexico,x,MEX\n")
    row = readers.read_delimited(spark, str(tmp_path), "ISO3 string, Country string, Year int").first()
    assert (row.ISO3, row.Country, row.Year) == ("MEX", "Mexico", None)
    with pytest.raises(ValueError, match="missing in the header: Coverage"):
        readers.read_delimited(spark, str(tmp_path), "ISO3 string, Coverage double")
    (tmp_path / "b.csv").write_text("ISO3,Country,Year\nARG,Argentina,2020\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_delimited(spark, str(tmp_path), "ISO3 string, Country string, Year int").collect()


def test_malformed_payloads_do_not_vanish(spark):
    good, cut = json.dumps([{"page": 1}, [{"date": "2000", "value": 1.5}]]), '[{"page": 2}, [{"date": "2001", "val'
    df = spark.createDataFrame([(good,), (cut,), (None,)], "payload string")
    args = ("payload", "struct<date: string, value: double>", {"date": "date"})
    with pytest.raises(Exception, match="malformed payload"):
        readers.flatten_pages(df, *args).collect()
    assert values(readers.flatten_pages(df, *args, on_malformed="skip")) == [("2000",)]
    assert df.where(readers.is_malformed("payload")).count() == 1
    days = spark.createDataFrame([('{"daily": {"time": ["2024-01-01"',)], "payload string")
    with pytest.raises(Exception, match="malformed payload"):
        readers.flatten_arrays(days, "payload", "daily", {"time": "string"}).collect()


def test_a_period_of_which_nothing_is_left_becomes_empty(spark, new_path):
    path, keys = new_path(), ["year", "month"]
    rows = spark.createDataFrame([(2000, 1, "a"), (2001, 1, "b"), (2001, 2, "c")], "year int, month int, v string")
    writers.write_partitions(rows, path, keys)
    read = lambda: values(spark.read.schema("v string, year int, month int").parquet(path), *keys, "v")
    assert writers.replace_period(rows.where("month = 2"), path, keys, {"year": 2001}) == 1
    assert read() == [(2000, 1, "a"), (2001, 2, "c")]
    assert writers.replace_period(rows.where("false"), path, keys, {"year": 2001, "month": 2}) == 0
    assert read() == [(2000, 1, "a")]
    with pytest.raises(ValueError, match="first of"):
        writers.replace_period(rows, path, keys, {"month": 1})


def test_pages(spark, tmp_path):
    record = lambda y, v: {"countryiso3code": "ARG", "country": {"id": "AR", "value": "Argentina"}, "indicator": {"id": "X.Y", "value": "name"}, "date": y, "value": v}
    (tmp_path / "p1.json").write_text(json.dumps([{"page": 1, "pages": 2}, [record("2000", 1.5), record("n/a", None)]], indent=1))
    (tmp_path / "p2.json").write_text(json.dumps([{"message": "no data"}]))
    docs = readers.read_documents(spark, str(tmp_path))
    flat = readers.flatten_pages(docs, "payload", "struct<countryiso3code: string, country: struct<value: string>, indicator: struct<id: string, value: string>, date: string, value: double>",
                                 {"country_code": "countryiso3code", "country_name": "country.value", "indicator_code": "indicator.id", "indicator_name": "indicator.value", "date": "date", "value": "value"})
    assert flat.count() == 2
    assert values(cleaning.clean_indicators(flat)) == [("ARG", 2000, "X.Y", "name", 1.5)]


def test_nanosecond_timestamps(spark, tmp_path):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    from caudal.functions.dates import timestamp_of_nanos

    pq.write_table(pa.table({"date": pa.array([datetime.datetime(2024, 3, 1, 12)], pa.timestamp("ns"))}), tmp_path / "w.parquet", version="2.6")
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = spark.read.parquet(str(tmp_path))
        assert str(df.select(timestamp_of_nanos("date")).first()[0]) == "2024-03-01 12:00:00"
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_arrays_keep_unknown_elements(spark):
    payload = json.dumps({"daily": {"time": ["2024-01-01", "2024-01-02"], "precipitation_sum": [1.5, None]}})
    df = spark.createDataFrame([("Salta", payload), ("Jujuy", json.dumps({"error": "x"}))], "province string, payload string")
    out = readers.flatten_arrays(df, "payload", "daily", {"time": "string", "precipitation_sum": "double"}, {"time": "date"}, ["province"])
    assert values(out, "province", "date", "precipitation_sum") == [("Salta", "2024-01-01", 1.5), ("Salta", "2024-01-02", None)]


def test_dynamic_static_and_append(spark, new_path):
    df = spark.createDataFrame([(2000, "a"), (2001, "b")], "year int, v string")
    path = new_path()
    assert writers.write_partitions(df, path, ["year"]) == 2
    writers.write_partitions(df.where("year = 2001").withColumn("v", F.lit("B")), path, ["year"])
    assert values(spark.read.parquet(path), "year", "v") == [(2000, "a"), (2001, "B")]
    assert writers.write_partitions(df.where("year = 9"), path, ["year"]) == 0
    assert spark.read.parquet(path).count() == 2
    writers.write_partitions(df, path, ["year"], "append")
    assert spark.read.parquet(path).count() == 4
    writers.write_partitions(df.where("year = 2000"), path, ["year"], "static")
    assert values(spark.read.parquet(path), "year") == [2000]
    with pytest.raises(ValueError):
        writers.write_partitions(df, path, ["year"], "other")


def test_declared_sink_and_job(spark, new_path):
    sink = writers.Sink(new_path(), ("year",), (("iso", ("ARG", "MEX")),))
    df = spark.createDataFrame([("ARG", 2000), ("BRA", 2000)], "iso string, year int")
    assert run_job(lambda: df, lambda d: d, sink) == 1
    assert values(spark.read.parquet(sink.path), "iso") == ["ARG"]

    def check(landed):
        raise ValueError("stop")

    with pytest.raises(ValueError, match="stop"):
        run_job(lambda: df, lambda d: d, sink, check)


def test_shared_folder_is_the_clusters(spark):
    assert new_table_path(spark, "x").startswith(shared_folder(spark)) and new_table_path(spark, "x") != new_table_path(spark, "x")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_layers_declare_their_layout():
    layers = Layers("/base/")
    assert layers.sink("clean", "climate") == writers.Sink("/base/clean/climate", ("year", "month"))
    assert layers.sink("model", "wash_coverage").keys == ("year",) and layers.sink("model", "country").keys == ()


def test_streamed_landing_equals_batch(spark, new_path):
    landing, target, checkpoint = new_path("landing"), new_path("target"), new_path("ckpt")
    schema = "province string, day string, rain double, year int, month int"
    rows = [("a", f"2024-0{m}-0{d}", float(m * d), 2024, m) for m in (1, 2, 3) for d in (1, 2)]
    clean = lambda df: df.groupBy("province", "year", "month").agg(F.sum("rain").alias("rain"))
    land = lambda part: writers.write_partitions(spark.createDataFrame(part, schema), landing, ["year", "month"], "append")
    run = lambda: refresh_from_landing(spark, landing, schema, clean, target, ["year", "month"], checkpoint)

    land(rows[:3])
    assert run() == 1
    land(rows[3:])  # February is completed, March is new
    assert run() == 1 and run() == 0
    expected = clean(spark.createDataFrame(rows, schema))
    assert values(spark.read.parquet(target), "province", "year", "month", "rain") == values(expected, "province", "year", "month", "rain")


def test_touched_partitions_prune_the_landing(spark, new_path):
    from caudal.streaming.landing import read_folders

    landing = new_path()
    writers.write_partitions(spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("k")), landing, ["k"])
    pruned = read_folders(spark, landing, "id bigint, k int", [f"{landing}/k=3"])
    assert pruned.count() == 10 and len(pruned.select("_metadata.file_path").distinct().collect()) == 1
    assert values(pruned.select("k").distinct()) == [(3,)] and [f.rsplit("/", 2)[1] for f in pruned.inputFiles()] == ["k=3"]
