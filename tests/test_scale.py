"""Plans stay distributed, and hot keys change nothing but where the work is done."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caudal.operators import aggregates, joins, quality, windows
from caudal.plans.cleaning import monthly_climate
from caudal.sources import writers
from workload import bindings, lake
from workload.queries import CATALOG

D = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_plans_stay_distributed(spark, name):
    """No cross join, no Python in the plan, and no window over a whole table."""
    execution = CATALOG[name].run(spark, D)._jdf.queryExecution()
    physical = execution.executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in physical, operator
    for line in execution.optimizedPlan().toString().splitlines():
        text = line.strip(" :+-")
        if text.startswith("Window ["):
            # Window [functions], [partition keys], [order]; without keys the order comes second
            second = text.split("], [")[1]
            slice_totals = second.startswith("_slice#")  # one row per slice
            assert slice_totals or " NULLS " not in second, text


def test_filters_and_columns_reach_the_scan(spark):
    plan = CATALOG["in_list_filter"].run(spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderstatus" in plan or "In(o_orderstatus, [F,P])" in plan
    plan = CATALOG["forced_schema"].run(spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_period_slice_prunes_partitions(spark):
    plan = CATALOG["one_month_slice"].run(spark, D)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "= 1998" in filters and "= 6" in filters


def test_picked_members_reach_the_scan_as_literals(spark):
    """With stable keys an indicator filters its fact in the scan, without joining the dimension first."""
    plan = CATALOG["kpi_02_mobility"].run(spark, D)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "coverage_pct" in line)
    pushed = scan.split("PushedFilters: [")[1]
    assert "EqualTo(service_type_key," in pushed and "IsNotNull(service_level_key)" in pushed
    assert plan.count("service_type_key") and "service_type_desc" not in plan


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = CATALOG["largest_balances_by_nation"].run(spark, D)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]
    assert "TakeOrderedAndProject" in CATALOG["largest_orders"].run(spark, D)._jdf.queryExecution().executedPlan().toString()


def test_semi_join_on_partition_key_prunes_at_run_time(spark, new_path):
    path = new_path()
    writers.write_partitions(spark.range(1000).select("id", (F.col("id") % 10).alias("k")), path, ["k"])
    from caudal.operators.filters import keep_matching

    keys = new_path()
    spark.range(10).select(F.col("id").cast("int").alias("k"), F.col("id").alias("n")).write.parquet(keys)
    df = keep_matching(spark.read.parquet(path), spark.read.parquet(keys).where("n = 3"), "k")
    assert "dynamicpruningexpression" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 100


@pytest.fixture
def hot(spark):
    """60 % of the rows are one key; every key has the same values."""
    return spark.range(60_000, numPartitions=12).select(
        F.when(F.col("id") % 5 < 3, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).alias("k"),
        (F.col("id") % 40).cast("double").alias("v"), F.lit(2020).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))


def test_hot_group_shuffles_as_partial_rows(spark, hot):
    """Aggregations combine before the shuffle: a hot key costs one row per task and group."""
    daily = hot.select("k", "year", "month", F.col("v").alias("precipitation_sum"), F.lit(1.0).alias("et0_fao_evapotranspiration"),
                       F.lit(1.0).alias("temperature_2m_max"), F.lit(1.0).alias("temperature_2m_min"))
    for df in (monthly_climate(daily, ["k"]), hot.groupBy("k").agg(F.count_if(F.col("v") > 3)), aggregates.correlate(hot, ["k"], "month", "v"),
               quality.duplicate_rows(hot)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan[plan.index("Exchange hashpartitioning"):]


@pytest.mark.parametrize("salt", [1, 16])
def test_hot_key_lookup_without_broadcast(spark, hot, salt):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.range(400).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
        out = joins.attach(hot, dim, "k", ["name"], salt=salt)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 60_000 and out.where("name IS NULL").count() == hot.where("k >= 400").count()
        hottest = max(sizes)
        assert hottest >= 36_000 if salt == 1 else hottest < 30_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_positions_spread_one_hot_group(spark):
    """A group with all rows is sorted in many slices, none of which holds most of it."""
    df = spark.range(50_000).select(F.lit("g").alias("g"), F.xxhash64("id").cast("double").alias("v"))
    placed = windows.value_positions(df, "v", ["g"], 16)
    assert placed.count() == 50_000 and placed.agg(F.max("smaller")).first()[0] == 49_999
    cuts = windows._boundaries(df.select("v"), 16)
    assert len(cuts) == 15
    sizes = [df.where((F.col("v") > lo) & (F.col("v") <= hi)).count() for lo, hi in zip(cuts, cuts[1:])]
    assert max(sizes) < 2 * 50_000 / 16


def test_values_are_counted_once(spark, new_path):
    """Boundaries, totals and positions come from stored counts: the plan does not scan the input for them."""
    path = new_path("input")
    spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    positions = windows.value_positions(df, "v", ["g"])
    assert not [f for f in positions.inputFiles() if "/input" in f] and positions.count() == 1000
    quartiles = windows.quantiles_by(df, "v", {"half": 0.5}, ["g"])
    assert not [f for f in quartiles.inputFiles() if "/input" in f]
    assert {r.g: r.half for r in quartiles.collect()} == {0: 499.5, 1: 499.0, 2: 500.0}
    ranked = windows.rank_by(df, "v", "place")._jdf.queryExecution().executedPlan().toString()
    assert ranked.count("/input") == 1


def test_hot_partition_is_written_by_several_tasks(spark, new_path):
    """The rebalance hint splits a partition that holds most of the data."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = new_path()
        rows = spark.range(400_000, numPartitions=8).select(F.xxhash64("id").alias("x"), F.when(F.col("id") % 10 < 8, 2020).otherwise(2021).alias("year"))
        assert writers.write_partitions(rows, path, ["year"], order=["x"]) == 400_000
        files = spark.read.parquet(path).groupBy("year", "_metadata.file_path").count().groupBy("year").count().collect()
        assert {r.year: r["count"] for r in files}[2020] > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_salted_lookup_is_not_broadcast(spark):
    """The lookup looks small before its rows are repeated; all copies of it are not built in one task."""
    df = spark.range(1000).select((F.col("id") % 7).alias("k"))
    dim = spark.range(5).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    out = joins.attach(df, dim, "k", ["name"], verify=True, salt=8)
    assert out.where("name = concat('n', k)").count() == 715 and out.count() == 1000
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("query", "built"), [
    ("dim_residence_type", ["clean/coverage", "model/residence_type"]),
    ("dictionary_of_stored_table", ["clean/indicators"]),
    ("clean_climate", ["clean/climate"]),
    ("coverage_grain_and_range", ["clean/coverage"]),
    ("mobility_by_year", ["clean/coverage", "gold/kpi_02", "model/country", "model/date", "model/residence_type", "model/service_level", "model/service_type", "model/wash_coverage"]),
])
def test_only_the_tables_asked_for_are_built(spark, monkeypatch, query, built):
    monkeypatch.setattr(lake, "_built", {})
    assert CATALOG[query].run(spark, D).count() > 0
    root = Path(lake._layers(spark, D).root.removeprefix("file:"))
    assert sorted(str(p.relative_to(root)) for p in root.glob("*/*")) == built


def test_calendar_has_the_years_of_the_climate(spark):
    ends = lambda df: df.agg(F.min("year"), F.max("year")).first()
    assert ends(bindings.climate_years(spark, D)) == ends(bindings.climate(spark, D))


def test_months_are_summed_after_the_shuffle(spark):
    """Rows are dealt out before any sum is begun, which would take a map task several times their size."""
    schema = "k int, year int, month int, precipitation_sum double, et0_fao_evapotranspiration double, temperature_2m_max double, temperature_2m_min double"
    rows = [(k, 2020, 1 + d % 2, 1.0, 0.5, 20.0, 10.0) for k in range(3) for d in range(10)] + [(None, 2020, 1, 2.0, None, None, None), (1, None, 1, 9.0, 9.0, 9.0, 9.0)]
    monthly = monthly_climate(spark.createDataFrame(rows, schema), ["k"])
    assert sorted((r.k is None, r.k or 0, r.month, r.precip_total_mm, r.et0_total_mm, r.temp_max_avg_c) for r in monthly.collect()) == [
        *[(False, k, m, 5.0, 2.5, 20.0) for k in range(3) for m in (1, 2)], (True, 0, 1, 2.0, 0.0, None)]
    plan = monthly._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in plan and plan.index("partial_sum") < plan.index("REPARTITION_BY_COL"), plan
