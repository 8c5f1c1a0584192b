"""A third of the orders belong to one customer and a third of the lineitems to one supplier.

Queries run with broadcasting off, so every join shuffles, and still equal their SQL.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from caudal.operators import windows
from workload.catalog import CATALOG
from workload.check import TABLES, compare

SOURCE = "/root/testdata/sf0.001"
QUERIES = [
    *[n for n in CATALOG if n.startswith("kpi_0")], "fact_climate_monthly", "fact_climate_annual", "chained_lookups", "salted_verified_lookup",
    "group_statistic_on_detail", "mixed_grain_join", "supplier_trend", "yearly_changes", "overall_ranking", "ranking_with_many_ties",
    "descriptive_statistics_by_group", "column_profile", "duplicate_rows", "repeated_keys", "unresolved_keys", "flattened_daily_arrays",
    "roots_with_key_from_path", "landing_by_country_year", "largest_balances_by_nation", "matching_keys_by_semi_join",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    hot = lambda key, *by: F.when(F.pmod(F.xxhash64(*by), F.lit(3)) == 0, F.lit(7).cast("long")).otherwise(F.col(key))
    for name in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        if name == "orders":
            df = df.withColumn("o_custkey", hot("o_custkey", "o_orderkey"))
        if name == "lineitem":
            df = df.withColumn("l_suppkey", hot("l_suppkey", "l_orderkey", "l_partkey"))
        df.coalesce(1).write.parquet(f"{d}/{name}.parquet")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet/*.parquet')")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield d, con
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables_give_the_same_results(spark, skewed, name):
    d, con = skewed
    assert compare(spark, con, d, name) == []


def test_large_k_on_a_hot_group(spark):
    """Beyond Spark's threshold for group limits, a hot group is cut in parts before it meets."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"), (F.col("id") * 7919 % 10_007).alias("v"), "id")
    top = windows.top_k(df, "v", 2000, ["g"], tie_break=["id"])
    place = {}
    for g, v, i in sorted(map(tuple, df.collect()), key=lambda r: (r[0], -r[1], r[2])):
        place.setdefault(g, []).append((g, v, i))
    assert sorted(map(tuple, top.collect())) == sorted(r for rows in place.values() for r in rows[:2000])
    assert top._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 2


def test_large_k_of_many_parts_meets_in_two_rounds(spark):
    """With 100 parts a hot group of 20,000 rows meets in 10 first, and the last window gets k rows from each of those."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("rest").alias("g"), (F.col("id") * 7919 % 10_007).alias("v"), "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        top = windows.top_k(df, "v", 1500, ["g"], tie_break=["id"])
        got = sorted(map(tuple, top.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    best = {g: sorted((r for r in map(tuple, df.collect()) if r[0] == g), key=lambda r: (-r[1], r[2]))[:1500] for g in ("hot", "rest")}
    assert got == sorted(best["hot"] + best["rest"]) and top.columns == df.columns
    assert top._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 3


def test_ranking_with_a_third_unknown(spark):
    df = spark.range(9_000).select("id", F.when(F.col("id") % 3 > 0, (F.col("id") % 1000).cast("double")).alias("v"))
    ranked = windows.rank_by(df, "v")
    rows = {r.id: r["rank"] for r in ranked.collect()}
    values_ = sorted((r.v for r in df.where("v is not null").collect()), reverse=True)
    first = {}
    for i, v in enumerate(values_):
        first.setdefault(v, i + 1)
    assert len(rows) == 9_000 and all(rows[r.id] == (first[r.v] if r.v is not None else None) for r in df.collect())
