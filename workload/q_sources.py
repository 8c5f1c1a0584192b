"""Sources and sinks. Sinks write whole tables below the shared folder and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.dates import timestamp_of_micros
from caudal.operators.filters import keep_known
from caudal.operators.profile import file_listing, size_report
from caudal.operators.projection import Contract, Field, conform, serve, snake_names, with_date_parts, with_types
from caudal.plans.contracts import COVERAGE_LANDED
from caudal.plans.refresh import Layers, read_clean, read_model, refresh_clean, refresh_star
from caudal.plans.star import WIDE
from caudal.session import new_table_path
from caudal.sources import readers, writers
from caudal.sources.publish import Publication
from caudal.streaming.landing import refresh_from_landing
from workload import bindings, lake
from workload.bindings import table
from workload.catalog import query
from workload.oracle import r6, with_parts


@query("SRC-01 SRC-04", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def read_named_table(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def _regional_climate(spark, d):
    """Daily rows with the region of their supplier; the lookup is small, the rows stream past it."""
    supplier = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    region = supplier.join(nation, "n_nationkey").select("s_suppkey", "region")
    return bindings.daily_climate(spark, d).join(region, "s_suppkey")


@query("SRC-02 SRC-03 SRC-04 SET-01 SNK-01 RUL-22", """SELECT CAST(n_regionkey AS VARCHAR) AS region_code, count(*) AS n, sum(l_quantity) AS precipitation
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def roots_with_key_from_path(spark, d):
    path = new_table_path(spark, "climate_landing")
    writers.write_partitions(_regional_climate(spark, d), path, ["region"])
    regions = [r.n_regionkey for r in table(spark, d, "nation").select("n_regionkey").distinct().collect()]  # a folder each
    roots = [f"{path}/region={i}" for i in regions] + [f"{path}/region=missing"]
    daily = readers.read_roots(spark, roots, ["precipitation_sum"], r"region=([^/]+)/", "region_code", on_missing="skip")
    return daily.groupBy("region_code").agg(F.count(F.lit(1)).alias("n"), F.sum("precipitation_sum").alias("precipitation"))


LANDED = """SELECT country_iso3 AS "ISO3", country_name AS "Country", residence_type_desc AS "Residence Type", upper(service_type_desc[1]) || service_type_desc[2:] AS "Service Type",
    CAST(year AS BIGINT) AS "Year", CAST(coverage_pct AS DOUBLE) AS "Coverage", CAST(population_total AS DOUBLE) AS "Population", upper(service_level_desc) AS "Service level" FROM coverage"""


@query("SRC-05 SNK-01", with_parts(LANDED, "coverage"))
def glob_over_country_year(spark, d):
    path = new_table_path(spark, "coverage_landing")
    landed = bindings.landed_coverage(spark, d).withColumn("Coverage", F.round("Coverage", 2))
    keyed = landed.select("*", F.substring("ISO3", -1, 1).alias("area"), F.col("Year").alias("period"))
    writers.write_partitions(keyed, path, ["area", "period"])
    return readers.read_glob(spark, f"{path}/area=*/period=*")


@query("SRC-06", with_parts(LANDED, "coverage"))
def delimited_with_schema(spark, d):
    path = new_table_path(spark, "coverage_csv")
    landed = bindings.landed_coverage(spark, d).withColumn("Coverage", F.round("Coverage", 2))
    landed.select(COVERAGE_LANDED.columns).write.option("header", True).csv(path)
    return readers.read_delimited(spark, path, COVERAGE_LANDED.schema)


@query("SRC-07 SRC-04", f"SELECT count(*) AS n, {r6('max(o_totalprice)')} AS top FROM orders")
def forced_schema(spark, d):
    orders = readers.read_table(spark, d, "orders", "o_orderkey bigint, o_totalprice double", ".parquet")
    return orders.agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("top"))


@query("SRC-08 SRC-11", with_parts("SELECT country_iso3 AS country_code, country_name, indicator_code, indicator_name, CAST(year AS BIGINT) AS date, CAST(micro AS DOUBLE) / 1000000 AS value FROM indicator_units", "indicator_units"))
def flattened_indicator_pages(spark, d):
    """API pages, one per country (three indicators a year), back to rows."""
    rows = bindings.landed_indicators(spark, d)
    record = F.struct(
        F.col("country_code").alias("countryiso3code"), F.struct(F.col("country_name").alias("value")).alias("country"),
        F.struct(F.col("indicator_code").alias("id"), F.col("indicator_name").alias("value")).alias("indicator"),
        F.col("date").cast("string").alias("date"), "value")
    pages = rows.groupBy("country_code").agg(F.concat(F.lit('[{"page": 1}, '), F.to_json(F.collect_list(record)), F.lit("]")).alias("payload"))
    flat = readers.flatten_pages(
        pages, "payload",
        "struct<countryiso3code: string, country: struct<value: string>, indicator: struct<id: string, value: string>, date: string, value: double>",
        {"country_code": "countryiso3code", "country_name": "country.value", "indicator_code": "indicator.id",
         "indicator_name": "indicator.value", "date": "date", "value": "value"})
    return with_types(flat, {"date": "bigint"})


@query("SRC-09 SRC-13", """SELECT l_suppkey AS s_suppkey, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS rain,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem GROUP BY 1, 2, 4, 5""")
def flattened_daily_arrays(spark, d):
    """Parallel arrays per supplier and month (at most 31 days each), back to one row per day."""
    days = bindings.daily_climate(spark, d).groupBy("s_suppkey", "year", "month", F.to_date("date").alias("day")).agg(F.sum("precipitation_sum").alias("rain"))
    month = days.groupBy("s_suppkey", "year", "month").agg(F.array_sort(F.collect_list(F.struct(F.col("day").cast("string").alias("day"), "rain"))).alias("r"))
    payloads = month.select("s_suppkey", F.to_json(F.struct(F.struct(
        F.col("r.day").alias("time"), F.col("r.rain").alias("precipitation_sum")).alias("daily"))).alias("payload"))
    flat = readers.flatten_arrays(payloads, "payload", "daily", {"time": "string", "precipitation_sum": "double"},
                                  {"time": "date", "precipitation_sum": "rain"}, keep=["s_suppkey"])
    return with_date_parts(with_types(flat, {"date": "date"}), "date")


PRIORITY = Contract("priority", (
    Field("o_orderkey", "bigint"),
    Field("level", "int", "code"),
    Field("rest", "int", "label"),
    Field("source", "string", required=False, default="Unknown"),
    Field("weight", "double", required=False, default=0.0),
))


@query("SRC-10 SRC-11 PRJ-01 PRJ-06", """SELECT level, rest, source, weight, count(*) AS n FROM (
    SELECT CAST(o_orderpriority[1] AS INTEGER) AS level, CAST(NULL AS INTEGER) AS rest, 'Unknown' AS source, CAST(0 AS DOUBLE) AS weight FROM orders) GROUP BY ALL""")
def lenient_contract(spark, d):
    """Text parsed to numbers where it is one; absent columns get typed defaults."""
    raw = table(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code"), F.col("o_orderpriority").alias("label"))
    return conform(raw, PRIORITY).groupBy("level", "rest", "source", "weight").agg(F.count(F.lit(1)).alias("n"))


@query("SRC-12 SRC-13", "SELECT CAST(ts AS DATE) AS day, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS n FROM events GROUP BY ALL")
def micros_to_timestamp(spark, d):
    micros = table(spark, d, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    dated = with_date_parts(micros.withColumn("ts", timestamp_of_micros("micros")), "ts")
    return dated.groupBy(F.to_date("ts").alias("day"), "year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("SRC-14", with_parts("SELECT * FROM coverage WHERE year = 1997", "coverage"))
def one_year_slice(spark, d):
    return readers.slice_period(lake.clean_table(spark, d, "coverage"), 1997)


@query("SRC-14", with_parts("SELECT * FROM climate WHERE year = 1998 AND month = 6", "climate"))
def one_month_slice(spark, d):
    return readers.slice_period(lake.clean_table(spark, d, "climate"), 1998, 6)


@query("SRC-16 AGG-27", """SELECT o_orderstatus AS layer, count(DISTINCT year(o_orderdate)) AS n_files, count(DISTINCT year(o_orderdate)) AS n_known,
    true AS same_files, true AS same_bytes, true AS size_fits FROM orders GROUP BY 1""")
def layer_sizes(spark, d):
    """Storage report from listings, beside the files and sizes that a scan of the rows names. Each status is a layer with a file a year."""
    path = new_table_path(spark, "layers")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    rows.repartition("status", "year").write.partitionBy("status", "year").parquet(path)
    layers = [r.status for r in spark.read.parquet(path).select("status").distinct().collect()]  # a folder each
    listings = {name: file_listing(spark, f"{path}/status={name}") for name in layers}
    listed = reduce(DataFrame.unionByName, [df.withColumn("layer", F.lit(name)) for name, df in listings.items()])
    listed = listed.groupBy("layer").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("bytes"))
    scanned = spark.read.parquet(path).select("status", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    scanned = scanned.groupBy(F.col("status").alias("layer")).agg(F.count(F.lit(1)).alias("n_known"), F.sum("s").alias("known"))
    report = size_report(listings).select("layer", F.col("n_files").alias("n_reported"), "size_bytes", "size_gb", "cost_usd_month")
    joined = listed.join(scanned, "layer").join(report, "layer")
    fits = (F.abs(F.col("size_gb") * 1073741824 - F.col("known")) < 1) & (F.abs(F.col("cost_usd_month") - F.col("size_gb") * 0.023) < 1e-12)
    return joined.select("layer", "n_files", "n_known", (F.col("n_reported") == F.col("n_known")).alias("same_files"),
                         ((F.col("bytes") == F.col("known")) & (F.col("size_bytes") == F.col("known"))).alias("same_bytes"), fits.alias("size_fits"))


@query("SNK-01", "SELECT o_orderstatus AS country, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2")
def landing_by_country_year(spark, d):
    path = new_table_path(spark, "orders_landing")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), F.col("o_orderstatus").alias("country"), F.year("o_orderdate").alias("year"))
    writers.write_partitions(rows, path, ["country", "year"], "static")
    return spark.read.parquet(path).groupBy("country", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("double").alias("value"))


@query("SNK-02", """SELECT event_type AS country, CAST(user_id % 4 AS INTEGER) AS province, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
    count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value FROM events GROUP BY ALL""")
def landing_by_province_month(spark, d):
    path = new_table_path(spark, "events_landing")
    rows = with_date_parts(table(spark, d, "events").withColumn("province", (F.col("user_id") % 4).cast("int")).withColumnRenamed("event_type", "country"), "ts")
    writers.write_partitions(rows.select("country", "province", "year", "month", F.col("value").cast("decimal(12,2)").alias("value")), path, ["country", "province", "year", "month"])
    return spark.read.parquet(path).groupBy("country", "province", "year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("value"))


def _yearly(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SNK-03 INC-01", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, CASE WHEN year(o_orderdate) = 1997 THEN -count(*) ELSE count(*) END AS n FROM orders GROUP BY 1, 2, year(o_orderdate)")
def replace_one_partition(spark, d):
    path = new_table_path(spark, "yearly")
    writers.write_partitions(_yearly(spark, d), path, ["year"])
    writers.write_partitions(_yearly(spark, d).where("year = 1997").withColumn("n", -F.col("n")), path, ["year"])
    return spark.read.parquet(path)


@query("SNK-09", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1, 2")
def static_overwrite(spark, d):
    path = new_table_path(spark, "yearly")
    writers.write_partitions(_yearly(spark, d), path, ["year"], "static")
    writers.write_partitions(_yearly(spark, d).where("year = 1998"), path, ["year"], "static")
    return spark.read.parquet(path)


@query("SNK-06", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY 1, 2")
def gold_write_modes(spark, d):
    path = new_table_path(spark, "gold")
    writers.write_table(_yearly(spark, d), path)
    writers.write_table(_yearly(spark, d), path, "append")
    return spark.read.parquet(path).groupBy("year", "o_orderstatus").agg(F.sum("n").alias("n"))


@query("SNK-08 FIL-01", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2")
def declared_sink(spark, d):
    sink = writers.Sink(new_table_path(spark, "declared"), ("year",), (("o_orderstatus", ("F", "O")),))
    writers.write_to(_yearly(spark, d), sink)
    return spark.read.parquet(sink.path)


@query("SNK-10", "SELECT count(*) AS n, count(*) AS n_stamped FROM customer")
def copy_with_audit_column(spark, d):
    path = new_table_path(spark, "audited")
    writers.write_table(writers.with_audit(table(spark, d, "customer")), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count("processed_at").alias("n_stamped"))


@query("PRJ-03", with_parts("SELECT \"ISO3\" AS country_iso3, \"Country\" AS country_name, \"Residence Type\" AS residence_type, \"Service Type\" AS service_type, \"Service level\" AS service_level, \"Year\" AS year, \"Coverage\" AS coverage_pct, \"Population\" AS population FROM (" + LANDED + ")", "coverage"))
def snake_case_names(spark, d):
    landed = bindings.landed_coverage(spark, d).withColumn("Coverage", F.round("Coverage", 2))
    return snake_names(landed, {"ISO3": "country_iso3", "Country": "country_name", "Coverage": "coverage_pct"})


@query("PRJ-12 PRJ-13", f"""SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_discount <> 0 AND l_tax <> 0) AS n_known, {r6('sum(CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN l_quantity END)')} AS total FROM lineitem GROUP BY 1""")
def finite_for_serving(spark, d):
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    value = F.when(F.col("l_discount") == 0, nan).when(F.col("l_tax") == 0, -inf).otherwise(F.col("l_quantity"))
    served = serve(table(spark, d, "lineitem").select("l_returnflag", value.alias("v")))
    return served.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_known"), F.sum("v").alias("total"))


@query("FIL-04", "SELECT count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0 WHERE c_custkey IS NOT NULL")
def known_keys_only(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined = table(spark, d, "orders").select("o_custkey").join(rich, "o_custkey", "left")
    return keep_known(joined, ["c_name"]).agg(F.count(F.lit(1)).alias("n"))


@query("INC-01 INC-02 SNK-03", with_parts("SELECT year, count(*) AS n, CAST(sum(coverage_pct) AS DOUBLE) AS total, true AS same FROM fact_coverage GROUP BY 1", "fact_coverage"))
def refresh_of_one_year(spark, d):
    """Refreshing one year again, dimensions included, leaves the same facts in all years."""
    layers = Layers(new_table_path(spark, "yearly_refresh"), WIDE)
    refresh_clean(layers, read_clean(spark, lake.clean_layer(spark, d)))
    regions = bindings.regions(spark, d)
    refresh_star(spark, layers, None, regions)
    refresh_star(spark, layers, 1997, regions)
    again, once = read_model(spark, layers)["wash_coverage"], lake.model(spark, d)["wash_coverage"]
    ids = once.select("wash_coverage_id", "coverage_pct", F.lit(True).alias("known"))
    same = again.join(ids, ["wash_coverage_id", "coverage_pct"], "left")
    return same.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("coverage_pct").cast("double").alias("total"),
                                    F.bool_and(F.coalesce("known", F.lit(False))).alias("same"))


@query("SNK-05 SNK-06 SNK-09 INC-02", """SELECT year, o_orderstatus, n, kept FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2), (SELECT unnest(['whole', 'period', 'pair']) AS kept)""")
def failed_refresh_keeps_rows(spark, d):
    """A write that fails half-way, a period that fails, and a publication whose second table fails a check leave all rows as they were."""
    rows, parts = _yearly(spark, d), []
    broken = rows.withColumn("n", F.when(F.col("year") == 1996, F.raise_error(F.lit("does not fit")).cast("bigint")).otherwise(-F.col("n")))

    def refuse(df: DataFrame) -> None:
        raise ValueError(f"{df.count()} rows refused")

    def attempt(write) -> None:
        try:
            write()
        except Exception as problem:
            if "does not fit" not in str(problem) and "refused" not in str(problem):
                raise
        else:
            raise AssertionError("the write should have failed")

    def pair(path: str) -> None:
        with Publication(spark) as publication:
            publication.stage(rows.limit(0), path)
            publication.stage(rows, f"{path}-second", check=refuse)

    for kept in ("whole", "period", "pair"):
        path = new_table_path(spark, f"kept-{kept}")
        if kept == "period":
            writers.write_partitions(rows, path, ["year"], "static")
            attempt(lambda: writers.replace_period(broken.where("year = 1996"), path, ["year"], {"year": 1996}))
        else:
            writers.write_table(rows, path)
            attempt((lambda: writers.write_table(broken, path)) if kept == "whole" else (lambda: pair(path)))
        parts.append(spark.read.schema(rows.schema).parquet(path).select("year", "o_orderstatus", "n", F.lit(kept).alias("kept")))
    return reduce(DataFrame.unionByName, parts)


@query("INC-01 SNK-03", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) + CASE WHEN year(o_orderdate) = 1995 THEN 1 ELSE 0 END AS n
    FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY 1, 2, year(o_orderdate)""")
def streamed_refresh_with_a_retracted_year(spark, d):
    """Two rounds of a stream over a landing folder: the second retracts all of 1997 and adds an order to each status of 1995."""
    landing, target, checkpoint = (new_table_path(spark, f"stream-{n}") for n in ("landing", "target", "checkpoint"))
    schema = "o_orderkey bigint, o_orderstatus string, kind string, year int"
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit("order").alias("kind"), F.year("o_orderdate").alias("year"))

    def clean(df: DataFrame) -> DataFrame:
        retracted = df.where("kind = 'retracted'").select("year").distinct()
        kept = df.where("kind <> 'retracted'").join(retracted, "year", "left_anti")
        return kept.groupBy("year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select("o_orderstatus", "n", "year")

    def arrive(rows: DataFrame) -> None:
        writers.write_partitions(rows, landing, ["year"], "append")
        refresh_from_landing(spark, landing, schema, clean, target, ["year"], checkpoint)

    arrive(orders)
    statuses = orders.where("year = 1995").select("o_orderstatus").distinct()
    more = statuses.select(F.lit(-1).cast("bigint").alias("o_orderkey"), "o_orderstatus", F.lit("order").alias("kind"), F.lit(1995).alias("year"))
    gone = orders.where("year = 1997").limit(1).select(F.lit(-2).cast("bigint").alias("o_orderkey"), "o_orderstatus", F.lit("retracted").alias("kind"), "year")
    arrive(more.unionByName(gone))
    return spark.read.parquet(target).select("year", "o_orderstatus", "n")
