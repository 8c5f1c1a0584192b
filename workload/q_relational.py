"""Filters, joins, aggregations, windows and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.functions import bands, numeric, text
from caudal.operators import aggregates, filters, joins, windows
from caudal.operators.profile import describe_by, null_counts_by, profile, value_pairs
from caudal.plans import places
from workload import bindings, lake
from workload.bindings import table
from workload.catalog import query
from workload.oracle import corr, r6, with_parts


def _year(name="o_orderdate"):
    return F.year(name).alias("year")


# ---- filters ---------------------------------------------------------------------------


@query("FIL-01", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('1-URGENT', '5-LOW')")
def in_list_filter(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return filters.keep_in(rows, o_orderstatus=["F", "P"], o_orderpriority=["1-URGENT", "5-LOW"])


@query("FIL-02 FIL-03", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def valid_measures_and_domain(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return filters.keep_in(filters.non_negative_or_null(rows, ["c_acctbal"]), c_mktsegment=["BUILDING", "MACHINERY"])


@query("FIL-05", "SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL OR toxic IS NOT NULL")
def drop_all_null(spark, d):
    rows = joins.attach(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")
    return filters.drop_incomplete(rows, "all", ["quality", "toxic"])


@query("FIL-05",
       with_parts("""SELECT country_iso3, year, CAST(u AS DOUBLE) AS u, CAST(r AS DOUBLE) AS r FROM (
    SELECT country_iso3, year, sum(coverage_pct) FILTER (residence_type_desc = 'building') AS u, sum(coverage_pct) FILTER (residence_type_desc = 'machinery') AS r
    FROM coverage WHERE service_level_desc = 'p' AND service_type_desc = 'expedited' GROUP BY 1, 2) WHERE u IS NOT NULL AND r IS NOT NULL""", "coverage"))
def drop_any_null(spark, d):
    rows = filters.keep_in(lake.clean_table(spark, d, "coverage"), service_level_desc=["p"], service_type_desc=["expedited"])
    wide = aggregates.pivot_values(rows.withColumn("pct", F.col("coverage_pct").cast("double")), ["country_iso3", "year"], "residence_type_desc", {"building": "u", "machinery": "r"}, "pct")
    return filters.drop_incomplete(wide, "any", ["u", "r"])


@query("FIL-06", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0)")
def matching_keys_by_semi_join(spark, d):
    keys = table(spark, d, "customer").where("c_mktsegment = 'BUILDING' AND c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return filters.keep_matching(table(spark, d, "orders").select("o_orderkey", "o_custkey"), keys, "o_custkey")


@query("FIL-07 AGG-12", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_shipdate >= (SELECT min(o_orderdate) FROM orders WHERE o_totalprice > 499000) AND l_shipdate <= (SELECT max(o_orderdate) FROM orders WHERE o_totalprice > 499000)""")
def clipped_to_reference_range(spark, d):
    reference = table(spark, d, "orders").where("o_totalprice > 499000").select(F.col("o_orderdate").alias("l_shipdate"))
    return filters.clip_to_range(table(spark, d, "lineitem"), reference, "l_shipdate").select("l_orderkey", "l_linenumber", "l_quantity")


@query("FIL-10", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_year(spark, d):
    return filters.latest(table(spark, d, "orders").select("o_orderkey", _year()))


@query("FIL-10", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def year_range(spark, d):
    return filters.between(table(spark, d, "orders").select("o_orderkey", _year()), "year", 1996, 1998)


@query("FIL-09", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def groups_with_enough_rows(spark, d):
    counted = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return filters.groups_of_at_least(counted, "n", 12)


# ---- joins -----------------------------------------------------------------------------

ENRICHED = """SELECT c_mktsegment, n_name, r_name, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3"""


def _dims(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    return customer, table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, d, "region")


@query("JOI-01 JOI-04 JOI-07 JOI-10", ENRICHED)
def chained_lookups(spark, d):
    """Orders counted per customer before the lookups, so a hot customer joins as one row."""
    customer, nation, region = _dims(spark, d)
    counted = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    named = joins.attach_all(counted, [(customer, "o_custkey", ["n_nationkey", "c_mktsegment"]), (nation, "n_nationkey", ["n_name", "r_regionkey"]), (region, "r_regionkey", ["r_name"])])
    return named.groupBy("c_mktsegment", "n_name", "r_name").agg(F.sum("n").alias("n"))


@query("JOI-01", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def salted_verified_lookup(spark, d):
    """Row-level lookup that neither trusts the key to be unique nor keeps a hot key in one task."""
    customer, _, _ = _dims(spark, d)
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.attach(rows, customer, "o_custkey", ["c_mktsegment"], verify=True, salt=8).select("o_orderkey", "c_mktsegment")


@query("JOI-05 JOI-07", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 2")
def inner_enrichment(spark, d):
    nation = table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return joins.attach(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), nation, "s_nationkey", how="inner").select("s_suppkey", "n_name")


@query("JOI-06", with_parts("""SELECT country_iso3, year, CAST(rain AS DOUBLE) / 100 AS rain, i.n FROM annual_sums a
    JOIN indicator_sums i USING (country_iso3, year)""", "annual_sums", "indicator_sums"))
def fact_to_fact_series(spark, d):
    rain = lake.clean_table(spark, d, "climate").groupBy("country_iso3", "year").agg(F.sum("precip_total_mm").alias("rain"))
    orders = lake.clean_table(spark, d, "indicators").where(F.col("indicator_code") == bindings.ORDERS).select("country_iso3", "year", F.col("indicator_value").cast("bigint").alias("n"))
    return joins.match_series(rain, orders, ["country_iso3", "year"])


@query("JOI-08", f"""SELECT o_orderkey, o_orderstatus, n, {r6('o_totalprice * 1000 / total')} AS share FROM (
    SELECT *, count(*) OVER w AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) OVER w AS DOUBLE) AS total FROM orders WINDOW w AS (PARTITION BY o_orderstatus, year(o_orderdate)))""")
def group_statistic_on_detail(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", _year(), "o_totalprice")
    stats = {"n": F.count(F.lit(1)), "total": F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double")}
    joined = joins.with_group_stats(rows, ["o_orderstatus", "year"], stats)
    return joined.select("o_orderkey", "o_orderstatus", "n", (F.col("o_totalprice") * 1000 / F.col("total")).alias("share"))


@query("JOI-09", """SELECT s.s_suppkey, s.year, rain, n_orders FROM (SELECT s_suppkey, s_nationkey, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS rain FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3) s
    JOIN (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) c ON s_nationkey = c_nationkey AND s.year = c.year""")
def mixed_grain_join(spark, d):
    """Supplier-year rows next to the figures of their nation and year."""
    rain = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey"), _year("l_shipdate")).agg(F.sum("l_quantity").alias("rain"))
    rain = joins.attach(rain, table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation")), "s_suppkey", how="inner")
    counted = table(spark, d, "orders").groupBy("o_custkey", _year()).agg(F.count(F.lit(1)).alias("n"))
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = joins.attach(counted, customer, "o_custkey", how="inner").groupBy("nation", "year").agg(F.sum("n").alias("n_orders"))
    return rain.join(orders, ["nation", "year"], "left").where(F.col("n_orders").isNotNull()).select("s_suppkey", "year", "rain", "n_orders")


PLACES = "(SELECT n_name AS country_name, CAST(n_nationkey AS DOUBLE) AS lat, CAST(-n_nationkey AS DOUBLE) AS lon FROM nation WHERE n_nationkey % 5 <> 0)"


@query("JOI-11", f"SELECT country_name, lat, lon, count(*) AS n FROM (SELECT n_name AS country_name FROM customer JOIN nation ON c_nationkey = n_nationkey) JOIN {PLACES} USING (country_name) GROUP BY ALL")
def coordinates_of_countries(spark, d):
    known = table(spark, d, "nation").where("n_nationkey % 5 <> 0").select(
        F.col("n_name").alias("country_name"), F.col("n_nationkey").cast("double").alias("lat"), (-F.col("n_nationkey")).cast("double").alias("lon"))
    counted = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    named = joins.attach(counted, table(spark, d, "nation"), "n_nationkey", ["n_name"]).withColumnRenamed("n_name", "country_name")
    return joins.attach_places(named, known, "country_name").select("country_name", "lat", "lon", "n")


def _places(rows, cols: str) -> str:
    quoted = [", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" for v in row) for row in rows]
    return "(VALUES " + ", ".join(f"({i}, {row})" for i, row in enumerate(quoted)) + f") AS p(i, {cols})"


@query("JOI-11", f"""SELECT 'country' AS map, p.country_name, CAST(NULL AS VARCHAR) AS province_name, lat, lon, n FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)
    JOIN {_places(places.COUNTRIES, 'country_name, lat, lon')} ON c_nationkey * 2 = i
    UNION ALL SELECT 'province', p.country_name, p.province_name, lat, lon, n FROM (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
    JOIN {_places(places.PROVINCES, 'country_name, province_name, lat, lon')} ON s_nationkey * 3 = i""")
def places_on_the_map(spark, d):
    """Customers and suppliers by nation, each nation standing for a country or province of the place tables; those beyond have no coordinates."""
    name = lambda rows, k, col: F.get(F.lit([r[k] for r in rows]), col.cast("int"))
    customers = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    named = customers.select(F.coalesce(name(places.COUNTRIES, 0, F.col("c_nationkey") * 2), F.lit("Nowhere")).alias("country_name"), "n")
    suppliers = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    at = F.col("s_nationkey") * 3
    local = suppliers.select(name(places.PROVINCES, 0, at).alias("country_name"), name(places.PROVINCES, 1, at).alias("province_name"), "n")
    world = places.on_country_map(named).select(F.lit("country").alias("map"), "country_name", F.lit(None).cast("string").alias("province_name"), "lat", "lon", "n")
    return world.unionByName(places.on_province_map(local).select(F.lit("province").alias("map"), "country_name", "province_name", "lat", "lon", "n"))


# ---- aggregations ----------------------------------------------------------------------


@query("AGG-04 RUL-16", "SELECT l_returnflag, l_linestatus, count(*) FILTER (l_quantity < 10) AS low, count(*) FILTER (l_quantity > 40) AS high FROM lineitem GROUP BY 1, 2")
def flag_counts(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", bands.below("l_quantity", 10).alias("low"), bands.above("l_quantity", 40).alias("high"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count_if("low").alias("low"), F.count_if("high").alias("high"))


@query("AGG-06", "SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus IN ('F', 'P') THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS bad, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS good FROM orders GROUP BY 1")
def sums_on_condition(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    sides = {"bad": F.col("o_orderstatus").isin("F", "P"), "good": F.col("o_orderstatus") == "O"}
    sums = aggregates.conditional_sum(rows, ["o_custkey"], "price", sides, missing=0)
    return sums.select("o_custkey", F.col("bad").cast("double").alias("bad"), F.col("good").cast("double").alias("good"))


@query("AGG-05 AGG-07", "SELECT l_suppkey, max(l_quantity) FILTER (l_returnflag IN ('A', 'R')) AS top, sum(l_quantity) FILTER (l_returnflag IN ('A', 'R')) AS total FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1")
def level_sum_and_max(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    top = aggregates.share_of_levels(rows, ["l_suppkey"], "l_quantity", "l_returnflag", ["A", "R"], "max", "top")
    total = aggregates.share_of_levels(rows, ["l_suppkey"], "l_quantity", "l_returnflag", ["A", "R"], "sum", "total")
    return joins.match_series(top, total, ["l_suppkey"])


@query("AGG-08 AGG-10", f"SELECT p_brand, count(*) AS n, {r6(corr('p_size', 'p_retailprice'))} AS corr FROM part GROUP BY 1")
def correlation_by_group(spark, d):
    return aggregates.correlate(table(spark, d, "part"), ["p_brand"], "p_size", "p_retailprice")


@query("AGG-09 RUL-09 AGG-11", f"""SELECT l_suppkey, n_periods, {r6('r')} AS corr, CASE WHEN n_periods < 3 THEN 'uncertain' WHEN r <= -0.3 THEN 'decreasing' WHEN r >= 0.3 THEN 'increasing' ELSE 'stable' END AS trend
    FROM (SELECT l_suppkey, count(DISTINCT year) AS n_periods, {corr('year', 'rain')} AS r FROM (SELECT l_suppkey, year(l_shipdate) AS year, sum(l_quantity) AS rain FROM lineitem GROUP BY 1, 2) GROUP BY 1)""")
def supplier_trend(spark, d):
    yearly = table(spark, d, "lineitem").groupBy("l_suppkey", _year("l_shipdate")).agg(F.sum("l_quantity").alias("rain"))
    return aggregates.trend_class(yearly, ["l_suppkey"], "year", "rain")


@query("AGG-12", "SELECT min(l_shipdate)::DATE AS low, max(l_shipdate)::DATE AS high FROM lineitem")
def column_bounds(spark, d):
    ends = aggregates.bounds(table(spark, d, "lineitem"), "l_shipdate")
    return ends.select(F.to_date("low").alias("low"), F.to_date("high").alias("high"))


@query("AGG-13", "SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'error') AS error FROM events GROUP BY 1")
def pivoted_maxima(spark, d):
    return aggregates.pivot_values(table(spark, d, "events"), ["user_id"], "event_type", ["click", "view", "error"], "value")


@query("AGG-15", f"SELECT l_suppkey, {r6('CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / 100')} AS affected FROM lineitem GROUP BY 1")
def affected_amount(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), F.col("l_discount").cast("decimal(4,2)").alias("pct"))
    amount = aggregates.weighted_population(rows, ["l_suppkey"], "price", "pct", "affected")
    return amount.withColumn("affected", F.col("affected").cast("double"))


@query("AGG-17 SET-02", "SELECT coalesce(c_mktsegment, 'Regional') AS c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY ROLLUP (c_mktsegment)")
def totals_row(spark, d):
    return aggregates.rollup_total(table(spark, d, "customer"), "c_mktsegment", {"n": F.count(F.lit(1)), "top": F.max("c_acctbal")})


@query("AGG-18", f"SELECT c_nationkey, {r6('avg(abs(c_acctbal))')} AS mean FROM customer GROUP BY 1")
def mean_of_absolutes(spark, d):
    return aggregates.mean_by(table(spark, d, "customer"), ["c_nationkey"], "c_acctbal", "mean", absolute=True)


@query("AGG-19", f"SELECT o_orderstatus AS level, count(*) AS n, {r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct, CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 END AS position FROM orders GROUP BY 1")
def ordered_distribution(spark, d):
    return aggregates.distribution(table(spark, d, "orders"), "o_orderstatus", ["P", "O", "F"])


@query("AGG-20", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'P') AS n_p, count(DISTINCT (o_custkey, o_orderpriority)) AS n_entities FROM orders GROUP BY 1")
def counts_by_status(spark, d):
    rows = table(spark, d, "orders").select(_year(), "o_orderstatus", "o_custkey", "o_orderpriority")
    return aggregates.status_counts(rows, ["year"], "o_orderstatus", {"n_f": "F", "n_p": "P"}, ["o_custkey", "o_orderpriority"])


@query("AGG-22", """SELECT l_suppkey, first_period, last_period, first_value, last_value, last_value - first_value AS change,
    CASE WHEN last_value - first_value > 50 THEN 'worsened' WHEN last_value - first_value < -50 THEN 'improved' ELSE 'stable' END AS direction FROM (
    SELECT l_suppkey, min(y) AS first_period, max(y) AS last_period, arg_min(q, y) AS first_value, arg_max(q, y) AS last_value FROM (
        SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1) WHERE first_period < last_period""")
def first_against_last_year(spark, d):
    yearly = table(spark, d, "lineitem").groupBy("l_suppkey", _year("l_shipdate")).agg(F.sum("l_quantity").alias("q"))
    return aggregates.first_last_change(yearly, ["l_suppkey"], "year", "q", 50)


@query("AGG-23", "SELECT lang, count(*) FILTER (quality IS NULL) AS quality_nulls, count(*) FILTER (toxic IS NULL) AS toxic_nulls FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def null_counts(spark, d):
    rows = joins.attach(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")
    return null_counts_by(rows, ["lang"], ["quality", "toxic"])


STATS = "count(*) AS count, round(avg({0}), 4) AS mean, round(stddev_samp({0}), 4) AS std, min({0}) AS min, max({0}) AS max, round(quantile_cont({0}, 0.25), 4) AS q25, round(quantile_cont({0}, 0.5), 4) AS q50, round(quantile_cont({0}, 0.75), 4) AS q75"


def _stats4(df):
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query("AGG-24", "SELECT o_orderstatus, " + STATS.format("o_totalprice") + " FROM orders GROUP BY 1")
def descriptive_statistics_by_group(spark, d):
    return _stats4(describe_by(table(spark, d, "orders"), "o_totalprice", ["o_orderstatus"]))


@query("AGG-24", "SELECT " + STATS.format("l_quantity") + " FROM lineitem")
def descriptive_statistics(spark, d):
    return _stats4(describe_by(table(spark, d, "lineitem"), "l_quantity"))


def _profile_sql(name: str, cols: dict[str, str]) -> str:
    parts = []
    for col, dtype in cols.items():
        parts.append(f"SELECT '{col}' AS column_name, '{dtype}' AS dtype, count(*) FILTER ({col} IS NULL) AS n_missing, round(100.0 * count(*) FILTER ({col} IS NULL) / count(*), 2) AS pct_missing, "
                     f"count(DISTINCT {col}) AS n_unique, (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {name} WHERE {col} IS NOT NULL ORDER BY v LIMIT 3)) AS examples FROM {name}")
    return " UNION ALL ".join(p.replace("round(100.0 *", "CAST(round(100.0 *").replace(", 2) AS pct", ", 2) AS DOUBLE) AS pct") for p in parts)


@query("AGG-25", _profile_sql("customer", {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}))
def column_profile(spark, d):
    return profile(table(spark, d, "customer"))


@query("AGG-26 SET-03", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def value_dictionary(spark, d):
    return value_pairs(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


# ---- windows and sets ------------------------------------------------------------------


@query("WIN-01", "SELECT * FROM (SELECT l_suppkey, y AS year, q, n, q - lag(q) OVER s AS dq, n - lag(n) OVER s AS dn FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2) WINDOW s AS (PARTITION BY l_suppkey ORDER BY y)) WHERE dq IS NOT NULL")
def yearly_changes(spark, d):
    yearly = table(spark, d, "lineitem").groupBy("l_suppkey", _year("l_shipdate")).agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    return windows.yoy_delta(yearly, ["l_suppkey"], "year", {"q": "dq", "n": "dn"})


@query("WIN-01", """SELECT l_suppkey, y AS year, q, CASE WHEN y - lag(y) OVER s = 1 THEN q - lag(q) OVER s END AS dq FROM (
    SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, sum(l_quantity) AS q FROM lineitem WHERE year(l_shipdate) <> 1998 GROUP BY 1, 2) WINDOW s AS (PARTITION BY l_suppkey ORDER BY y)""")
def consecutive_changes(spark, d):
    yearly = table(spark, d, "lineitem").where(F.year("l_shipdate") != 1998).groupBy("l_suppkey", _year("l_shipdate")).agg(F.sum("l_quantity").alias("q"))
    return windows.yoy_delta(yearly, ["l_suppkey"], "year", {"q": "dq"}, drop_first=False, require_consecutive=True)


@query("WIN-04 SET-06", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def largest_orders(spark, d):
    return windows.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, tie_break=["o_orderkey"])


@query("WIN-04", "SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY abs(c_acctbal) DESC, c_custkey) <= 3")
def largest_balances_by_nation(spark, d):
    return windows.top_k(table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), "c_acctbal", 3, ["c_nationkey"], absolute=True, tie_break=["c_custkey"])


@query("WIN-03", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1")
def largest_order_by_priority(spark, d):
    return windows.top_1(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"], ["o_orderkey", "o_totalprice"])


@query("WIN-05", "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS place FROM orders")
def overall_ranking(spark, d):
    return windows.rank_by(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "place")


@query("WIN-05", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_partkey, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS place FROM lineitem")
def ranking_with_many_ties(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_partkey")
    return windows.rank_by(rows, "l_quantity", "place", ["l_returnflag"])


@query("WIN-06", f"SELECT c_custkey, c_nationkey, {r6('CASE WHEN max(c_acctbal) OVER w > 0 THEN 20000 + c_acctbal / max(c_acctbal) OVER w * 60000 ELSE 25000 END')} AS weight FROM customer WINDOW w AS (PARTITION BY c_nationkey)")
def weights_scaled_to_maximum(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return windows.scale_to_max(rows, "c_acctbal", "weight", by=["c_nationkey"]).select("c_custkey", "c_nationkey", "weight")


@query("SET-01 PRJ-06", "SELECT 'customer' AS kind, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_name, NULL FROM supplier")
def union_with_missing_columns(spark, d):
    customer = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"))
    return aggregates.union_all([customer, supplier])


@query("SET-03", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("SET-05 SET-06", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def sorted_head(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25)


# ---- rules on rows ---------------------------------------------------------------------


@query("PRJ-04 PRJ-05 RUL-22", """SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, CASE lower(trim(c_mktsegment)) WHEN 'building' THEN 'URB' WHEN 'machinery' THEN 'RUR' ELSE 'UNK' END AS code FROM customer""")
def codes_of_segments(spark, d):
    segment = text.clean_text("c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", segment.alias("segment"), text.code_of(segment, {"building": "URB", "machinery": "RUR"}, "UNK").alias("code"))


@query("PRJ-10 PRJ-11", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS label, o_orderstatus || ' – ' || o_orderpriority AS area FROM orders")
def friendly_labels(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.label_of("o_orderstatus", {"F": "Filled", "O": "Open"}).alias("label"),
                                             text.joined_label(["o_orderstatus", "o_orderpriority"]).alias("area"))


@query("RUL-01 RUL-02 RUL-03 RUL-18", """SELECT l_orderkey, l_linenumber, l_partkey, r,
    CASE WHEN abs(r) < 0.3 THEN 'green' WHEN abs(r) < 0.6 THEN 'yellow' ELSE 'red' END AS risk, CASE WHEN abs(r) < 0.3 THEN 'Verde' WHEN abs(r) < 0.6 THEN 'Amarillo' ELSE 'Rojo' END AS riesgo,
    CASE WHEN r >= 0.2 THEN 'direct' WHEN r <= -0.2 THEN 'inverse' ELSE 'uncertain' END AS impact, CASE WHEN r > 0 THEN 'positiva' WHEN r < 0 THEN 'negativa' ELSE 'sin dirección clara' END AS direction
    FROM (SELECT *, (l_quantity - 25) / 25.0 AS r FROM lineitem)""")
def correlation_rules(spark, d):
    r = (F.col("l_quantity") - 25) / 25.0
    return table(spark, d, "lineitem").withColumn("r", r).select(
        "l_orderkey", "l_linenumber", "l_partkey", "r", bands.correlation_risk("r").alias("risk"), bands.correlation_risk("r", bands.TRAFFIC_ES).alias("riesgo"),
        bands.impact_direction("r").alias("impact"), bands.correlation_direction("r").alias("direction"))


@query("RUL-04 RUL-05 RUL-06 RUL-07 RUL-08 RUL-10 AGG-21", """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q <= 5 THEN 'green' WHEN q <= 20 THEN 'yellow' ELSE 'red' END AS level,
    CASE WHEN q - 25 > 0.5 THEN 'worsened' WHEN q - 25 < -0.5 THEN 'improved' ELSE 'stable' END AS trend, CASE WHEN q - 25 > 0.1 THEN 'Empeorando' WHEN q - 25 < -0.1 THEN 'Mejorando' ELSE 'Estable' END AS tendencia,
    CASE WHEN abs(q - 25) >= 20 THEN 'Rojo' WHEN abs(q - 25) >= 10 THEN 'Amarillo' ELSE 'Verde' END AS gap_risk, CASE WHEN q > 40 THEN 'Rojo' WHEN q > 20 THEN 'Amarillo' ELSE 'Verde' END AS index_risk,
    100 - q AS rest, 100 - q < 80 AS is_low, CASE WHEN q <= 5 THEN 'Verde' WHEN q <= 20 THEN 'Amarillo' ELSE 'Rojo' END AS zones FROM (SELECT *, l_quantity AS q FROM lineitem)""")
def level_rules(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", bands.level_risk(q).alias("level"), bands.yearly_trend(q - 25).alias("trend"), bands.gap_trend(q - 25).alias("tendencia"),
        bands.gap_risk(q - 25, (10, 20)).alias("gap_risk"), bands.index_risk(q).alias("index_risk"), numeric.complement(q).alias("rest"),
        (numeric.complement(q) < 80).alias("is_low"), bands.zone_count_risk(q).alias("zones"))


@query("RUL-12 RUL-13 RUL-15", """SELECT c_custkey, greatest(0.0::DOUBLE, least(1.0::DOUBLE, round(c_acctbal / 5000.0, 6))) AS norm, least(greatest(c_acctbal, 0.0), 5000.0)::DOUBLE AS clipped,
    CAST(CAST(CAST(greatest(0.0::DOUBLE, least(1.0::DOUBLE, c_acctbal / 5000.0)) * 0.6 + c_nationkey / 25.0 * 0.4 AS DECIMAL(6,3)) * 100 AS DOUBLE) AS DOUBLE) AS idx FROM customer""")
def normalised_index(spark, d):
    terms = {"balance": numeric.minmax_norm("c_acctbal", 0, 5000), "nation": numeric.minmax_norm("c_nationkey", 0, 25)}
    return table(spark, d, "customer").select(
        "c_custkey", terms["balance"].alias("norm"), numeric.clip("c_acctbal", 0.0, 5000.0).alias("clipped"),
        numeric.weighted_index(terms, {"balance": 0.6, "nation": 0.4}).cast("double").alias("idx"))


@query("RUL-14 RUL-17 RUL-20 RUL-23", f"""SELECT l_orderkey, l_linenumber, l_partkey, {r6('coalesce(nullif(l_discount, 0), 0) - coalesce(nullif(l_tax, 0), 0)')} AS gap_zero, {r6('nullif(l_discount, 0) - nullif(l_tax, 0)')} AS gap_null,
    CASE WHEN l_quantity < 25 AND l_tax > 0.04 THEN 'b' WHEN l_quantity > 25 AND l_tax > 0.04 THEN 'a' WHEN l_quantity > 25 AND l_tax < 0.04 THEN 'c' WHEN l_quantity < 25 AND l_tax < 0.04 THEN 'd' ELSE 'e' END AS pattern,
    CAST(greatest(1, round_even(100.0 / l_quantity, 0)) AS BIGINT) AS one_in_n FROM lineitem""")
def gap_and_quadrant_rules(spark, d):
    labels = {"up_up": "a", "down_up": "b", "up_down": "c", "down_down": "d", "small": "e"}
    part, tax = F.nullif(F.col("l_discount"), F.lit(0.0)), F.nullif(F.col("l_tax"), F.lit(0.0))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numeric.gap(part, tax).alias("gap_zero"), numeric.gap(part, tax, "null").alias("gap_null"),
        bands.quadrant(F.col("l_quantity") - 25, F.col("l_tax") - 0.04, labels=labels).alias("pattern"), numeric.one_in_n("l_quantity").alias("one_in_n"))


@query("RUL-21", "SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key, monthname(l_shipdate) AS month_name, CAST(quarter(l_shipdate) AS INTEGER) AS quarter, CAST(strftime(last_day(l_shipdate), '%Y%m%d') AS INTEGER) AS month_end, count(*) AS n FROM lineitem GROUP BY ALL")
def calendar_functions(spark, d):
    from caudal.functions import dates

    day = F.col("l_shipdate")
    return table(spark, d, "lineitem").groupBy(
        dates.key_of_date(day).alias("date_key"), F.date_format(day, "MMMM").alias("month_name"), F.quarter(day).alias("quarter"),
        dates.month_end_key(F.year(day), F.month(day)).alias("month_end")).agg(F.count(F.lit(1)).alias("n"))
