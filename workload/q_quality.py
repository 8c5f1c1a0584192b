"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.operators import quality
from caudal.operators.projection import dictionary
from caudal.plans import contracts
from caudal.plans.cleaning import climate_report, coverage_report
from caudal.plans.refresh import foreign_key_report
from workload import bindings, lake
from workload.bindings import table
from workload.catalog import query
from workload.oracle import with_parts


def _report(check: str, column: str, bad: str, source: str) -> str:
    return f"SELECT '{check}' AS check_name, '{column}' AS column_name, count(*) FILTER ({bad}) AS n_bad, count(*) AS n_total FROM {source}"


@query("DQ-01 DQ-02 DQ-09", " UNION ALL ".join([
    _report("null", "c_name", "c_name IS NULL", "customer"), _report("null", "c_acctbal", "c_acctbal IS NULL", "customer"),
    _report("negative", "c_acctbal", "c_acctbal < 0", "customer"), _report("out_of_range", "c_acctbal", "c_acctbal NOT BETWEEN 0 AND 5000", "customer"),
    _report("not_in_domain", "c_mktsegment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')", "customer")]))
def customer_report(spark, d):
    checks = (quality.nulls(["c_name", "c_acctbal"]) + quality.negatives(["c_acctbal"]) + quality.outside("c_acctbal", 0, 5000)
              + quality.not_in("c_mktsegment", ["BUILDING", "MACHINERY"]))
    return quality.dq_report(table(spark, d, "customer"), checks)


@query("DQ-03", "SELECT 'duplicate_row' AS check_name, '*' AS column_name, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_bad, (SELECT count(*) FROM lineitem) AS n_total")
def duplicate_rows(spark, d):
    return quality.duplicate_rows(table(spark, d, "lineitem"))


@query("DQ-10", "SELECT 'repeated_key' AS check_name, 'l_orderkey,l_linenumber' AS column_name, count(*) FILTER (n > 1) AS n_bad, CAST(sum(n) AS BIGINT) AS n_total FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def repeated_keys(spark, d):
    return quality.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("DQ-04 DQ-05", "SELECT doc_id, lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic, CASE WHEN quality IS NULL THEN 'UNKNOWN' ELSE 'labelled' END AS status FROM documents LEFT JOIN labels USING (doc_id)")
def filled_by_type(spark, d):
    labels = table(spark, d, "labels").withColumn("status", F.lit("labelled"))
    return quality.fill_by_type(table(spark, d, "documents").select("doc_id", "lang").join(labels, "doc_id", "left"))


_LANDED_COLUMNS = ("country_iso3", "country_name", "year", "residence_type_code", "residence_type_desc", "service_type_desc", "service_level_desc", "coverage_pct", "population_total")


@query("DQ-01 DQ-02 DQ-03 CLN-01", with_parts(" UNION ALL ".join(
    [_report("null", c, f"{c} IS NULL", "coverage") for c in _LANDED_COLUMNS]
    + [_report("negative", c, f"{c} < 0", "coverage") for c in ("coverage_pct", "population_total")]
    + ["SELECT 'duplicate_row', '*', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM coverage)), count(*) FROM coverage"]), "coverage"))
def landed_coverage_report(spark, d):
    return coverage_report(bindings.landed_coverage(spark, d), bindings.RESIDENCE_CODES)


@query("DQ-01 CLN-02", " UNION ALL ".join(_report("null", c, f"{x} IS NULL", "lineitem") for c, x in (("year", "l_shipdate"), ("month", "l_shipdate"), ("temperature_2m_max", "l_linenumber"))))
def landed_climate_report(spark, d):
    daily = bindings.daily_climate(spark, d)
    return climate_report(daily.withColumns({"country_iso3": F.col("s_suppkey").cast("string"), "province": F.lit("all")}))


@query("DQ-08", """SELECT 'foreign_key' AS check_name, 'doc_id' AS column_name, count(*) FILTER (l.doc_id IS NULL) AS n_bad, count(*) AS n_total FROM documents d LEFT JOIN labels l USING (doc_id)
    UNION ALL SELECT 'foreign_key', 'l_orderkey', count(*) FILTER (o_orderkey IS NULL), count(*) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def unresolved_keys(spark, d):
    documents = quality.unresolved_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")
    items = quality.unresolved_keys(table(spark, d, "lineitem"), table(spark, d, "orders"), "l_orderkey", {"l_orderkey": "o_orderkey"})
    return quality.full_report([documents, items])


_FK = " UNION ALL ".join(
    f"SELECT '{fact}' AS fact, 'foreign_key' AS check_name, '{col}' AS column_name, 0::BIGINT AS n_bad, count(*) AS n_total FROM {source}"
    for fact, source, cols in (
        ("climate_monthly", "fact_monthly", ("province_key", "date_key")), ("climate_annual", "fact_annual", ("country_key", "date_key")),
        ("wash_coverage", "fact_coverage", ("country_key", "residence_type_key", "service_type_key", "service_level_key", "date_key")),
        ("socioeconomic", "fact_socioeconomic", ("country_key", "indicator_key", "date_key")))
    for col in cols)


@query("DQ-08", with_parts(f"SELECT check_name, column_name, n_bad, n_total FROM ({_FK})", "fact_monthly", "fact_annual", "fact_coverage", "fact_socioeconomic"))
def star_foreign_keys(spark, d):
    return foreign_key_report(lake.model(spark, d))


@query("DQ-11", with_parts(" UNION ALL ".join([
    "SELECT 'date_part' AS check_name, 'year' AS column_name, 0::BIGINT AS n_bad, count(*) AS n_total FROM calendar",
    "SELECT 'date_part', 'month', 0, count(*) FROM calendar", "SELECT 'date_key', 'date_key', 0, count(*) FROM calendar",
    "SELECT 'anchor', 'date_key', 0, count(*) FROM fact_monthly", "SELECT 'anchor', 'date_key', 0, count(*) FROM fact_annual"]), "calendar", "fact_monthly", "fact_annual"))
def temporal_consistency(spark, d):
    model = lake.model(spark, d)
    parts = quality.dq_report(model["date"], quality.date_parts_disagree("date", "year", "month", "date_key"))
    months = quality.dq_report(model["climate_monthly"], quality.not_period_end("date_key", "month"))
    years = quality.dq_report(model["climate_annual"], quality.not_period_end("date_key", "year"))
    return quality.full_report([parts, months, years])


@query("DQ-07 DQ-06", """SELECT 'orders' AS table_name, count(*) AS n_rows, count(*) > 0 AS is_usable FROM orders UNION ALL SELECT 'lineitem', count(*), count(*) > 0 FROM lineitem
    UNION ALL SELECT 'customer', count(*), count(*) > 0 FROM customer""")
def required_tables(spark, d):
    tables = {name: table(spark, d, name) for name in ("orders", "lineitem", "customer")}
    return quality.table_counts(quality.require_tables(tables))


@query("DQ-09 DQ-10", with_parts("""SELECT 'out_of_range' AS check_name, 'coverage_pct' AS column_name, count(*) FILTER (coverage_pct NOT BETWEEN 0 AND 100) AS n_bad, count(*) AS n_total FROM coverage
    UNION ALL SELECT 'repeated_key', 'country_iso3,residence_type_code,service_type_desc,service_level_desc,year', count(*) FILTER (n > 1), CAST(sum(n) AS BIGINT)
    FROM (SELECT count(*) AS n FROM coverage GROUP BY country_iso3, residence_type_code, service_type_desc, service_level_desc, year)""", "coverage"))
def coverage_grain_and_range(spark, d):
    coverage = lake.clean_table(spark, d, "coverage")
    grain = ["country_iso3", "residence_type_code", "service_type_desc", "service_level_desc", "year"]
    return quality.full_report([quality.dq_report(coverage, quality.outside("coverage_pct", 0, 100)), quality.repeated_keys(coverage, grain)])


@query("DQ-12", with_parts("""SELECT change, column_name, expected, actual, (SELECT count(*) FROM indicators) AS n_rows FROM (
    SELECT 'unexpected' AS change, 'flagged' AS column_name, CAST(NULL AS VARCHAR) AS expected, 'boolean' AS actual
    UNION ALL SELECT 'type', 'year', 'int', 'bigint' UNION ALL SELECT 'missing', 'indicator_name', 'string', NULL)""", "indicators"))
def schema_changes(spark, d):
    """What a changed table looks like next to its contract, and how many rows it concerns."""
    stored = lake.clean_table(spark, d, "indicators")
    changed = stored.drop("indicator_name").withColumn("year", F.col("year").cast("bigint")).withColumn("flagged", F.lit(True))
    return quality.schema_changes(changed, contracts.INDICATORS).withColumn("n_rows", changed.agg(F.count(F.lit(1))).scalar())


@query("DQ-13 DQ-01", with_parts(" UNION ALL ".join(
    f"SELECT '{original}' AS column_original, '{name}' AS column_normalized, '{dtype}' AS dtype, count(*) FILTER ({name} IS NULL) AS n_bad, count(*) AS n_total FROM indicators"
    for original, name, dtype in (("country_code", "country_iso3", "string"), ("date", "year", "int"), ("indicator_code", "indicator_code", "string"),
                                  ("indicator_name", "indicator_name", "string"), ("value", "indicator_value", "double"))), "indicators"))
def dictionary_of_stored_table(spark, d):
    """The declared columns of a stored table next to what is unknown in them."""
    declared = dictionary(spark, [contracts.INDICATORS])
    unknown = quality.dq_report(lake.clean_table(spark, d, "indicators"), quality.nulls(contracts.INDICATORS.columns))
    joined = declared.join(unknown.withColumnRenamed("column_name", "column_normalized"), "column_normalized")
    return joined.select("column_original", "column_normalized", "dtype", "n_bad", "n_total")
