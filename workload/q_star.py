"""Cleaned tables, dimensions and facts as stored by the refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from caudal.operators.joins import anchor_dates
from caudal.operators.model import build_dim
from caudal.plans import star
from workload import bindings, lake
from workload.catalog import query
from workload.oracle import key, with_parts


@query("CLN-01 PRJ-01 PRJ-04 PRJ-05 FIL-02 FIL-03 DQ-04 SET-03 SNK-07", with_parts("SELECT * FROM coverage", "coverage"))
def clean_coverage(spark, d):
    return lake.clean_table(spark, d, "coverage")


@query("CLN-02 PRJ-02 FIL-04 SRC-11", with_parts("SELECT * FROM indicators", "indicators"))
def clean_indicators(spark, d):
    return lake.clean_table(spark, d, "indicators")


@query("CLN-02 AGG-01 DQ-05 RUL-16", with_parts("SELECT * FROM climate", "climate"))
def clean_climate(spark, d):
    return lake.clean_table(spark, d, "climate")


@query("DIM-01 WIN-07 SNK-05", with_parts("SELECT * FROM country", "country"))
def dim_country(spark, d):
    return lake.model(spark, d)["country"]


@query("DIM-01", with_parts(f"SELECT DISTINCT {key('country_iso3')} AS country_key, country_iso3, country_name, 'Latin America and Caribbean' AS region_name FROM coverage", "coverage"))
def dim_country_constant_region(spark, d):
    return star.country_dim(lake.clean_table(spark, d, "coverage"))


@query("DIM-02 WIN-07", with_parts("SELECT * FROM residence_type", "residence_type"))
def dim_residence_type(spark, d):
    return lake.model(spark, d)["residence_type"]


@query("DIM-02", with_parts("SELECT * FROM service_type", "service_type"))
def dim_service_type(spark, d):
    return lake.model(spark, d)["service_type"]


@query("DIM-02", with_parts("SELECT * FROM service_level", "service_level"))
def dim_service_level(spark, d):
    return lake.model(spark, d)["service_level"]


@query("DIM-03", with_parts("SELECT * FROM indicator", "indicator"))
def dim_indicator(spark, d):
    return lake.model(spark, d)["indicator"]


@query("DIM-03", with_parts("SELECT * FROM province", "province"))
def dim_province(spark, d):
    return lake.model(spark, d)["province"]


@query("DIM-04 RUL-21 RUL-24 AGG-12", with_parts("SELECT * FROM calendar", "calendar"))
def dim_date(spark, d):
    return lake.model(spark, d)["date"]


@query("JOI-02", with_parts("SELECT year, date_key FROM calendar WHERE month = 12 AND day(date) = 31", "calendar"))
def year_anchors(spark, d):
    return anchor_dates(lake.model(spark, d)["date"])


@query("JOI-03", with_parts("SELECT year, month, max(date_key) AS date_key FROM calendar GROUP BY 1, 2", "calendar"))
def month_anchors(spark, d):
    return anchor_dates(lake.model(spark, d)["date"], "month")


@query("FCT-01 AGG-02 RUL-16 JOI-01 JOI-03 PRJ-09 SNK-04", with_parts("SELECT * FROM fact_monthly", "fact_monthly"))
def fact_climate_monthly(spark, d):
    return lake.model(spark, d)["climate_monthly"]


@query("FCT-02 AGG-03 AGG-04 JOI-01 JOI-02 PRJ-09 SNK-04", with_parts("SELECT * FROM fact_annual", "fact_annual"))
def fact_climate_annual(spark, d):
    return lake.model(spark, d)["climate_annual"]


@query("FCT-03 JOI-01 JOI-02 PRJ-09 SNK-04", with_parts("SELECT * FROM fact_coverage", "fact_coverage"))
def fact_wash_coverage(spark, d):
    return lake.model(spark, d)["wash_coverage"]


@query("FCT-04 JOI-01 JOI-02 PRJ-09 SNK-04", with_parts("SELECT * FROM fact_socioeconomic", "fact_socioeconomic"))
def fact_socioeconomic(spark, d):
    return lake.model(spark, d)["socioeconomic"]


@query("WIN-07 DIM-01", f"SELECT {key('c_name')} AS customer_key, c_name, max(c_mktsegment) AS c_mktsegment FROM customer GROUP BY c_name")
def dim_customer(spark, d):
    return build_dim(bindings.table(spark, d, "customer"), ["c_name"], "customer_key", ["c_mktsegment"])


@query("PRJ-07 PRJ-08", with_parts("SELECT date_key // 10000 AS year, count(*) AS n FROM fact_monthly GROUP BY 1", "fact_monthly"))
def year_from_date_key(spark, d):
    from caudal.functions.dates import year_of_key

    rows = lake.model(spark, d)["climate_monthly"]
    return rows.groupBy(year_of_key("date_key").alias("year")).agg(F.count(F.lit(1)).alias("n"))
