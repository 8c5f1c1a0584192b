"""The driver's tables in the roles of the landed sources.

country ~ nation, region ~ region, residence type ~ market segment (plus a total),
service ~ expedited or regular orders, level ~ order status, coverage ~ percentage of
the orders; province ~ supplier, daily climate ~ shipped lineitems; indicators ~ yearly
order averages of a nation.

Order and lineitem rows are counted per customer or supplier before names are joined,
so a customer or supplier with a third of all rows reaches the join as a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caudal.operators.filters import keep_known
from caudal.operators.joins import attach
from caudal.plans import kpis
from caudal.plans.cleaning import clean_coverage, clean_indicators, monthly_climate
from caudal.sources.readers import read_table

SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")
RESIDENCES = ("total", *SEGMENTS)
RESIDENCE_CODES = {"total": "TOT", "automobile": "AUT", "building": "BUI", "furniture": "FUR", "household": "HOU", "machinery": "MAC"}
URBAN, RURAL = "building", "machinery"
WATER, SANITATION = "expedited", "regular"
PRICE, ORDERS, BALANCE = "OR.PRC.AVG", "OR.CNT.TOT", "CU.BAL.AVG"
INDICATOR_NAMES = {PRICE: "average order price", ORDERS: "number of orders", BALANCE: "average balance"}
DRY_BELOW, HEAVY_ABOVE = 30, 300

# The indicators on these roles; levels are order statuses.
PARAMS = {
    "kpi_01": kpis.ClimateWater(kpis.Pick(WATER, ("f",), (URBAN, RURAL), None)),
    "kpi_02": kpis.WaterMobility(kpis.Pick(WATER, ("p",), (URBAN, RURAL)), 5, (30, 36)),
    "kpi_03": kpis.CriticalZones(kpis.Pick(SANITATION, None, (URBAN,), None), ("p",), 66.0),
    "kpi_04": kpis.HealthRisk(
        pick=kpis.Pick(SANITATION, ("f",)), mortality=PRICE, poverty=BALANCE, population=ORDERS,
        limits={"sanitation": (0, 100), "mortality": (0, 400000), "poverty": (0, 10000)},
        types={"child_mortality_rate": "decimal(12,3)", "poverty_rate": "decimal(8,2)", "population_total": "bigint"},
        edges=(60, 62),
    ),
    "kpi_05": kpis.UrbanRuralGap(kpis.Pick(WATER, ("f", "o"), (URBAN, RURAL))),
    "kpi_06": kpis.WaterGdp(kpis.Pick(WATER, ("f", "o")), PRICE),
    "kpi_07": kpis.WaterSanitationGap(kpis.Pick(WATER, ("f", "o")), kpis.Pick(SANITATION, ("f", "o")), (2.5, 5)),
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name, suffix=".parquet")


def nations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("country_iso3"), F.translate("n_name", "_", " ").alias("country_name"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select(F.col("n_name").alias("country_iso3"), F.col("n_regionkey").alias("r_regionkey"))
    return attach(nation, table(spark, d, "region"), "r_regionkey").select("country_iso3", F.col("r_name").alias("region_name"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), F.lower("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"))
    return attach(rows, nations(spark, d), "n_nationkey", how="inner")


def yearly_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders counted per customer, year, service and level."""
    service = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Expedited").otherwise("Regular")
    rows = table(spark, d, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), service.alias("service"), F.upper("o_orderstatus").alias("level"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    return rows.groupBy("o_custkey", "year", "service", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


def landed_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The coverage survey as it would land, one row per country, residence, service, level and year."""
    named = attach(yearly_orders(spark, d), customers(spark, d), "o_custkey", ["country_iso3", "country_name", "segment"], "inner")
    fine = named.groupBy("country_iso3", "country_name", "segment", "service", "level", "year").agg(F.sum("n").alias("n"))
    both = fine.withColumn("residence", F.explode(F.array(F.lit("total"), F.col("segment"))))
    cells = both.groupBy("country_iso3", "country_name", "residence", "service", "level", "year").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("country_iso3", "residence", "service", "year")  # at most one row per status
    return cells.withColumn("whole", F.sum("n").over(whole)).select(
        F.col("country_iso3").alias("ISO3"), F.col("country_name").alias("Country"), F.col("residence").alias("Residence Type"),
        F.col("service").alias("Service Type"), F.col("year").cast("bigint").alias("Year"),
        (F.col("n") * 100.0 / F.col("whole")).alias("Coverage"), F.col("whole").cast("double").alias("Population"),
        F.col("level").alias("Service level"),
    )


def coverage(spark: SparkSession, d: str) -> DataFrame:
    return clean_coverage(landed_coverage(spark, d), RESIDENCES, RESIDENCE_CODES)


def landed_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Three yearly figures per nation, stacked to one row per indicator."""
    named = attach(yearly_orders(spark, d), customers(spark, d), "o_custkey", ["country_iso3", "country_name", "balance"], "inner")
    sums = named.groupBy("country_iso3", "country_name", "year").agg(
        F.sum("n").alias("n"), F.sum("price").cast("decimal(24,2)").alias("price"),
        F.sum(F.col("balance") * F.col("n").cast("decimal(14,0)")).cast("decimal(24,2)").alias("balance"))
    n = F.col("n").cast("decimal(14,0)")
    wide = sums.select("country_iso3", "country_name", "year",
                       (F.col("price") / n).cast("decimal(24,6)").cast("double").alias(PRICE),
                       F.col("n").cast("double").alias(ORDERS),
                       (F.col("balance") / n).cast("decimal(24,6)").cast("double").alias(BALANCE))
    long = wide.unpivot(["country_iso3", "country_name", "year"], [f"`{c}`" for c in (PRICE, ORDERS, BALANCE)], "indicator_code", "value")
    name = F.create_map(*[F.lit(x) for pair in INDICATOR_NAMES.items() for x in pair])
    return long.select(
        F.col("country_iso3").alias("country_code"), "country_name", "indicator_code",
        F.element_at(name, F.col("indicator_code")).alias("indicator_name"), F.col("year").cast("bigint").alias("date"), "value",
        F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("obs_status"), F.lit(0).cast("bigint").alias("decimal"))


def indicators(spark: SparkSession, d: str) -> DataFrame:
    return clean_indicators(landed_indicators(spark, d))


def daily_climate(spark: SparkSession, d: str) -> DataFrame:
    """Lineitems as daily readings of a supplier. Whole-number measures keep averages exact."""
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").alias("date"),
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        (F.col("l_linenumber") * 5).cast("double").alias("temperature_2m_max"),
        F.round(F.col("l_tax") * 100).alias("temperature_2m_min"),
        F.col("l_quantity").alias("precipitation_sum"),
        F.round(F.col("l_discount") * 100).alias("et0_fao_evapotranspiration"),
    )


def provinces(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("province_name"), F.col("s_nationkey").alias("n_nationkey"))
    return attach(rows, nations(spark, d), "n_nationkey", ["country_iso3", "country_name"], "inner")


def climate_years(spark: SparkSession, d: str) -> DataFrame:
    """First and last year that ``climate`` has of every supplier, without its measures."""
    years = keep_known(daily_climate(spark, d), ["year", "month"]).groupBy("s_suppkey").agg(F.array(F.min("year"), F.max("year")).alias("ends"))
    return attach(years, provinces(spark, d), "s_suppkey", ["province_name"], "inner").select(F.explode("ends").alias("year"))


def climate(spark: SparkSession, d: str) -> DataFrame:
    """Monthly climate: reduced per supplier first, named afterwards."""
    monthly = monthly_climate(daily_climate(spark, d), ["s_suppkey"], DRY_BELOW, HEAVY_ABOVE)
    named = attach(monthly, provinces(spark, d), "s_suppkey", ["country_iso3", "province_name"], "inner")
    return named.drop("s_suppkey")


CLEANED = {"coverage": coverage, "indicators": indicators, "climate": climate}
