import math

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from caudal.operators import aggregates, filters, joins, model, profile, projection, quality, windows
from caudal.operators.projection import Contract, Field

from conftest import values


# ---- projection -----------------------------------------------------------------------


def test_conform_names_the_missing_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing required column: b"):
        projection.conform(df, Contract("t", (Field("x", "int", "a"), Field("y", "int", "b"))))


def test_conform_casts_leniently_and_fills_absent_columns(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "a string")
    contract = Contract("t", (Field("n", "int", "a"), Field("zone", "string", required=False, default="Unknown"), Field("w", "decimal(3,1)", required=False, default=0.0)))
    out = projection.conform(df, contract)
    assert [r.n for r in out.collect()] == [12, None, None]
    assert {(r.zone, float(r.w)) for r in out.collect()} == {("Unknown", 0.0)}
    assert out.schema.simpleString() == contract.schema.simpleString()


def test_decimal_overflow_becomes_null(spark):
    out = projection.with_types(spark.createDataFrame([(999.99,), (1000.0,)], "x double"), {"x": "decimal(5,2)"})
    assert [r.x is None for r in out.collect()] == [False, True]


def test_result_overflow_fails_instead_of_losing_a_value(spark):
    with pytest.raises(PySparkException, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        projection.with_exact_types(spark.createDataFrame([(1000.0,)], "x double"), {"x": "decimal(5,2)"}).collect()


def test_empty_like_has_the_contract_schema(spark):
    contract = Contract("t", (Field("n", "int"), Field("p", "decimal(5,2)")))
    out = projection.empty_like(spark, contract)
    assert out.count() == 0 and out.schema == contract.schema


def test_serve(spark):
    df = spark.createDataFrame([(1, math.nan), (2, math.inf), (3, 1.5)], "i int, x double").withColumn("d", F.lit(1.25).cast("decimal(5,2)"))
    out = projection.serve(df)
    assert values(out) == [(1, None, 1.25), (2, None, 1.25), (3, 1.5, 1.25)]
    assert out.schema["d"].dataType.simpleString() == "double"


def test_dictionary(spark):
    from caudal.plans import contracts

    rows = projection.dictionary(spark, [contracts.INDICATORS, contracts.coverage_contract()]).collect()
    assert len(rows) == 14 and all(r.description for r in rows)
    assert {r.column_original for r in rows if r.column_normalized == "year"} == {"date", "Year"}


# ---- filters --------------------------------------------------------------------------


def test_keep_known_counts_what_it_drops(spark):
    seen = Observation()
    out = filters.keep_known(spark.createDataFrame([(1,), (None,), (3,)], "a int"), ["a"], seen)
    assert out.count() == 2 and seen.get == {"dropped": 1, "total": 3}


def test_clip_latest_and_positive(spark):
    df = spark.createDataFrame([(y, float(y - 2001)) for y in range(2000, 2006)], "year int, v double")
    ref = spark.createDataFrame([(2001,), (2003,)], "year int")
    assert values(filters.clip_to_range(df, ref, "year"), "year") == [2001, 2002, 2003]
    assert values(filters.latest(df), "year") == [2005] and values(filters.earliest(df), "year") == [2000]
    assert values(filters.positive(df, "v"), "year") == [2002, 2003, 2004, 2005]
    assert filters.clip_to_range(df, ref.where("year > 9999"), "year").count() == 0


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert filters.drop_incomplete(df, "all", ["a", "b"]).count() == 2
    assert filters.drop_incomplete(df, "any", ["a", "b"]).count() == 1


# ---- joins ----------------------------------------------------------------------------


def test_attach_verifies_uniqueness(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    assert values(joins.attach(df, good, "k", verify=True)) == [(1, "a"), (2, None), (None, None)]
    with pytest.raises(PySparkException, match="duplicate key in lookup"):
        joins.attach(df, good.union(good), "k", verify=True).collect()


@pytest.mark.parametrize("salt", [1, 4])
def test_attach_is_the_same_with_salt(spark, salt):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id").repartition(6)
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k bigint, name string")
    out = joins.attach(df, dim, "k", ["name"], salt=salt)
    assert out.count() == 1000 and out.where("name IS NULL AND k < 5").count() == 0 and "_salt" not in out.columns


def test_group_stats_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, v double")
    out = joins.with_group_stats(df, ["k"], {"m": F.avg("v")})
    assert values(out) == [("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, 5.0)]


def test_anchor_dates(spark):
    calendar = model.build_calendar(spark, 2023, 2024)
    assert calendar.count() == 365 + 366
    assert values(joins.anchor_dates(calendar), "date_key") == [20231231, 20241231]
    months = {(r.year, r.month): r.date_key for r in joins.anchor_dates(calendar, "month").collect()}
    assert len(months) == 24 and months[(2024, 2)] == 20240229 and months[(2023, 2)] == 20230228


def test_orphans(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert values(joins.orphans(df, spark.createDataFrame([(1,)], "k int"), "k"), "k") == [2, 2]


# ---- aggregates -----------------------------------------------------------------------


def test_monthly_rollup_fills_sums_before_averaging(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, 4.0), ("a", 2.0, 6.0)], "k string, rain double, t double")
    row = aggregates.monthly_rollup(df, ["k"], {"rain_sum": "rain"}, {"rain_avg": "rain", "t_avg": "t"}).first()
    assert (row.rain_sum, row.rain_avg, row.t_avg) == (3.0, 1.0, 5.0)


def test_annual_rollup_counts_every_province(spark):
    rows = [("A", 10.0, True)] * 12 + [("A", 20.0, True)] * 12
    df = spark.createDataFrame(rows, "c string, rain double, dry boolean")
    row = aggregates.annual_rollup(df, ["c"], {"total": "rain"}, {"mean": "rain"}, {"avg": "rain"}, {"n_dry": "dry"}, {"rate": "dry"}).first()
    assert (float(row.total), float(row["mean"]), float(row.avg), row.n_dry, float(row.rate)) == (360.0, 30.0, 15.0, 24, 2.0)


def test_first_last_change(spark):
    df = spark.createDataFrame([("a", 2000, 10.0), ("a", 2002, 8.5), ("b", 2000, 1.0), ("c", 2000, 1.0), ("c", 2001, 2.0)], "k string, y int, v double")
    assert values(aggregates.first_last_change(df, ["k"], "y", "v"), "k", "change", "direction") == [("a", -1.5, "improved"), ("c", 1.0, "stable")]


def test_rollup_total_is_over_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 6.0), (None, 3.0)], "k string, v double")
    out = values(aggregates.rollup_total(df, "k", {"m": F.avg("v")}), "k", "m")
    assert out == [("Regional", 3.0), ("a", 1.5), ("b", 6.0), (None, 3.0)]


def test_distribution_order(spark):
    df = spark.createDataFrame([("Verde",), ("Rojo",), ("Rojo",), ("x",)], "r string")
    rows = {r.level: (r.n, float(r.pct), r.position) for r in aggregates.distribution(df, "r", ["Rojo", "Amarillo", "Verde"]).collect()}
    assert rows == {"Rojo": (2, 50.0, 1), "Verde": (1, 25.0, 3), "x": (1, 25.0, None)}


def test_pivot_renames_dotted_names(spark):
    df = spark.createDataFrame([(1, "SP.POP", 5.0), (1, "SP.POP", 7.0), (2, "XX", 1.0)], "k int, code string, v double")
    assert values(aggregates.pivot_values(df, ["k"], "code", {"SP.POP": "pop"}, "v")) == [(1, 7.0), (2, None)]


# ---- windows --------------------------------------------------------------------------


def test_yoy_delta_cases(spark):
    rows = [("one", 2000, 1.0), ("two", 2000, 1.0), ("two", 2001, 3.0), ("hole", 2000, 1.0), ("hole", 2003, 4.0), ("flat", 2000, 2.0), ("flat", 2001, 2.0)]
    df = spark.createDataFrame(rows, "k string, year int, v double")
    assert values(windows.yoy_delta(df, ["k"], "year", {"v": "d"}), "k", "year", "d") == [("flat", 2001, 0.0), ("hole", 2003, 3.0), ("two", 2001, 2.0)]
    assert values(windows.yoy_delta(df, ["k"], "year", {"v": "d"}, require_consecutive=True), "k") == ["flat", "two"]
    assert windows.yoy_delta(df, ["k"], "year", {"v": "d"}, drop_first=False).count() == len(rows)


def test_top_k_ties_and_groups(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([5, 5, -9, 1])] + [("b", 9, 2.0)], "g string, i int, v double")
    assert values(windows.top_k(df, "v", 1, tie_break=["i"]), "i") == [0]
    assert values(windows.top_k(df, "v", 2, ["g"], tie_break=["i"]), "i") == [0, 1, 9]
    assert values(windows.top_1(df, "v", ["g"], ["i"], absolute=True), "g", "i") == [("a", 2), ("b", 9)]


def _skewed(spark, n=20_000):
    """A third of the rows share one value, most belong to one group, some are unknown."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 5 == 0, "small").when(F.col("id") % 97 == 0, F.lit(None)).otherwise("big").alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)).cast("double") - 2500).alias("v"),
    )


@pytest.mark.parametrize("slices", [1, 3, 64])
@pytest.mark.parametrize("absolute", [False, True])
def test_rank_by_equals_brute_force(spark, slices, absolute):
    df = _skewed(spark)
    out = windows.rank_by(df, "v", "place", ["g"], absolute, slices).toPandas().sort_values("id")
    v = out["v"].abs() if absolute else out["v"]
    expected = v.groupby(out["g"].fillna("?")).rank(method="min", ascending=False)
    assert len(out) == 20_000
    assert out["place"].isna().equals(out["v"].isna())
    known = out["place"].notna()
    assert (out.loc[known, "place"].astype(int) == expected[known].astype(int)).all()


def test_rank_by_overall(spark):
    out = windows.rank_by(_skewed(spark), "v", "place").toPandas()
    known = out["v"].notna()
    assert (out.loc[known, "place"].astype(int) == out["v"].rank(method="min", ascending=False)[known].astype(int)).all()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_describe_by_equals_brute_force(spark, by):
    df = _skewed(spark)
    got = profile.describe_by(df, "v", by, slices=16).toPandas()
    pdf = df.toPandas()
    pdf["g"] = pdf["g"].fillna("?")
    expected = pdf.groupby("g")["v"].describe() if by else pd.DataFrame([pdf["v"].describe()], index=["all"])
    got.index = got["g"].fillna("?") if by else ["all"]
    for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "max": "max", "q25": "25%", "q50": "50%", "q75": "75%"}.items():
        assert np.allclose(got[ours].astype(float), expected.loc[got.index, theirs].astype(float)), ours


def test_quantiles_of_one_row_and_nothing(spark):
    one = spark.createDataFrame([(4.0,)], "v double")
    assert profile.describe_by(one, "v").first()["q50"] == 4.0
    empty = profile.describe_by(one.where("v > 9"), "v").first()
    assert empty["count"] == 0 and empty["q50"] is None


def test_nan_has_no_place(spark):
    df = spark.createDataFrame([(1, math.nan), (2, 5.0), (3, math.inf), (4, None), (5, 1.0)], "i int, v double")
    assert values(windows.rank_by(df, "v", "place"), "i", "place") == [(1, None), (2, 2), (3, 1), (4, None), (5, 3)]
    assert values(windows.top_k(df, "v", 2, tie_break=["i"]), "i") == [2, 3]
    assert values(windows.top_1(df.where("i <> 3").withColumn("g", F.lit(1)), "v", ["g"], ["i"]), "i") == [2]
    row = profile.describe_by(df.where("i <> 3"), "v").first()
    assert (row["count"], row["mean"], row["q50"]) == (2, 3.0, 3.0)


def test_scale_to_max(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 5.0), ("b", 0.0), ("b", -1.0)], "g string, v double")
    assert values(windows.scale_to_max(df, "v", "w", by=["g"]), "v", "w") == [(-1.0, 25000.0), (0.0, 25000.0), (5.0, 50000.0), (10.0, 80000.0)]
    assert values(windows.scale_to_max(df, "v", "w"), "v", "w")[-1] == (10.0, 80000.0)


# ---- quality, profile, model ----------------------------------------------------------


def test_dq_report(spark):
    df = spark.createDataFrame([(1, -2.0), (None, 101.0), (3, None)], "a int, b double")
    got = {(r.check_name, r.column_name): (r.n_bad, r.n_total) for r in quality.dq_report(df, quality.nulls(["a", "b"]) + quality.negatives(["b"]) + quality.outside("b", 0, 100)).collect()}
    assert got == {("null", "a"): (1, 3), ("null", "b"): (1, 3), ("negative", "b"): (1, 3), ("out_of_range", "b"): (2, 3)}


def test_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, None), (None, None)], "k int, v string")
    assert (quality.duplicate_rows(df).first().n_bad, quality.repeated_keys(df, ["k"]).first().n_bad) == (2, 2)
    dim = spark.createDataFrame([(2,)], "k int")
    row = quality.unresolved_keys(df, dim, "k").first()
    assert (row.n_bad, row.n_total) == (5, 5)
    empty = quality.duplicate_rows(df.where("k = 9")).first()
    assert (empty.n_bad, empty.n_total) == (0, 0)


def test_temporal_checks(spark):
    df = spark.createDataFrame([(20231231, "2023-12-31", 2023, 12), (20230230, "2023-02-28", 2022, 3)], "k int, d string, y int, m int").withColumn("d", F.to_date("d"))
    got = {(r.check_name, r.column_name): r.n_bad for r in quality.dq_report(df, quality.date_parts_disagree("d", "y", "m", "k") + quality.not_period_end("k", "year")).collect()}
    assert got == {("date_part", "y"): 1, ("date_part", "m"): 1, ("date_key", "k"): 1, ("anchor", "k"): 1}


def test_fill_by_type_leaves_other_types(spark):
    df = spark.createDataFrame([(None, None, None, None)], "i int, d decimal(5,2), s string, ints array<int>")
    row = quality.fill_by_type(df).first()
    assert (row.i, float(row.d), row.s, row.ints) == (0, 0.0, "UNKNOWN", None)


def test_require_rows(spark):
    with pytest.raises(ValueError, match="no rows in orders"):
        quality.require_rows(spark.createDataFrame([], "a int"), "orders")


def test_schema_changes(spark):
    contract = Contract("t", (Field("a", "int"), Field("b", "string")))
    got = {(r.change, r.column_name) for r in quality.schema_changes(spark.createDataFrame([(1, 2)], "a bigint, c int"), contract).collect()}
    assert got == {("type", "a"), ("missing", "b"), ("unexpected", "c")}


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a")], "i int, s string")
    got = {r.column_name: (r.dtype, r.n_missing, r.pct_missing, r.n_unique, r.examples) for r in profile.profile(df).collect()}
    assert got == {"i": ("int", 0, 0.0, 2, "1, 2"), "s": ("string", 1, 33.33, 2, "a, b")}


def test_readable_size(spark):
    df = spark.createDataFrame([(0,), (1023,), (1024,), (1536,), (5 * 1024**3,)], "b bigint")
    assert [r[0] for r in df.select(profile.readable_size("b")).collect()] == ["0 B", "1023.0 B", "1.0 KB", "1.5 KB", "5.0 GB"]


def test_dim_is_one_row_per_natural_key(spark):
    df = spark.createDataFrame([("MEX", "Mexico"), ("MEX", "México"), ("ARG", "Argentina"), ("XXX", None), (None, "Nowhere")], "iso string, name string")
    dim = model.build_dim(df, ["iso"], "key", ["name"], {"region": "LAC"})
    assert values(dim, "iso", "name") == [("ARG", "Argentina"), ("MEX", "México")]
    again = model.build_dim(df.union(spark.createDataFrame([("BRA", "Brazil")], df.schema)).repartition(5), ["iso"], "key", ["name"])
    assert set(values(dim, "iso", "key")) < set(values(again, "iso", "key"))


def test_calendar_bounds(spark):
    frames = [spark.createDataFrame([(2001,), (2003,)], "year int"), spark.createDataFrame([], "year int")]
    assert model.year_bounds(frames) == (2001, 2003)
    with pytest.raises(ValueError, match="no source has a valid year"):
        model.year_bounds(frames[1:])
