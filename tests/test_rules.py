"""Every band at its edges, with NULL and NaN."""

import math

import pytest
from pyspark.sql import functions as F

from caudal.functions import bands, dates, numeric, text


def apply(spark, inputs, rule, dtype="double"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {dtype}").select("i", rule(F.col("x")).alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


def nxt(x):
    return math.nextafter(x, math.inf)


def prv(x):
    return math.nextafter(x, -math.inf)


@pytest.mark.parametrize(
    ("rule", "inputs", "expected"),
    [
        (bands.correlation_risk, [None, math.nan, 0.0, prv(0.3), 0.3, -0.3, prv(0.6), 0.6, -1.0],
         ["gray", "gray", "green", "green", "yellow", "yellow", "yellow", "red", "red"]),
        (lambda c: bands.correlation_risk(c, bands.TRAFFIC_ES, "Verde"), [None, 0.29, 0.3, -0.6], ["Verde", "Verde", "Amarillo", "Rojo"]),
        (bands.impact_direction, [None, math.nan, 0.2, prv(0.2), -0.2, nxt(-0.2), 0.0],
         ["uncertain", "uncertain", "direct", "uncertain", "inverse", "uncertain", "uncertain"]),
        (bands.level_risk, [None, 0.0, 5.0, nxt(5.0), 20.0, nxt(20.0)], ["gray", "green", "green", "yellow", "yellow", "red"]),
        (bands.yearly_trend, [None, 0.5, nxt(0.5), -0.5, prv(-0.5), 0.0], ["no_previous_year", "stable", "worsened", "stable", "improved", "stable"]),
        (bands.gap_trend, [None, 0.1, nxt(0.1), -0.1, prv(-0.1)], ["Sin datos previos", "Estable", "Empeorando", "Estable", "Mejorando"]),
        (lambda c: bands.gap_risk(c, (10, 20)), [None, 9.99, 10.0, -10.0, 19.99, 20.0, -20.0], ["Verde", "Verde", "Amarillo", "Amarillo", "Amarillo", "Rojo", "Rojo"]),
        (lambda c: bands.gap_risk(c, (10, 15)), [14.99, 15.0], ["Amarillo", "Rojo"]),
        (bands.index_risk, [None, 20.0, nxt(20.0), 40.0, nxt(40.0)], ["Datos Faltantes", "Verde", "Amarillo", "Amarillo", "Rojo"]),
        (bands.zone_count_risk, [0.0, 5.0, 6.0, 20.0, 21.0], ["Verde", "Verde", "Amarillo", "Amarillo", "Rojo"]),
        (bands.correlation_strength, [0.0, 0.3, 0.6], ["baja", "media", "alta"]),
        (bands.correlation_direction, [-0.1, 0.0, 0.1, None], ["negativa", "sin dirección clara", "positiva", None]),
        (lambda c: bands.below(c, 10), [9.99, 10.0, None], [True, False, None]),
        (lambda c: bands.above(c, 150), [150.0, 150.01, None], [False, True, None]),
    ],
)
def test_band_edges(spark, rule, inputs, expected):
    assert apply(spark, inputs, rule) == expected


def test_band_rejects_wrong_labels():
    with pytest.raises(ValueError):
        bands.band("x", (1, 2), ("a", "b"))


@pytest.mark.parametrize(
    ("n", "r", "expected"),
    [(2, -0.9, "uncertain"), (3, -0.3, "decreasing"), (3, nxt(-0.3), "stable"), (3, 0.3, "increasing"), (3, prv(0.3), "stable"), (5, None, "stable")],
)
def test_trend_label(spark, n, r, expected):
    df = spark.createDataFrame([(n, r)], "n int, r double")
    assert df.select(bands.trend_label("n", "r")).first()[0] == expected


def test_quadrant(spark):
    cases = [(1.0, 1.0, "up_up"), (-1.0, 1.0, "down_up"), (1.0, -1.0, "up_down"), (-1.0, -1.0, "down_down"), (0.0, 1.0, "small"),
             (1.0, 0.0, "small"), (1e-7, -1e-7, "small"), (None, 1.0, "small"), (1.0, None, "small"), (1e-7, 1.0, "up_up"), (math.nan, 1.0, "small")]
    df = spark.createDataFrame(cases, "dx double, dy double, expected string")
    named = {k: k for k in bands.QUADRANT_LABELS}
    assert [r.expected for r in df.collect()] == [r[0] for r in df.select(bands.quadrant("dx", "dy", labels=named)).collect()]


def test_zone_status(spark):
    rows = [(True, True, True, "red"), (False, True, False, "yellow"), (None, None, True, "yellow"), (None, None, None, "green")]
    df = spark.createDataFrame(rows, "c boolean, a boolean, b boolean, e string")
    assert [r[0] for r in df.select(bands.zone_status("c", "a", "b")).collect()] == [r[3] for r in rows]


def test_minmax_norm(spark):
    assert apply(spark, [None, -1.0, 0.0, 75.0, 150.0, 151.0], lambda c: numeric.minmax_norm(c, 0, 150)) == [None, 0.0, 0.0, 0.5, 1.0, 1.0]
    assert apply(spark, [None, 3.0], lambda c: numeric.minmax_norm(c, 5, 5)) == [None, 1.0]


def test_weighted_index_steps_and_missing_terms(spark):
    df = spark.createDataFrame([(0.12345, None), (0.5, 0.5)], "a double, b double")
    terms = {"a": F.col("a"), "b": F.col("b")}
    rough = [float(r[0]) for r in df.select(numeric.weighted_index(terms, {"a": 1.0, "b": 0.2})).collect()]
    assert rough == [12.3, 60.0]
    fine = [r[0] for r in df.select(numeric.weighted_index(terms, {"a": 1.0, "b": 0.2}, digits=None)).collect()]
    assert fine == pytest.approx([12.345, 60.0])


def test_gap(spark):
    df = spark.createDataFrame([(5.0, 3.0), (5.0, None), (None, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.gap("a", "b")).collect()] == [2.0, 5.0, -3.0]
    assert [r[0] for r in df.select(numeric.gap("a", "b", "null")).collect()] == [2.0, None, None]
    with pytest.raises(ValueError):
        numeric.gap("a", "b", "other")


def test_one_in_n_rounds_half_to_even(spark):
    assert apply(spark, [40.0, 100.0, 250.0, 0.0, -1.0, None, 33.0], numeric.one_in_n) == [2, 1, 1, None, None, None, 3]


def test_clip_and_finite(spark):
    assert apply(spark, [-1.0, 50.0, 101.0, None], lambda c: numeric.clip(c, 0.0, 100.0)) == [0.0, 50.0, 100.0, None]
    assert apply(spark, [math.nan, math.inf, -math.inf, 1.5, None], numeric.finite) == [None, None, None, 1.5, None]


def test_safe_corr(spark):
    rows = [("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.0), ("flat", 1.0, 5.0), ("flat", 2.0, 5.0), ("single", 1.0, 1.0),
            ("holes", 1.0, 3.0), ("holes", 2.0, 2.0), ("holes", 3.0, 1.0), ("holes", 900.0, None), ("holes", None, 7.0), ("holes", math.nan, 8.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: r.r for r in df.groupBy("k").agg(numeric.safe_corr("x", "y").alias("r")).collect()}
    assert got["up"] == pytest.approx(1.0) and got["holes"] == pytest.approx(-1.0)
    assert got["flat"] is None and got["single"] is None


def test_date_keys(spark):
    df = spark.createDataFrame([(20240229,), (19991231,), (None,)], "k int")
    assert [r[0] for r in df.select(dates.year_of_key("k")).collect()] == [2024, 1999, None]
    row = spark.range(1).select(dates.month_end_key(F.lit(2024), F.lit(2)), dates.year_end_key(F.lit(2023)), dates.timestamp_of_micros(F.lit(1_700_000_000_123_456))).first()
    assert (row[0], row[1], str(row[2])) == (20240229, 20231231, "2023-11-14 22:13:20.123456")


def test_text_rules(spark):
    assert apply(spark, [" Urban ", None], text.clean_text, "string") == ["urban", None]
    assert apply(spark, ["total", "urban", "rural", "other", None], lambda c: text.code_of(c, text.RESIDENCE_CODES, "UNK"), "string") == ["TOT", "URB", "RUR", "UNK", "UNK"]
    assert apply(spark, ["green", "odd", None], lambda c: text.label_of(c, bands.RISK_LABELS), "string") == ["Bajo, relación débil", "odd", None]
    assert apply(spark, ["x", None], lambda c: text.joined_label([c, F.lit("y")]), "string") == ["x – y", None]
    assert apply(spark, ["/a/open_meteo/ARG/x.parquet"], lambda c: text.key_from_path(c, "open_meteo/([A-Z]{3})/"), "string") == ["ARG"]


def test_stable_key_depends_on_the_natural_key_only(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("a", "b")], "x string, y string")
    one = [r[0] for r in df.select(text.stable_key("x", "y")).collect()]
    other = [r[0] for r in df.repartition(7).select("x", text.stable_key("x", "y").alias("k")).where("x = 'a'").collect() for r in [(r.k,)]]
    assert one[0] == one[2] != one[1] and set(other) == {one[0]}
