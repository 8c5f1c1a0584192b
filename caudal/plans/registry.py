"""Which coverage rows answer which question: a declarative registry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    name: str
    services: tuple[str, ...]
    levels: tuple[str, ...]
    residences: tuple[str, ...]
    measure: str = "coverage"  # coverage, population or sum_of_coverage


# Question, services, levels, residence types and measure.
METRICS = (
    Metric("p1_agua_segura_rur_urb", ("drinking water",), ("safely managed service",), ("rural", "urban")),
    Metric("p2_movilidad_limitada", ("drinking water",), ("limited service",), ("total",), "population"),
    Metric("p3_4_riesgo_sanitario", ("sanitation",), ("limited service", "unimproved", "open defecation"), ("total",), "sum_of_coverage"),
    Metric("p5_agua_segura_brecha", ("drinking water",), ("at least basic",), ("rural", "urban")),
    Metric("p6_agua_segura_total", ("drinking water",), ("safely managed service",), ("total",)),
    Metric("p7_saneamiento_seg_total", ("drinking water", "sanitation"), ("safely managed service",), ("total",)),
)

GRAIN = ("country_iso3", "year", "residence_type_desc", "service_type_desc")


def _measures() -> dict[str, Column]:
    return {
        "coverage": F.max("coverage_pct").cast("double"),
        "sum_of_coverage": F.sum("coverage_pct").cast("double"),
        "population": F.sum(F.col("population_total") * F.col("coverage_pct") / 100).cast("double"),
    }


def _asks_for(metric: Metric) -> Column:
    return (
        F.col("service_type_desc").isin(list(metric.services))
        & F.col("service_level_desc").isin(list(metric.levels))
        & F.col("residence_type_desc").isin(list(metric.residences))
    )


def evaluate(coverage: DataFrame, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    """One value per metric, country, year, residence type and service. Coverage is read once: a row goes to each metric that asks for it."""
    asked = F.array_compact(F.array(*[F.when(_asks_for(m), F.struct(F.lit(m.name).alias("metric"), F.lit(m.measure).alias("measure"))) for m in metrics]))
    rows = coverage.where(reduce(lambda a, b: a | b, [_asks_for(m) for m in metrics]))
    rows = rows.select(*GRAIN, "coverage_pct", "population_total", F.inline(asked))
    measured = rows.groupBy("metric", "measure", *GRAIN).agg(*[c.alias(f"_{n}") for n, c in _measures().items()])
    value = F.coalesce(*[F.when(F.col("measure") == n, F.col(f"_{n}")) for n in _measures()])
    return measured.select("metric", *GRAIN, value.alias("value"))


def as_rows(spark: SparkSession, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    rows = [(m.name, list(m.services), list(m.levels), list(m.residences), m.measure) for m in metrics]
    return spark.createDataFrame(rows, "metric string, services array<string>, levels array<string>, residences array<string>, measure string")
