"""The three layers, each table written once per application and state of a table folder, as in production.

Queries on the star schema and the indicators read the stored layers, so facts are
pruned by year and lookups are small by their statistics. A table is built when it is
first asked for, from those it is made of, so a query waits for no others. Everything is
derived by Spark from the given tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from caudal.operators.quality import require_rows
from caudal.plans import kpis, star
from caudal.plans.refresh import CLEAN_KEYS, Layers, refresh_clean, refresh_gold, refresh_table
from caudal.plans.star import WIDE
from caudal.session import new_table_path
from caudal.sources.publish import Files
from workload import bindings

_built: dict[tuple, Layers] = {}


def _once(spark: SparkSession, d: str, stage: str, build) -> Layers:
    key = (spark.sparkContext.applicationId, Files(spark, d).listing(d), stage)
    if key not in _built:
        _built[key] = build()
    return _built[key]


class Tables(Mapping[str, DataFrame]):
    """Tables by name; one is opened, and built if need be, when it is asked for."""

    stable_keys = True  # written by refresh_table

    def __init__(self, names: Sequence[str], opened: Callable[[str], DataFrame]):
        self._names, self._opened = names, opened

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._opened(name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _layers(spark: SparkSession, d: str) -> Layers:
    return _once(spark, d, "layers", lambda: Layers(new_table_path(spark, "lake"), WIDE))  # sums of the given tables grow with them


def _stored(spark: SparkSession, d: str, layer: str, name: str, build: Callable[[Layers], object]) -> DataFrame:
    def built() -> Layers:
        layers = _layers(spark, d)
        build(layers)
        return layers

    return _once(spark, d, f"{layer}/{name}", built).read(spark, layer, name)


def clean_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return _stored(spark, d, "clean", name, lambda layers: refresh_clean(layers, {name: bindings.CLEANED[name](spark, d)}))


def model_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    def source(cleaned: str) -> DataFrame:
        # the calendar needs the years only
        return bindings.climate_years(spark, d) if (name, cleaned) == ("date", "climate") else clean_table(spark, d, cleaned)

    return _stored(spark, d, "model", name, lambda layers: refresh_table(
        layers, name, Tables(tuple(CLEAN_KEYS), source), model(spark, d), bindings.regions(spark, d), bindings.DRY_BELOW, bindings.HEAVY_ABOVE))


def model(spark: SparkSession, d: str) -> Mapping[str, DataFrame]:
    return Tables((*star.DIMENSIONS, *star.FACTS), lambda name: model_table(spark, d, name))


def gold(spark: SparkSession, d: str, name: str) -> DataFrame:
    def usable(table: str) -> DataFrame:
        df = model_table(spark, d, table)
        return require_rows(df, table) if table in kpis.REQUIRED_TABLES else df

    tables = Tables((*star.DIMENSIONS, *star.FACTS), usable)
    return _stored(spark, d, "gold", name, lambda layers: refresh_gold(spark, layers, bindings.PARAMS, model=tables, names=[name]))


def clean_layer(spark: SparkSession, d: str) -> Layers:
    for name in CLEAN_KEYS:
        clean_table(spark, d, name)
    return _layers(spark, d)


def model_layer(spark: SparkSession, d: str) -> Layers:
    tables = model(spark, d)
    for name in tables:
        tables[name]
    return _layers(spark, d)


def gold_layer(spark: SparkSession, d: str, names: Sequence[str] = tuple(kpis.KPIS)) -> Layers:
    for name in names:
        gold(spark, d, name)
    return _layers(spark, d)
