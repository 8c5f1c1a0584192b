"""Full and per-period refresh of the three layers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from caudal.functions.numeric import Number
from caudal.operators.joins import unique_on
from caudal.operators.quality import full_report, require_tables, unresolved_in_one_read
from caudal.plans import contracts, kpis, star
from caudal.sources.readers import read_table, slice_period
from caudal.sources.publish import Files, Publication, recover
from caudal.sources.writers import Sink, write_table, write_to

# One declared layout per dataset, by period: refreshes replace periods, and a layout that
# also splits by country or surrogate key would give one small file per country and year.
CLEAN_KEYS = {"coverage": ("year",), "indicators": ("year",), "climate": ("year", "month")}
FACT_KEYS = ("year",)
# Facts are sorted by what indicators filter on, so scans skip row groups.
FACT_ORDER = {
    "wash_coverage": ("service_type_key", "service_level_key", "residence_type_key", "country_key"),
    "socioeconomic": ("indicator_key", "country_key"),
    "climate_monthly": ("province_key", "date_key"),
    "climate_annual": ("country_key",),
}
CLEAN_CONTRACTS = {"coverage": contracts.coverage_contract, "indicators": lambda: contracts.INDICATORS, "climate": lambda: contracts.CLIMATE_MONTHLY}


@dataclass(frozen=True)
class Layers:
    """Where the layers live under one root, and the types of the facts in them."""

    root: str
    types: star.FactTypes = star.CONTRACT

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def sink(self, layer: str, name: str) -> Sink:
        keys = CLEAN_KEYS[name] if layer == "clean" else FACT_KEYS if name in star.FACTS else ()
        return Sink(self.path(layer, name), keys, order=FACT_ORDER.get(name, ()) if layer == "model" else ())

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        schema = star.schemas(self.types)[name] if layer == "model" else CLEAN_CONTRACTS[name]().schema if layer == "clean" else None
        return read_table(spark, f"{self.root.rstrip('/')}/{layer}", name, schema)


class StoredModel(Mapping[str, DataFrame]):
    """The stored star schema; a table is opened when it is asked for."""

    stable_keys = True  # written by refresh_star

    def __init__(self, spark: SparkSession, layers: Layers):
        self._spark, self._layers = spark, layers

    def __getitem__(self, name: str) -> DataFrame:
        if name not in star.DIMENSIONS and name not in star.FACTS:
            raise KeyError(name)
        return self._layers.read(self._spark, "model", name)

    def __iter__(self):
        return iter((*star.DIMENSIONS, *star.FACTS))

    def __len__(self) -> int:
        return len(star.DIMENSIONS) + len(star.FACTS)


def run_job(read: Callable[[], DataFrame], clean: Callable[[DataFrame], DataFrame], sink: Sink,
            check: Callable[[DataFrame], None] | None = None) -> int:
    """Read, check, clean, write: the template every dataset goes through. One write action."""
    landed = read()
    if check is not None:
        check(landed)
    return write_to(landed.transform(clean), sink)


def refresh_clean(layers: Layers, cleaned: Mapping[str, DataFrame], year: int | None = None, month: int | None = None) -> dict[str, int]:
    """Write cleaned tables, whole or one period; other partitions are left alone.

    A period of which nothing is left becomes empty. A month without a year replaces the
    partitions that it occurs in. Periods of all tables are switched together, after all
    are written.
    """
    written = {}
    if not cleaned:
        return written
    with Publication(next(iter(cleaned.values())).sparkSession) as publication:
        for name, df in cleaned.items():
            of_month = month if name == "climate" else None
            period = {k: v for k, v in (("year", year), ("month", of_month)) if v is not None} if year is not None else None
            written[name] = write_to(slice_period(df, year, of_month), layers.sink("clean", name), period=period, publication=publication)
    return written


def read_clean(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {name: layers.read(spark, "clean", name) for name in CLEAN_KEYS}


def refresh_star(
    spark: SparkSession,
    layers: Layers,
    year: int | None = None,
    regions: DataFrame | None = None,
    dry_below: Number = star.DRY_MONTH_MM,
    heavy_above: Number = star.HEAVY_RAIN_MONTH_MM,
) -> dict[str, int]:
    """Rewrite dimensions and facts of all years, or of one year.

    Keys depend on natural keys only, so facts of other years stay valid. One year's
    members are merged into the stored dimensions, and its facts recomputed from all its
    months; other years are not read. Dimensions are checked when they are written, so
    lookups need no check of their own. All tables are switched together at the end: a
    repeated key or a measure that does not fit leaves the old model.
    """
    sources = {name: slice_period(df, year) for name, df in read_clean(spark, layers).items()}
    stored = {} if year is None else {name: layers.read(spark, "model", name) for name in star.DIMENSIONS if recover_or_find(spark, layers.path("model", name))}
    if len(stored) == len(star.DIMENSIONS):
        built = star.merge_dims(stored, sources, regions)
    else:
        built = star.build_dims(read_clean(spark, layers), regions)
    built = {name: _keyed(name, df) for name, df in built.items()}
    written, dims = {}, {}
    with Publication(spark) as publication:
        for name, df in built.items():
            path = layers.path("model", name)
            written[name] = publication.stage(df, path)
            dims[name] = publication.read(path, star.schemas(layers.types)[name])
        for name, df in star.build_facts(sources, dims, dry_below, heavy_above, layers.types, verify=False).items():
            written[name] = write_to(df, layers.sink("model", name), "static", None if year is None else {"year": year}, publication)
    return written


def _keyed(name: str, dim: DataFrame) -> DataFrame:
    """A dimension with a check of its key: two entities with one key would become one in every fact."""
    return unique_on(dim, f"{name}_key") if name != "date" else dim


def refresh_table(
    layers: Layers,
    name: str,
    sources: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    regions: DataFrame | None = None,
    dry_below: Number = star.DRY_MONTH_MM,
    heavy_above: Number = star.HEAVY_RAIN_MONTH_MM,
) -> int:
    """Rewrite one dimension or fact; of cleaned tables and stored dimensions, only those it is made of are opened."""
    if name in star.DIMENSIONS:
        return write_to(_keyed(name, star.build_dims(sources, regions, [name])[name]), layers.sink("model", name))
    return write_to(star.build_facts(sources, dims, dry_below, heavy_above, layers.types, False, [name])[name], layers.sink("model", name), "static")


def recover_or_find(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored, after taking it back from an interrupted publication."""
    return recover(spark, path) or Files(spark, path).exists(path)


def read_model(spark: SparkSession, layers: Layers) -> Mapping[str, DataFrame]:
    return StoredModel(spark, layers)


def foreign_key_report(model: Mapping[str, DataFrame]) -> DataFrame:
    """Unresolved foreign keys of every fact, to look at before serving. Each fact is read once."""
    reports = [unresolved_in_one_read(model[fact], {key: model[key.removesuffix("_key")] for key in star.FACT_GRAIN[fact]}) for fact in star.FACTS]
    return full_report(reports)


def require_resolved_keys(model: Mapping[str, DataFrame]) -> None:
    """Stop if a fact has unresolved foreign keys. The driver sees a row for each key."""
    bad = [f"{r.column_name}: {r.n_bad} of {r.n_total}" for r in foreign_key_report(model).where("n_bad > 0").collect()]
    if bad:
        raise ValueError(f"unresolved foreign keys: {'; '.join(bad)}")


def refresh_gold(
    spark: SparkSession, layers: Layers, params: Mapping[str, object] | None = None, mode: str = "overwrite",
    model: Mapping[str, DataFrame] | None = None, names: Sequence[str] = tuple(kpis.KPIS),
) -> dict[str, int]:
    """Compute and store indicators, all or some. Each plan runs once, inside its write; all are switched in together, or none.

    A ``model`` that is given is asked for the tables of the wanted indicators only, and checks them itself.
    """
    if model is None:
        model = read_model(spark, layers)
        require_tables({name: model[name] for name in kpis.REQUIRED_TABLES})
    written = {}
    with Publication(spark) as publication:
        for name in names:
            kpi, chosen = kpis.KPIS[name], (params or {}).get(name)
            df = kpi(model) if chosen is None else kpi(model, chosen)
            path = layers.path("gold", name)
            written[name] = publication.stage(df, path) if mode == "overwrite" else write_table(df, path, mode)
    return written


def read_gold(spark: SparkSession, layers: Layers, kpi: str, limit: int | None = None) -> DataFrame:
    df = layers.read(spark, "gold", kpi)
    return df if limit is None else df.limit(limit)
