"""Registry: a query over the driver's tables, its SQL, and the inventory rows it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    rows: tuple[str, ...]
    sql: str | None


CATALOG: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of places: sums differ in the last bits by row order."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(rows: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        name = run.__name__
        if name in CATALOG:
            raise ValueError(f"query registered twice: {name}")
        CATALOG[name] = Query(name, lambda spark, d: rounded(run(spark, d)), tuple(rows.split()), sql)
        return run

    return register
