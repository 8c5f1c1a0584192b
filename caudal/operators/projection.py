"""Bring a source to a declared contract, and get results ready to serve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.functions.numeric import finite


@dataclass(frozen=True)
class Field:
    """One target column: where it comes from, its type, and what fills it in.

    ``source`` is a column name or a ready Column expression. An optional field whose
    source column is absent becomes its typed ``default``.
    """

    name: str
    dtype: str
    source: str | Column | None = None
    required: bool = True
    default: object = None
    description: str = ""


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.dtype)) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail on the first column the source lacks; reads the schema only."""
    for name in required:
        if name not in df.columns:
            raise ValueError(f"missing required column: {name}")
    return df


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Select, rename and cast a source to ``contract``.

    Casts are lenient: text that is no number and values that overflow become NULL and
    are left to the quality report, instead of failing the job.
    """
    require_columns(df, [_source(f) for f in contract.fields if f.required and isinstance(_source(f), str)])
    return df.select(*[_field_column(df, f).alias(f.name) for f in contract.fields])


def _source(field: Field) -> str | Column:
    return field.name if field.source is None else field.source


def _field_column(df: DataFrame, field: Field) -> Column:
    source = _source(field)
    if isinstance(source, str) and source not in df.columns:
        # an absent attribute; a present one keeps its NULLs for the quality report
        return F.lit(field.default).cast(field.dtype)
    return (F.col(f"`{source}`") if isinstance(source, str) else source).try_cast(field.dtype)


def empty_like(spark: SparkSession, contract: Contract) -> DataFrame:
    return spark.createDataFrame([], contract.schema)


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient casts for sources: text that is no number and values that do not fit become NULL."""
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in types.items()})


def with_exact_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts for results: a value that does not fit its contract fails the job (ANSI mode) and is never lost."""
    return df.withColumns({name: F.col(name).cast(dtype) for name, dtype in types.items()})


def snake_names(df: DataFrame, extra: Mapping[str, str] | None = None) -> DataFrame:
    names = {c: (extra or {}).get(c, c.strip().lower().replace(" ", "_")) for c in df.columns}
    return df.withColumnsRenamed(names)


def serve(df: DataFrame) -> DataFrame:
    """Decimals as doubles and non-finite numbers as NULL, driven by the schema."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            changed[f.name] = finite(f.name)
    return df.withColumns(changed) if changed else df


def with_date_parts(df: DataFrame, date_col: str, year_col: str = "year", month_col: str | None = "month") -> DataFrame:
    parts = {year_col: F.year(date_col)}
    if month_col:
        parts[month_col] = F.month(date_col)
    return df.withColumns(parts)


def dictionary(spark: SparkSession, contracts: Sequence[Contract]) -> DataFrame:
    """The contracts themselves as rows: the data dictionary."""
    rows = []
    for contract in contracts:
        for position, f in enumerate(contract.fields):
            source = _source(f)
            rows.append((contract.name, position, source if isinstance(source, str) else None, f.name, f.dtype, f.description))
    return spark.createDataFrame(
        rows, "source string, position int, column_original string, column_normalized string, dtype string, description string"
    )
