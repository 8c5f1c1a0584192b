"""Sources: Parquet roots and globs, delimited text, landed JSON payloads."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caudal.functions.text import key_from_path
from caudal.sources.publish import Files

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None, suffix: str = "") -> DataFrame:
    """A Parquet table by its name under a layer root.

    A given schema replaces the one in the files: other columns are not read.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{base.rstrip('/')}/{name}{suffix}")


def read_roots(
    spark: SparkSession,
    roots: Sequence[str],
    columns: Sequence[str] | None = None,
    key_pattern: str | None = None,
    key_col: str = "key",
    on_missing: str = "error",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Every Parquet file below several roots, with a key taken from the file path.

    One scan over all roots. ``columns`` is a plain select, which the scan prunes to.
    ``on_missing='skip'`` leaves out roots that do not exist, with a warning; by
    default they are an error.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing must be 'error' or 'skip'")
    found = list(roots) if on_missing == "error" else [root for root in roots if exists(spark, root)]
    if not found:
        raise ValueError("none of the roots could be read")
    reader = spark.read.option("recursiveFileLookup", True)
    df = (reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)).parquet(*found)
    wanted = [F.col(c) for c in (columns or df.columns)]
    if key_pattern:
        wanted.append(key_from_path("_metadata.file_path", key_pattern).alias(key_col))
    return df.select(*wanted)


def exists(spark: SparkSession, root: str) -> bool:
    """Whether a root can be listed; no file is opened."""
    try:
        spark.read.format("binaryFile").load(root)
    except AnalysisException as problem:
        log.warning("skipping root %s: %s", root, problem.getCondition())
        return False
    return True


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path and size_bytes of the files below a root, from the listing alone: no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select("path", F.col("length").alias("size_bytes"))


def read_glob(spark: SparkSession, pattern: str, merge_schema: bool = True) -> DataFrame:
    """Parquet files matched by a glob; partition folders in the pattern do not become columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(pattern)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, recursive: bool = True) -> DataFrame:
    """Delimited text with a header, under a declared schema (nothing is inferred).

    Columns are found by their names in the header, in any order; a missing one is an
    error, and so is a file whose header is not that of the others. Cells that do not fit
    become NULL, for the quality report.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("header", True).option("recursiveFileLookup", recursive)
    names = reader.csv(path).columns
    missing = [f.name for f in wanted.fields if f.name not in names]
    if missing:
        raise ValueError(f"missing in the header: {', '.join(missing)}")
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = reader.option("enforceSchema", False).schema(texts).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON payloads, one whole file per row in ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def is_malformed(json_col: str) -> Column:
    """Whether a payload is cut off or no JSON at all."""
    return F.col(json_col).isNotNull() & F.try_parse_json(F.col(json_col)).isNull()


def _well_formed(df: DataFrame, json_col: str, on_malformed: str) -> DataFrame:
    if on_malformed == "skip":
        return df.where(~is_malformed(json_col))
    if on_malformed != "error":
        raise ValueError("on_malformed must be 'error' or 'skip'")
    told = F.concat(F.lit("malformed payload: "), F.substring(json_col, 1, 80))
    return df.withColumn(json_col, F.when(is_malformed(json_col), F.raise_error(told).cast("string")).otherwise(F.col(json_col)))


def flatten_pages(df: DataFrame, json_col: str, row_schema: T.StructType | str, fields: Mapping[str, str], keep: Sequence[str] = (), on_malformed: str = "error") -> DataFrame:
    """API pages ``[meta, [row, …]]`` to one row per record.

    ``fields`` maps output names to (possibly nested) paths inside a record. A page
    without a second element gives no rows. A malformed page stops the job;
    ``on_malformed='skip'`` leaves it out, to be counted with ``is_malformed``.
    """
    schema = row_schema if isinstance(row_schema, str) else row_schema.simpleString()
    df = _well_formed(df, json_col, on_malformed)
    records = F.from_json(F.get_json_object(F.col(json_col), "$[1]"), f"array<{schema}>")
    rows = df.select(*keep, F.explode(records).alias("_r"))
    return rows.select(*keep, *[F.col(f"_r.{path}").alias(name) for name, path in fields.items()])


def flatten_arrays(df: DataFrame, json_col: str, root: str, arrays: Mapping[str, str], names: Mapping[str, str] | None = None, keep: Sequence[str] = (),
                   on_malformed: str = "error") -> DataFrame:
    """Parallel arrays under ``root`` to one row per position.

    ``arrays`` maps a JSON array to its element type, ``names`` renames it. Unknown
    elements stay as NULLs. Malformed payloads as in ``flatten_pages``.
    """
    df = _well_formed(df, json_col, on_malformed)
    inner = ", ".join(f"`{name}`: array<{dtype}>" for name, dtype in arrays.items())
    parsed = df.select(*keep, F.from_json(F.col(json_col), f"struct<`{root}`: struct<{inner}>>").alias("_p"))
    zipped = F.arrays_zip(*[F.col(f"_p.{root}.{name}") for name in arrays])
    rows = parsed.select(*keep, F.explode(zipped).alias("_r"))
    return rows.select(*keep, *[F.col("_r").getField(name).alias((names or {}).get(name, name)) for name in arrays])


def slice_period(df: DataFrame, year: int | None = None, month: int | None = None, year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Optional bound to one year or month; prunes partitions where these are the layout keys."""
    if year is not None:
        df = df.where(F.col(year_col) == year)
    if month is not None:
        df = df.where(F.col(month_col) == month)
    return df


SCHEMA_FILE = "_schema.json"


def stored_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """The schema that was stored with a folder of files; opening the folder by it opens none of them."""
    path, files = f"{root.rstrip('/')}/{SCHEMA_FILE}", Files(spark, root)
    return T.StructType.fromJson(json.loads(files.read_text(path))) if files.exists(path) else None


def store_schema(spark: SparkSession, root: str, schema: T.StructType) -> T.StructType:
    """Merge a schema into the one stored with a folder. A column of another type than before is an error."""
    old = stored_schema(spark, root) or T.StructType()
    known = {f.name: f.dataType for f in old.fields}
    changed = [f"{f.name} {known[f.name].simpleString()}, now {f.dataType.simpleString()}" for f in schema.fields if known.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"types that do not fit what has landed before: {'; '.join(changed)}")
    merged = T.StructType([*old.fields, *[T.StructField(f.name, f.dataType) for f in schema.fields if f.name not in known]])
    Files(spark, root).write_text(f"{root.rstrip('/')}/{SCHEMA_FILE}", merged.json())
    return merged
