"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.session import new_table_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but ASCII white space, as bytes.split() cuts them.
SPACES = r"[\x20\x09-\x0D]+"
#: Texts are worked on in pieces of about so many code points.
PIECE = 1_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, and is computed once."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use) -> Column:
    """use(value), with value computed once for each row, also where use has it in a lambda."""
    return F.transform(F.array(value), use)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def mapped(df: DataFrame, work, schema: str) -> DataFrame:
    """mapInArrow over dictionaries: work(iterator of record batches) yields dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for f, c in ((f, columns[f.name]) for f in target)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, target)], schema=target)

    return df.mapInArrow(run, schema)


def chunks(texts: list[str], size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about `size` code points in all; a longer text is alone in its range."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")
