"""Run queries next to their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from workload.queries import CATALOG

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def oracle_connection(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(_plain(v) for v in row) for row in zip(*columns)), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, d: str, name: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    q = CATALOG[name]
    return compare_tables(q.run(spark, d).toArrow(), con.execute(q.sql).to_arrow_table())


def compare_tables(ours: pa.Table, theirs: pa.Table) -> list[str]:
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return [f"columns {names} != {sorted(theirs.column_names)}"]
    kinds = [(n, _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)) for n in names]
    problems = [f"type of {n}: {a} != {b}" for n, a, b in kinds if a != b]
    a, b = _rows(ours, names), _rows(theirs, names)
    if len(a) != len(b):
        problems.append(f"{len(a)} rows != {len(b)}")
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {names}: {differing[0][0]} != {differing[0][1]}")
    return problems


def main(d: str, chosen: list[str]) -> int:
    from caudal.session import local_session

    spark = local_session("check", "8")
    con = oracle_connection(d)
    failed = 0
    for name in chosen or list(CATALOG):
        start = time.time()
        try:
            if CATALOG[name].sql is None:
                problems = [] if CATALOG[name].run(spark, d).toArrow().num_rows >= 0 else ["no result"]
            else:
                problems = compare(spark, con, d, name)
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n       ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
