"""Every registered query against its SQL in DuckDB, on the two smaller sizes."""

import pytest

from workload.catalog import CATALOG
from workload.check import compare, oracle_connection
import workload.queries  # noqa: F401

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# at the smallest size indicators meet flat series and missing sides
CASES = [(MEDIUM, n) for n, q in CATALOG.items() if q.sql] + [(SMALL, n) for n, q in CATALOG.items() if q.sql and n.startswith("kpi_")]


@pytest.fixture(scope="module")
def connections():
    return {d: oracle_connection(d) for d in (SMALL, MEDIUM)}


@pytest.mark.parametrize(("d", "name"), CASES)
def test_query_matches_its_sql(spark, connections, d, name):
    assert compare(spark, connections[d], d, name) == []


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() >= 0
