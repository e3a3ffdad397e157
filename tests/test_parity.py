"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from pharmavane.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES = contract.queries()
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def content(arrow):
    columns = sorted(arrow.column_names)
    rows = zip(*[[repr(v) for v in arrow.column(c).to_pylist()] for c in columns])
    return columns, [str(arrow.schema.field(c).type) for c in columns], sorted(rows)


def test_every_query_has_a_check():
    assert set(registry.QUERIES) <= set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows(spark, duck, name):
    ours = content(QUERIES[name](spark, SF).toArrow())
    theirs = content(duck.sql(CHECKS[name]).to_arrow_table())
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).count() == 10
