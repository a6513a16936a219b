"""Every registered query of the library against its DuckDB SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from check_oracle import compare

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tidewright.catalog.oracle import ORACLE
from tidewright.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry.queries().keys() and ORACLE.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok: ")


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
