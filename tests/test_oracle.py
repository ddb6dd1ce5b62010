"""Every registered query against DuckDB, value for value."""

import pytest

import __spark_entry__ as driver
from tests.oracle import duckdb_rows, spark_rows

SF = "/root/testdata/sf0.01"

SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
    "FLOAT": "float", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean",
}


#: The corpus operators have tests of their own.
OWN = sorted(set(driver.queries())
             - set(driver.corpus.queries() if driver.corpus else ()))


def test_each_query_has_an_oracle():
    assert set(OWN) <= set(driver.oracle_sql())


@pytest.mark.parametrize("key", OWN)
def test_same_rows_as_duckdb(spark, key):
    names, types, rows = spark_rows(driver.queries()[key](spark, SF))
    their_names, their_types, their_rows = duckdb_rows(
        SF, driver.oracle_sql()[key])
    assert sorted(names) == sorted(their_names)
    ours = dict(zip(names, types))
    theirs = dict(zip(their_names, (SAME_TYPE[t] for t in their_types)))
    assert ours == theirs
    assert rows == their_rows
    assert rows


def test_entry(spark):
    assert driver.entry(spark).count() > 0
