"""The queries that SQL can express, against DuckDB, value for value."""

import pytest

from lastro.llm import queries
from tests.oracle import duckdb_rows, spark_rows

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_same_rows_as_duckdb(spark, key):
    names, types, rows = spark_rows(queries.queries()[key](spark, SF))
    their_names, their_types, their_rows = duckdb_rows(SF, queries.oracle_sql()[key])
    assert sorted(names) == sorted(their_names)
    assert rows == their_rows
    assert rows
    same = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}
    assert dict(zip(names, types)) == {
        n: same[t] for n, t in zip(their_names, their_types)}
