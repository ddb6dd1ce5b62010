"""Runs a registered query in Spark and in DuckDB and compares the rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[str], Counter]:
    with duckdb.connect() as con:
        for table in TABLES:
            con.execute(f"CREATE VIEW {table} AS "
                        f"SELECT * FROM '{sf_dir}/{table}.parquet'")
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        types = [str(d[1]) for d in result.description]
        return names, types, bag(names, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    return (df.columns, [t for _, t in df.dtypes],
            bag(df.columns, [tuple(r) for r in df.collect()]))


def bag(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value
