"""Cleaning rules on a DataFrame: one column replaced, the rest untouched."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastro.functions import fill, flag_unless_length, money, trimmed, typed
from lastro.names import quoted


def fill_null(df: DataFrame, col: str, sentinel: str) -> DataFrame:
    return df.withColumn(col, fill(F.col(quoted(col)), sentinel))


def flag_length(df: DataFrame, col: str, length: int, marker: str) -> DataFrame:
    return df.withColumn(
        col, flag_unless_length(F.col(quoted(col)), length, marker))


def trim_col(df: DataFrame, col: str, whitespace: bool = False) -> DataFrame:
    return df.withColumn(col, trimmed(F.col(quoted(col)), whitespace))


def parse_money(df: DataFrame, col: str, to: str = "float",
                on_error: str = "null") -> DataFrame:
    return df.withColumn(col, money(F.col(quoted(col)), to, on_error))


def cast_cols(df: DataFrame, types: Mapping[str, str],
              on_error: str = "null") -> DataFrame:
    """Several columns given new types in one projection."""
    return df.withColumns(
        {c: typed(F.col(quoted(c)), to, on_error) for c, to in types.items()})
