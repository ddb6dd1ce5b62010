"""How much is missing: one global aggregate, one pass, no driver round trip."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.names import NULL_PERCENT, quoted


def nulls(col: str) -> Column:
    """Rows where the column is NULL; NULL, not 0, when there are no rows.

    Made of plain counts, which a source that keeps them in its file
    statistics can answer without reading the column.
    """
    rows = F.count("*")
    return F.when(rows > 0, rows - F.count(F.col(quoted(col))))


def null_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row: for each column, under its own name, how many NULLs it has."""
    return df.agg(*[nulls(c).alias(c) for c in (cols or df.columns)])


def null_percent(df: DataFrame, cols: str | Iterable[str] | None = None,
                 scale: int = 0) -> DataFrame:
    """One row: NULLs as a percentage of the rows, rounded to ``scale``.

    One column given as a string is reported as "Percentual nulos"; several
    are each reported under their own name.
    """
    if isinstance(cols, str):
        named = {NULL_PERCENT: cols}
    else:
        named = {c: c for c in (cols or df.columns)}
    return df.agg(*[
        F.round(nulls(c) / F.count("*") * 100, scale).alias(label)
        for label, c in named.items()
    ])
