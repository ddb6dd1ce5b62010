"""The whole quality report of a raw table from a single pass over it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.operators.completeness import nulls
from lastro.operators.validity import rejected


def quality_metrics(
        cols: Iterable[str],
        parsed: Mapping[str, tuple[Column, Column]] | None = None,
        rules: Mapping[str, Column] | None = None) -> list[Column]:
    """Aggregates for completeness and validity, one value each.

    ``total_linhas``        rows
    ``nulos_<column>``      NULLs per column
    ``rejeitados_<column>`` values present but unreadable, per entry of ``parsed``
    ``<rule>``              rows for which each predicate of ``rules`` holds

    They fit both ``df.agg``, which reads the table for them, and
    ``df.observe``, which takes them along while the table is being written.
    """
    return [
        F.count("*").alias("total_linhas"),
        *[nulls(c).alias(f"nulos_{c}") for c in cols],
        *[rejected(raw, value).alias(f"rejeitados_{c}")
          for c, (raw, value) in (parsed or {}).items()],
        *[F.count_if(p).alias(label) for label, p in (rules or {}).items()],
    ]


def quality_profile(
        df: DataFrame,
        parsed: Mapping[str, tuple[Column, Column]] | None = None,
        rules: Mapping[str, Column] | None = None) -> DataFrame:
    """The metrics above as one row."""
    return df.agg(*quality_metrics(df.columns, parsed, rules))
