"""Whether values are what they should be."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows that break a rule. A diagnosis: nothing is fixed or dropped."""
    return df.filter(predicate)


def rules_broken(df: DataFrame, rules: Mapping[str, Column],
                 result: str = "regras_quebradas") -> DataFrame:
    """The rows that break any rule, each with the names of those it breaks.

    All rules are judged in one pass; a predicate that is NULL is not broken.
    Names come in the order of ``rules``. A column named like ``result`` is
    replaced, after the rules were judged.
    """
    if not rules:
        raise ValueError("there are no rules")
    names = F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in rules.items()]))
    return df.withColumn(result, names).filter(F.size(result) > 0)


def count_by_rule(broken: DataFrame, result: str = "regras_quebradas") -> DataFrame:
    """(regra, linhas) for each rule that a row of ``rules_broken`` breaks.

    Rows are added up in their tasks; a row a rule is shuffled for each task.
    """
    return (broken.select(F.explode(result).alias("regra"))
            .groupBy("regra").agg(F.count("*").alias("linhas")))


def rejected(raw: Column, parsed: Column) -> Column:
    """Rows where a value was present but could not be parsed."""
    return F.count_if(raw.isNotNull() & parsed.isNull())


def cast_rejects(df: DataFrame,
                 parsed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row: per label, how many raw values its parsed form loses."""
    return df.agg(*[rejected(r, p).alias(c) for c, (r, p) in parsed.items()])
