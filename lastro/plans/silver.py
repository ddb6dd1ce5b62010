"""Bronze to silver: every cleaning rule in a single projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lastro.functions import (
    fill,
    flag_unless_length,
    money,
    trimmed,
    typed,
    whole_number,
)
from lastro.names import (
    AGE,
    AMOUNT,
    BAD_FORMAT,
    BALANCE,
    CITY,
    CPF,
    CPF_LENGTH,
    DATE,
    CORRUPT_RECORD,
    ID,
    NAME,
    UNKNOWN_NAME,
    own_name,
    quoted,
    same_name,
)
from lastro.operators.profile import quality_metrics


def cleaning_rules(money_type: str = "float", strip_whitespace: bool = False,
                   on_error: str = "null") -> dict[str, Column]:
    """The silver value of each column that is cleaned.

    ``money_type``        "float", or "double" or a decimal type: a decimal
                          keeps cents exact
    ``strip_whitespace``  trim tabs and line ends from cities, not only spaces
    ``on_error``          "null", or "fail" to stop at an unreadable value

    Types are the same whether bronze came from CSV, where all is text, or
    from a typed table: the identifier is text, since one that is no number
    must survive, and the age an ``int``.
    """
    return {
        ID: F.col(ID).cast("string"),
        AGE: whole_number(F.col(AGE), on_error),
        NAME: fill(F.col(NAME), UNKNOWN_NAME),
        CPF: flag_unless_length(F.col(CPF), CPF_LENGTH, BAD_FORMAT),
        CITY: trimmed(F.col(CITY), strip_whitespace),
        AMOUNT: money(F.col(AMOUNT), money_type, on_error),
        BALANCE: typed(F.col(BALANCE), money_type, on_error),
        DATE: typed(F.col(DATE), "date", on_error),
    }


def refine(bronze: DataFrame, money_type: str = "float",
           strip_whitespace: bool = False,
           on_error: str = "null") -> DataFrame:
    """The silver table: other columns, in place and order, pass through.

    Columns are found as the session compares names, and keep the spelling of
    the table. A rule whose column is absent is an error.
    """
    rules = cleaning_rules(money_type, strip_whitespace, on_error)
    return bronze.withColumns({own_name(bronze, c): rule for c, rule in rules.items()})


def parsed_values(
        rules: Mapping[str, Column] | None = None) -> dict[str, tuple[Column, Column]]:
    """Raw and parsed form of each column that gets a new type."""
    rules = rules or cleaning_rules()
    return {c: (F.col(c), rules[c]) for c in (AMOUNT, BALANCE, DATE, AGE)}


def negative_age(bronze: DataFrame | None = None) -> Column:
    """Ages below zero; text that is no number is not below zero.

    A numeric column is compared as it is, so that the filter reaches the
    scan. Text is read as a double: exporters write ``-1.0`` for an integer
    column with NULLs, and ages beyond an int are below zero as well.
    """
    age = F.col(AGE)
    if bronze is not None and isinstance(
            bronze.schema[own_name(bronze, AGE)].dataType, NumericType):
        return age < 0
    return age.try_cast("double") < 0


def corrupt_record(bronze: DataFrame) -> Column:
    """Rows that a delivery's line with too many or too few fields became."""
    if any(same_name(bronze.sparkSession, c, CORRUPT_RECORD) for c in bronze.columns):
        return F.col(CORRUPT_RECORD).isNotNull()
    return F.lit(False)


def validity_rules(bronze: DataFrame | None = None) -> dict[str, Column]:
    """What counts as a violation in the bronze table."""
    rules = {
        "cpf_fora_do_padrao": F.length(F.col(CPF).cast("string")) != CPF_LENGTH,
        "idade_negativa": negative_age(bronze),
    }
    if bronze is not None:
        rules["registros_corrompidos"] = corrupt_record(bronze)
    return rules


def refine_observed(bronze: DataFrame, report: Observation,
                    keep_corrupt: bool = True, **options) -> DataFrame:
    """``refine``, with the quality of the raw rows counted on their way.

    Raw and clean values stand side by side while they are counted, so each
    value is parsed once for both. ``keep_corrupt=False`` leaves out, after
    they were counted, the rows of broken lines.
    """
    rules = cleaning_rules(**options)
    clean = {own_name(bronze, c): f"__clean_{c}" for c in rules}
    both = bronze.withColumns({f"__clean_{c}": rule for c, rule in rules.items()})
    parsed = parsed_values({c: F.col(f"__clean_{c}") for c in rules})
    observed = both.observe(
        report, *quality_metrics(bronze.columns, parsed, validity_rules(bronze)))
    if not keep_corrupt:
        observed = observed.filter(~corrupt_record(bronze))
    return observed.select(*[
        F.col(clean[c]).alias(c) if c in clean else F.col(quoted(c))
        for c in bronze.columns])
