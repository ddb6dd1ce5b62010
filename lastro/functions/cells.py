"""Cleaning rules as column expressions.

Each takes a Column and returns a Column of built-in functions only, so any
number of them fuse into one projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastro.names import CURRENCY, CURRENCY_PREFIX

# Space, tab, line feed, vertical tab, form feed, carriage return.
TRIMMED_WHITESPACE = " \t\n\x0b\f\r"


def fill(value: Column, sentinel: str) -> Column:
    """``sentinel`` where the value is NULL; empty strings are values."""
    return F.coalesce(value.cast("string"), F.lit(sentinel))


def flag_unless_length(value: Column, length: int, marker: str) -> Column:
    """``marker`` where the text is not ``length`` characters; NULL stays NULL.

    The value is made text first: with a numeric column the marker would
    otherwise have to become a number.
    """
    text = value.cast("string")
    return F.when(F.length(text) != length, F.lit(marker)).otherwise(text)


def trimmed(value: Column, whitespace: bool = False) -> Column:
    """The text without outer spaces, or without any outer whitespace."""
    if whitespace:
        return F.trim(value, F.lit(TRIMMED_WHITESPACE))
    return F.trim(value)


def typed(value: Column, to: str, on_error: str = "null",
          shown: Column | None = None) -> Column:
    """The value as type ``to``; what cannot be read becomes NULL or an error.

    ``on_error="fail"`` raises in every session, with ANSI mode on or off, and
    names the value, or ``shown`` where that is what the user would know.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")
    parsed = value.try_cast(to)
    if on_error == "null":
        return parsed
    shown = value if shown is None else shown
    message = F.concat(F.lit(f"cannot read as {to}: "), shown.cast("string"))
    unreadable = value.isNotNull() & parsed.isNull()
    return F.when(unreadable, F.raise_error(message).cast(to)).otherwise(parsed)


def whole_number(value: Column, on_error: str = "null") -> Column:
    """The value as an int; ``30.0``, as exporters write it, is 30.

    A fraction, and what lies beyond an int, is unreadable.
    """
    number = value.try_cast("double")
    whole = F.when(number == F.floor(number), number)
    if on_error == "fail":
        return F.coalesce(whole.try_cast("int"), typed(value, "int", on_error))
    return whole.try_cast("int")


def without_currency(value: Column) -> Column:
    """The text without any currency prefix and the blanks that follow it."""
    return F.regexp_replace(value.cast("string"), CURRENCY_PREFIX, "")


def money(value: Column, to: str = "float", on_error: str = "null") -> Column:
    """An amount such as ``R$ 123.45`` as a number.

    Nearly every amount has one prefix, at its start. Cutting that off costs
    half of what the pattern does, which is left for the others; the blanks
    that remain in front are ignored by the cast.
    """
    text = value.cast("string")
    one_prefix = text.startswith(CURRENCY) & (
        F.locate(CURRENCY, text, len(CURRENCY) + 1) == 0)
    number = F.when(one_prefix, F.substr(text, F.lit(len(CURRENCY) + 1)))
    return typed(number.otherwise(without_currency(text)), to, on_error, text)
