from lastro.functions.cells import (
    TRIMMED_WHITESPACE,
    fill,
    flag_unless_length,
    money,
    trimmed,
    typed,
    whole_number,
    without_currency,
)

__all__ = [
    "TRIMMED_WHITESPACE",
    "fill",
    "flag_unless_length",
    "money",
    "trimmed",
    "typed",
    "whole_number",
    "without_currency",
]
