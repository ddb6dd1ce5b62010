from lastro.operators.cleaning import (
    cast_cols,
    fill_null,
    flag_length,
    parse_money,
    trim_col,
)
from lastro.operators.completeness import null_counts, null_percent
from lastro.operators.profile import quality_metrics, quality_profile
from lastro.operators.uniqueness import duplicates, repeated_keys
from lastro.operators.validity import (
    cast_rejects,
    count_by_rule,
    rules_broken,
    violations,
)

__all__ = [
    "cast_cols",
    "cast_rejects",
    "count_by_rule",
    "duplicates",
    "fill_null",
    "flag_length",
    "null_counts",
    "null_percent",
    "parse_money",
    "quality_metrics",
    "quality_profile",
    "repeated_keys",
    "rules_broken",
    "trim_col",
    "violations",
]
