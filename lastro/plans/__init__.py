from lastro.plans.gold import (
    RISK_MULTIPLIER,
    above_mean,
    bank_indicators,
    client_financial_view,
    client_summary,
    mean_threshold,
    risk_monitor,
)
from lastro.plans.increments import States, fold_loads, profile_loads
from lastro.plans.medallion import refresh, refresh_together, save_gold, save_silver
from lastro.plans.silver import cleaning_rules, refine

__all__ = [
    "RISK_MULTIPLIER",
    "States",
    "above_mean",
    "bank_indicators",
    "cleaning_rules",
    "client_financial_view",
    "client_summary",
    "fold_loads",
    "mean_threshold",
    "profile_loads",
    "refine",
    "refresh",
    "refresh_together",
    "risk_monitor",
    "save_gold",
    "save_silver",
]
