from halyard.functions.scalar import (
    clip,
    exact_avg,
    exact_sum,
    first_largest,
    flag,
    null_if_zero,
    round_half_away,
    safe_divide,
    sigmoid,
    strip_prefix,
)
from halyard.functions.scorecard import churn_scorecard, risk_flags, upsell_scorecard

__all__ = [
    "churn_scorecard",
    "clip",
    "exact_avg",
    "exact_sum",
    "first_largest",
    "flag",
    "null_if_zero",
    "risk_flags",
    "round_half_away",
    "safe_divide",
    "sigmoid",
    "strip_prefix",
    "upsell_scorecard",
]
