"""Rule-based churn and upsell scorecards: a logit over account drivers, as one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.contract import TOP_PLAN
from halyard.functions.scalar import clip, flag, round_half_away, sigmoid

# --- fixed values: scorecard coefficients and limits ------------------------
CHURN_WEIGHTS = {
    "intercept": -2.6,
    "engagement_z": -0.55,
    "recent_price_rise": 0.9,
    "out_of_contract": 0.5,
    "support_contacts": 0.35,
    "billing_dispute": 0.9,
    "outage": 0.5,
    "nps": -0.09,
    "competitor_exposure": 0.7,
    "log_tenure": -0.15,
    "price": 0.010,
}
UPSELL_WEIGHTS = {
    "intercept": -1.8,
    "engagement_z": 0.75,
    "top_plan": -1.2,
    "devices": 0.35,
    "nps": 0.05,
}
RECENT_PRICE_RISE_MONTHS = 2
SUPPORT_CONTACT_LIMIT = 4
SCORE_DIGITS = 4
# --- end of fixed values ----------------------------------------------------


def recent_price_rise() -> Column:
    return flag(F.col("months_since_last_price_rise") <= RECENT_PRICE_RISE_MONTHS)


def out_of_contract() -> Column:
    return flag(F.col("months_to_contract_end") <= 0)


def on_top_plan(top_plan: str = TOP_PLAN) -> Column:
    return flag(F.col("plan") == top_plan)


def risk_flags(subscribers: DataFrame, top_plan: str = TOP_PLAN) -> DataFrame:
    """The three 0/1 risk flags per account."""
    return subscribers.select(
        "account_id",
        recent_price_rise().alias("recent_price_rise"),
        out_of_contract().alias("out_of_contract"),
        on_top_plan(top_plan).alias("on_top_plan"),
    )


def _weighted(weights: Mapping[str, float], drivers: Mapping[str, Column]) -> Column:
    logit = F.lit(weights["intercept"])
    for name, driver in drivers.items():
        logit = logit + weights[name] * driver
    return logit


def churn_scorecard(engagement_z: Column, weights: Mapping[str, float] = CHURN_WEIGHTS) -> Column:
    """Churn probability from account columns and a standardised engagement column."""
    drivers = {
        "engagement_z": engagement_z,
        "recent_price_rise": recent_price_rise(),
        "out_of_contract": out_of_contract(),
        "support_contacts": clip(F.col("support_contacts_last_90d"), 0, SUPPORT_CONTACT_LIMIT),
        "billing_dispute": F.col("billing_dispute_last_90d"),
        "outage": F.col("outage_reported_last_90d"),
        "nps": F.col("nps_last_survey"),
        "competitor_exposure": F.col("competitor_ad_exposure_score"),
        "log_tenure": F.log1p(F.col("tenure_months")),
        "price": F.col("current_monthly_price_gbp"),
    }
    return round_half_away(sigmoid(_weighted(weights, drivers)), SCORE_DIGITS)


def upsell_scorecard(
    engagement_z: Column,
    top_plan: str = TOP_PLAN,
    weights: Mapping[str, float] = UPSELL_WEIGHTS,
) -> Column:
    """Upsell probability; contract status has no weight in this scorecard."""
    drivers = {
        "engagement_z": engagement_z,
        "top_plan": on_top_plan(top_plan),
        "devices": F.col("num_devices_registered"),
        "nps": F.col("nps_last_survey"),
    }
    return round_half_away(sigmoid(_weighted(weights, drivers)), SCORE_DIGITS)
