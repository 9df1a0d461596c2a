"""Data contract: table schemas, column roles and the values that fix results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

# --- fixed values: they must hold exactly for results to be right -----------
GENRES = ("sport", "movies", "drama_entertainment", "kids", "documentary", "news", "reality")

PLAN_BASE_PRICE = {
    "Basic TV": 15.0,
    "Sky Signature": 26.0,
    "Sky Sports": 46.0,
    "Sky Cinema": 36.0,
    "Ultimate TV": 65.0,
}
TOP_PLAN = "Ultimate TV"

CATEGORICAL_COLUMNS = ("plan", "region", "primary_device", "contract_type")

ACCOUNT_NUMERIC_COLUMNS = (
    "tenure_months",
    "current_monthly_price_gbp",
    "n_price_rises_since_joining",
    "months_since_last_price_rise",
    "num_devices_registered",
    "household_size_est",
    "months_to_contract_end",
    "support_contacts_last_90d",
    "billing_dispute_last_90d",
    "outage_reported_last_90d",
    "nps_last_survey",
    "competitor_ad_exposure_score",
)

GROUND_TRUTH_COLUMNS = ("churn_probability_true", "upsell_probability_true")
CHURN_LABEL = "churned_next_60d"
UPSELL_LABEL = "accepted_upsell_offer"

# Account columns of the churn view, in output order.
CHURN_VIEW_ACCOUNT_COLUMNS = (
    "account_id",
    "tenure_months",
    "plan",
    "current_monthly_price_gbp",
    "n_price_rises_since_joining",
    "months_since_last_price_rise",
    "region",
    "primary_device",
    "num_devices_registered",
    "household_size_est",
    "contract_type",
    "months_to_contract_end",
    "support_contacts_last_90d",
    "billing_dispute_last_90d",
    "outage_reported_last_90d",
    "nps_last_survey",
    "competitor_ad_exposure_score",
)

ACCOUNT_RANGE_LOW, ACCOUNT_RANGE_HIGH, ACCOUNT_RANGE_COUNT = 0, 50_000, 10
MIN_PROMOTION_AUC = 0.65
TOP_DECILE = 0.90
TEST_PERCENT = 20
SEED = 42

SUBSCRIBERS = StructType(
    [
        StructField("account_id", LongType()),
        StructField("tenure_months", LongType()),
        StructField("plan", StringType()),
        StructField("base_monthly_price_gbp", DoubleType()),
        StructField("current_monthly_price_gbp", DoubleType()),
        StructField("n_price_rises_since_joining", LongType()),
        StructField("months_since_last_price_rise", LongType()),
        StructField("region", StringType()),
        StructField("primary_device", StringType()),
        StructField("num_devices_registered", LongType()),
        StructField("household_size_est", LongType()),
        StructField("contract_type", StringType()),
        StructField("months_to_contract_end", LongType()),
        StructField("support_contacts_last_90d", LongType()),
        StructField("billing_dispute_last_90d", LongType()),
        StructField("outage_reported_last_90d", LongType()),
        StructField("nps_last_survey", LongType()),
        StructField("competitor_ad_exposure_score", DoubleType()),
        StructField("churn_probability_true", DoubleType()),
        StructField("churned_next_60d", LongType()),
        StructField("upsell_probability_true", DoubleType()),
        StructField("accepted_upsell_offer", LongType()),
    ]
)


def activity_schema(genres: Sequence[str] = GENRES) -> StructType:
    """Monthly activity: one row per account and month."""
    return StructType(
        [StructField("account_id", LongType()), StructField("months_ago", LongType())]
        + [StructField(f"hrs_{g}", DoubleType()) for g in genres]
        + [StructField("total_viewing_hours", DoubleType())]
    )


# --- end of fixed values ----------------------------------------------------


def affinity_columns(genres: Sequence[str] = GENRES) -> list[str]:
    return [f"affinity_{g}" for g in genres]


def viewing_columns(genres: Sequence[str] = GENRES) -> list[str]:
    return ["avg_total_viewing_hours", "viewing_trend_3mo", *affinity_columns(genres)]


def numeric_columns(genres: Sequence[str] = GENRES) -> list[str]:
    """Numeric model inputs: account columns, then viewing columns."""
    return [*ACCOUNT_NUMERIC_COLUMNS, *viewing_columns(genres)]
