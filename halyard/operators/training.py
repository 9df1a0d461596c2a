"""Training views: subscribers joined to viewing features, with the label and without leakage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.contract import (
    CATEGORICAL_COLUMNS,
    CHURN_LABEL,
    CHURN_VIEW_ACCOUNT_COLUMNS,
    GENRES,
    GROUND_TRUTH_COLUMNS,
    PLAN_BASE_PRICE,
    TOP_PLAN,
    UPSELL_LABEL,
    affinity_columns,
    viewing_columns,
)

HIDDEN_COLUMNS = (*GROUND_TRUTH_COLUMNS, CHURN_LABEL, UPSELL_LABEL)


class LeakageError(ValueError):
    """A training frame holds ground truth or another problem's label."""


def drop_columns(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """Every column except the named ones."""
    return frame.drop(*names)


def with_label(frame: DataFrame, source: str) -> DataFrame:
    return frame.withColumnRenamed(source, "label")


def churn_training_view(
    subscribers: DataFrame, viewing: DataFrame, genres: Sequence[str] = GENRES
) -> DataFrame:
    """Account columns, viewing features and the churn label, for accounts that have activity.

    ``viewing`` leaves its aggregation partitioned by account_id, so only the subscriber side
    is shuffled (or broadcast, if Spark finds it small enough).
    """
    view = with_label(subscribers, CHURN_LABEL).join(viewing, "account_id", "inner")
    columns = [*CHURN_VIEW_ACCOUNT_COLUMNS, *viewing_columns(genres), "label"]
    return leakage_guard(view.select(*columns))


def upsell_training_view(
    subscribers: DataFrame, viewing: DataFrame, genres: Sequence[str] = GENRES
) -> DataFrame:
    """All account columns but ground truth and labels, viewing features and the upsell label."""
    kept = [c for c in subscribers.columns if c not in HIDDEN_COLUMNS]
    view = with_label(subscribers, UPSELL_LABEL).join(viewing, "account_id", "inner")
    return leakage_guard(view.select(*kept, *viewing_columns(genres), "label"))


def leakage_guard(frame: DataFrame) -> DataFrame:
    """Check the schema for ground truth and raw labels; reads no data."""
    leaked = [c for c in frame.columns if c in HIDDEN_COLUMNS]
    if leaked:
        raise LeakageError(f"training frame holds {', '.join(leaked)}")
    return frame


def eligible_accounts(frame: DataFrame, top_plan: str = TOP_PLAN) -> DataFrame:
    """Accounts not yet on the top plan; an unknown (null) plan stays eligible."""
    return frame.where(~F.col("plan").eqNullSafe(top_plan))


def drop_null_affinity(viewing: DataFrame, genres: Sequence[str] = GENRES) -> DataFrame:
    """Accounts for which every genre share is known."""
    return viewing.dropna(subset=affinity_columns(genres))


def columns_except(
    frame: DataFrame, excluded: Iterable[str] = (*CATEGORICAL_COLUMNS, "account_id", "label")
) -> list[str]:
    """Names of all columns outside a set, in frame order."""
    hidden = set(excluded)
    return [c for c in frame.columns if c not in hidden]


def columns_with_prefix(frame: DataFrame, prefix: str = "affinity_") -> list[str]:
    return [c for c in frame.columns if c.startswith(prefix)]


def with_base_price(
    frame: DataFrame,
    prices: Mapping[str, float] = PLAN_BASE_PRICE,
    output: str = "base_monthly_price_gbp",
) -> DataFrame:
    """Look a plan's base price up; an unknown plan gives null.

    The price list is a handful of literals, so it becomes a map in the projection: no join.
    """
    pairs = [F.lit(v) for item in prices.items() for v in item]
    return frame.withColumn(output, F.try_element_at(F.create_map(*pairs), F.col("plan")))
