"""Grouped summaries and the tables behind the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.contract import CHURN_LABEL, GENRES, UPSELL_LABEL, affinity_columns
from halyard.functions.scalar import round_half_away, safe_divide
from halyard.operators.order_statistics import quantile

SHARE_DIGITS = 3


def _count() -> Column:
    return F.count(F.lit(1))


def base_rate(frame: DataFrame, label: str = "label") -> DataFrame:
    """Mean of a 0/1 label."""
    return frame.agg(F.avg(label).alias("base_rate"))


def rate_by_plan(frame: DataFrame, label: str = CHURN_LABEL) -> DataFrame:
    """Label mean per plan, lowest first."""
    return (
        frame.groupBy("plan").agg(F.avg(label).alias("rate")).orderBy(F.asc("rate"), F.asc("plan"))
    )


def plan_mix(frame: DataFrame) -> DataFrame:
    """Accounts per known plan, largest first."""
    return (
        frame.dropna(subset=["plan"])
        .groupBy("plan")
        .agg(_count().alias("n_accounts"))
        .orderBy(F.desc("n_accounts"), F.asc("plan"))
    )


def median(frame: DataFrame, column: str) -> DataFrame:
    """Exact median, found without gathering the column's values in one task."""
    return quantile(frame, column, 0.5, output=f"median_{column}")


def segment_genre_affinity(
    subscribers: DataFrame, viewing: DataFrame, genres: Sequence[str] = GENRES
) -> DataFrame:
    """Average genre shares and account count by plan and region.

    An account whose shares are null counts as an account but not in the averages.
    """
    joined = subscribers.select("account_id", "plan", "region").join(viewing, "account_id", "inner")
    return joined.groupBy("plan", "region").agg(
        *[
            round_half_away(F.avg(c), SHARE_DIGITS).alias(f"avg_{c}")
            for c in affinity_columns(genres)
        ],
        _count().alias("n_accounts"),
    )


def affinity_index(
    segmented: DataFrame, segment: str = "segment", genres: Sequence[str] = GENRES
) -> DataFrame:
    """Segment mean share over base mean share: above 1 a genre is over-represented.

    The base mean is the segments' sums over their counts, so the accounts are read once. The
    window that adds them up sees one row per segment.
    """
    columns = affinity_columns(genres)
    sums = [F.sum(c).alias(f"sum_{c}") for c in columns]
    counts = [F.count(c).alias(f"n_{c}") for c in columns]
    all_segments = Window.partitionBy()

    def index(c: str) -> Column:
        own = safe_divide(F.col(f"sum_{c}"), F.col(f"n_{c}"))
        base = safe_divide(
            F.sum(f"sum_{c}").over(all_segments), F.sum(f"n_{c}").over(all_segments)
        )
        return safe_divide(own, base).alias(f"index_{c}")

    return segmented.groupBy(segment).agg(*sums, *counts).select(segment, *map(index, columns))


def frame_counts(frame: DataFrame) -> DataFrame:
    """Rows and columns of a frame."""
    return frame.agg(_count().alias("n_rows")).withColumn(
        "n_columns", F.lit(len(frame.columns)).cast("bigint")
    )


def affinity_long(
    profile: DataFrame, segment: str = "segment", genres: Sequence[str] = GENRES
) -> DataFrame:
    """Segment profile in long form: one row per segment and genre."""
    columns = affinity_columns(genres)
    return profile.unpivot([segment], columns, "genre", "share").withColumn(
        "genre", F.regexp_replace("genre", "^affinity_", "")
    )


def base_rates_report(subscribers: DataFrame) -> DataFrame:
    """Churn rate, upsell rate and median tenure in one row."""
    tenure = median(subscribers, "tenure_months")
    return subscribers.agg(
        F.avg(CHURN_LABEL).alias("churn_rate"), F.avg(UPSELL_LABEL).alias("upsell_rate")
    ).select("churn_rate", "upsell_rate", tenure.scalar().alias("median_tenure_months"))
