"""Viewing features: monthly totals, averages, three-month trend and genre shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.contract import GENRES, affinity_columns
from halyard.functions.scalar import exact_avg, exact_sum, safe_divide

TREND_MONTHS = (0, 2)


def _month_total(month: int, missing_month: str, digits: int | None) -> Column:
    hours = F.when(F.col("months_ago") == month, F.col("total_viewing_hours"))
    if missing_month == "zero":
        hours = hours.otherwise(F.lit(0.0))
    elif missing_month != "null":
        raise ValueError("missing_month is 'zero' or 'null'")
    return F.sum(hours) if digits is None else exact_sum(hours, digits)


def month_totals(
    activity: DataFrame,
    months: Sequence[int] = (0, 1, 2),
    missing_month: str = "zero",
    digits: int | None = None,
) -> DataFrame:
    """Total hours per account with one column per month.

    ``missing_month='zero'`` gives 0 for an absent month, ``'null'`` gives null. Both are one
    aggregation with conditional sums, hence one shuffle; ``groupBy().pivot()`` would aggregate on
    (account, month) first and shuffle twice. Duplicate months are summed.
    """
    names = {0: "hrs_month_current"}
    return activity.groupBy("account_id").agg(
        *[
            _month_total(m, missing_month, digits).alias(names.get(m, f"hrs_month_minus{m}"))
            for m in months
        ]
    )


def _average_columns(genres: Sequence[str], digits: int | None) -> list[Column]:
    return [exact_avg(F.col(f"hrs_{g}"), digits).alias(f"avg_hrs_{g}") for g in genres] + [
        exact_avg(F.col("total_viewing_hours"), digits).alias("avg_total_viewing_hours")
    ]


def viewing_averages(
    activity: DataFrame, genres: Sequence[str] = GENRES, digits: int | None = None
) -> DataFrame:
    """Mean hours per account for each genre and in total; nulls are skipped."""
    return activity.groupBy("account_id").agg(*_average_columns(genres, digits))


def trend(current: Column, oldest: Column) -> Column:
    """Relative change from the oldest month to the current one."""
    return safe_divide(current - oldest, oldest)


def genre_shares(averages: DataFrame, genres: Sequence[str] = GENRES) -> DataFrame:
    """Each genre's share of average viewing time; null when nothing was watched."""
    return averages.select("account_id", *_share_columns(genres))


def _share_columns(genres: Sequence[str]) -> list[Column]:
    total = F.col("avg_total_viewing_hours")
    return [
        safe_divide(F.col(f"avg_hrs_{g}"), total).alias(name)
        for g, name in zip(genres, affinity_columns(genres))
    ]


def viewing_features(
    activity: DataFrame,
    genres: Sequence[str] = GENRES,
    missing_month: str = "zero",
    digits: int | None = None,
) -> DataFrame:
    """One row per account: average hours, three-month trend and genre shares.

    Month totals and averages group by the same key, so they share a single aggregation and
    a single shuffle. A hot account is folded by the map-side partial aggregate.
    ``digits`` names the number of decimals the hours are stored with, for sums that do
    not depend on row order; leave it out for free-form doubles.
    """
    current, oldest = TREND_MONTHS
    per_account = activity.groupBy("account_id").agg(
        _month_total(current, missing_month, digits).alias("hrs_current"),
        _month_total(oldest, missing_month, digits).alias("hrs_oldest"),
        *_average_columns(genres, digits),
    )
    return per_account.select(
        "account_id",
        "avg_total_viewing_hours",
        trend(F.col("hrs_current"), F.col("hrs_oldest")).alias("viewing_trend_3mo"),
        *_share_columns(genres),
    )


def union_months(*extracts: DataFrame) -> DataFrame:
    """Append monthly extracts by column name; duplicates are kept."""
    combined = extracts[0]
    for extract in extracts[1:]:
        combined = combined.unionByName(extract)
    return combined


def key_violations(
    activity: DataFrame, keys: Sequence[str] = ("account_id", "months_ago")
) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        activity.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )
