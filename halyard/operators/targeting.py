"""Lists to act on: offers within a budget, retention targets with a persona, top drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.contract import TOP_DECILE
from halyard.operators.metrics import at_or_above
from halyard.operators.order_statistics import quantile, running_totals

TOP_DRIVERS = 15


def offer_list(
    scored: DataFrame,
    budget: int | float | Column,
    cost: str | None = None,
    key: str = "account_id",
    score: str = "score",
) -> DataFrame:
    """Best-scored accounts whose costs, added up in order, stay within the budget.

    Without ``cost`` the budget is a number of accounts. Equal scores are taken by key. Costs
    are not negative. Ranges of scores past the budget are dropped before rows are shuffled.
    """
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    amount = F.lit(1).cast("bigint") if cost is None else F.col(cost)
    costed = scored.where(F.col(score).isNotNull()).select(
        key, score, F.lit(1).cast("bigint").alias("place"), amount.alias("cost")
    )
    listed = running_totals(
        costed, score, ["place", "cost"], tie_break=key, up_to=("cost", limit)
    )
    return listed.select(
        key,
        score,
        "cost",
        F.col("place_running").alias("offer_rank"),
        F.col("cost_running").alias("running_cost"),
    )


def retention_targets(
    scored: DataFrame,
    segments: DataFrame,
    profile: DataFrame,
    q: float = TOP_DECILE,
    key: str = "account_id",
) -> DataFrame:
    """High-risk accounts with the dominant genre of their segment and the offer that fits it.

    ``profile`` has one row per segment; Spark broadcasts it if its measured size allows.
    """
    threshold = quantile(scored, "score", q).scalar()
    personas = profile.select("segment", "dominant_genre")
    return (
        at_or_above(scored.select(key, "score"), threshold)
        .join(segments.select(key, "segment"), key, "inner")
        .join(personas, "segment", "inner")
        .select(
            key,
            "score",
            "segment",
            "dominant_genre",
            F.concat(F.col("dominant_genre"), F.lit("_save_offer")).alias("offer"),
        )
    )


def top_drivers(importances: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """The ``n`` features with the largest importance."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def best_candidate(candidates: DataFrame, score: str = "silhouette", k: str = "k") -> DataFrame:
    """The candidate with the best score; the smallest k wins a tie."""
    return candidates.orderBy(F.desc_nulls_last(score), F.asc(k)).limit(1)
