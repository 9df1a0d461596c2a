"""The named feature views over the two base tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from halyard.contract import GENRES
from halyard.operators.rollups import segment_genre_affinity
from halyard.operators.training import churn_training_view, upsell_training_view
from halyard.operators.viewing import viewing_features
from halyard.sources.tables import register_views


def feature_views(
    subscribers: DataFrame,
    activity: DataFrame,
    genres: Sequence[str] = GENRES,
    digits: int | None = None,
    missing_month: str = "zero",
) -> dict[str, DataFrame]:
    """All four views, lazy. Pass a stored viewing table through :func:`views_over` instead if
    several of them are read in one run."""
    viewing = viewing_features(activity, genres, missing_month, digits)
    return views_over(subscribers, viewing, genres)


def views_over(
    subscribers: DataFrame, viewing: DataFrame, genres: Sequence[str] = GENRES
) -> dict[str, DataFrame]:
    return {
        "viewing_features": viewing,
        "churn_training_view": churn_training_view(subscribers, viewing, genres),
        "upsell_training_view": upsell_training_view(subscribers, viewing, genres),
        "segment_genre_affinity": segment_genre_affinity(subscribers, viewing, genres),
    }


def register_feature_views(
    subscribers: DataFrame,
    activity: DataFrame,
    genres: Sequence[str] = GENRES,
    digits: int | None = None,
    missing_month: str = "zero",
) -> list[str]:
    """Create or replace the views, so that they can be queried with SQL by name."""
    return register_views(feature_views(subscribers, activity, genres, digits, missing_month))
