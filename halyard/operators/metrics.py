"""Exact ranking metrics on score and 0/1 label columns.

Everything is read off one *ladder*: a row per distinct score with the positives and rows at
and above it. Ties therefore always move together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.contract import MIN_PROMOTION_AUC, TOP_DECILE
from halyard.functions.scalar import flag, round_half_away, safe_divide
from halyard.operators.order_statistics import interpolate, quantile, running_totals

METRIC_DIGITS = 4


def score_ladder(
    scored: DataFrame, score: str = "score", label: str = "label", ranges: int | None = None
) -> DataFrame:
    """One row per distinct score, highest first in its running totals.

    Columns: score, positives, n, and for both the total at or above the score and over the
    whole frame. Rows without a score or label are not ranked.
    """
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias("score"),
        F.col(label).cast("bigint").alias("positives"),
        F.lit(1).cast("bigint").alias("n"),
    )
    levels = rows.groupBy("score").agg(F.sum("positives").alias("positives"), F.sum("n").alias("n"))
    return running_totals(levels, "score", ["positives", "n"], rows=rows, ranges=ranges)


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs ranked rightly; a tie counts half."""
    negatives = _double("n") - _double("positives")
    negatives_below = (
        (_double("n_total") - _double("positives_total"))
        - (_double("n_running") - _double("positives_running"))
    )
    pairs = F.max(_double("positives_total")) * F.max(
        _double("n_total") - _double("positives_total")
    )
    return safe_divide(F.sum(_double("positives") * (negatives_below + negatives / 2)), pairs)


def _average_precision() -> Column:
    """Precision at each score weighted by the recall gained there (a step sum, no trapezoid)."""
    return F.sum(
        safe_divide(_double("positives"), _double("positives_total"))
        * safe_divide(_double("positives_running"), _double("n_running"))
    )


def roc_auc(ladder: DataFrame) -> DataFrame:
    """Area under the ROC curve; null when only one class is present."""
    return ladder.agg(_roc_auc().alias("roc_auc"))


def average_precision(ladder: DataFrame) -> DataFrame:
    return ladder.agg(_average_precision().alias("average_precision"))


def precision_recall_curve(ladder: DataFrame) -> DataFrame:
    """Precision and recall when everything at or above a score is flagged."""
    return ladder.select(
        F.col("score").alias("threshold"),
        safe_divide(_double("positives_running"), _double("n_running")).alias("precision"),
        safe_divide(_double("positives_running"), _double("positives_total")).alias("recall"),
    )


def ranking_summary(ladder: DataFrame, q: float = TOP_DECILE) -> DataFrame:
    """All ranking metrics in one row and one pass over the ladder.

    The flagged group is every row with a score at or above the interpolated quantile ``q``.
    On the ladder that is a running total: the one at the upper of the two scores around the
    quantile, or at the lower one if the quantile falls on it.
    """
    position = (F.col("n_total") - 1) * F.lit(q)
    after = F.col("n_total") - F.col("n_running")
    through = after + F.col("n")

    def at_rank(rank: Column, value: str) -> Column:
        return F.max(F.when((after <= rank) & (rank < through), F.col(value)))

    low_rank, high_rank = F.floor(position), F.ceil(position)
    points = ladder.agg(
        F.coalesce(F.max("n_total"), F.lit(0)).alias("n"),
        F.coalesce(F.max("positives_total"), F.lit(0)).alias("positives"),
        _roc_auc().alias("roc_auc"),
        _average_precision().alias("average_precision"),
        F.max(position - low_rank).alias("fraction"),
        *[
            at_rank(rank, value).alias(f"{side}_{value}")
            for side, rank in (("low", low_rank), ("high", high_rank))
            for value in ("score", "n_running", "positives_running")
        ],
    ).withColumn(
        "threshold", interpolate(F.col("low_score"), F.col("high_score"), F.col("fraction"))
    )
    on_low = F.col("threshold") <= F.col("low_score")
    return points.select(
        "n",
        "positives",
        safe_divide(_double("positives"), _double("n")).alias("base_rate"),
        "roc_auc",
        "average_precision",
        "threshold",
        F.when(on_low, F.col("low_n_running")).otherwise(F.col("high_n_running")).alias("flagged"),
        F.when(on_low, F.col("low_positives_running"))
        .otherwise(F.col("high_positives_running"))
        .alias("flagged_positives"),
    )


def capture_and_lift(summary: DataFrame) -> DataFrame:
    """Precision, capture rate and lift of the flagged group."""
    precision = safe_divide(_double("flagged_positives"), _double("flagged"))
    return summary.select(
        "flagged",
        "flagged_positives",
        precision.alias("precision"),
        safe_divide(_double("flagged_positives"), _double("positives")).alias("capture_rate"),
        safe_divide(precision, F.col("base_rate")).alias("lift"),
    )


def at_or_above(scored: DataFrame, threshold: Column, score: str = "score") -> DataFrame:
    """Rows whose score reaches the threshold."""
    return scored.where(F.col(score) >= threshold)


def with_top_flag(
    scored: DataFrame, q: float = TOP_DECILE, score: str = "score", output: str = "prediction"
) -> DataFrame:
    """Flag scores at or above quantile ``q``; ties at the threshold are all flagged."""
    threshold = quantile(scored, score, q).scalar()
    return scored.withColumn(output, flag(F.col(score) >= threshold))


def classification_report(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    One aggregation of conditional counts, then five rows by ``stack``. A zero divisor gives 0.
    """
    y, p = F.col(label), F.col(prediction)

    def count_if(condition: Column) -> Column:
        return F.count_if(condition).cast("double")

    counts = predicted.where(y.isNotNull() & p.isNotNull()).agg(
        count_if((y == 1) & (p == 1)).alias("tp"),
        count_if((y == 0) & (p == 1)).alias("fp"),
        count_if((y == 1) & (p == 0)).alias("fn"),
        count_if((y == 0) & (p == 0)).alias("tn"),
    )

    def ratio(numerator: Column, divisor: Column) -> Column:
        return F.coalesce(safe_divide(numerator, divisor), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = counts.select(
        ratio(tn, tn + fn).alias("p0"),
        ratio(tn, tn + fp).alias("r0"),
        ratio(2 * tn, 2 * tn + fn + fp).alias("f0"),
        (tn + fp).alias("s0"),
        ratio(tp, tp + fp).alias("p1"),
        ratio(tp, tp + fn).alias("r1"),
        ratio(2 * tp, 2 * tp + fn + fp).alias("f1"),
        (tp + fn).alias("s1"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )
    both = F.col("s0") + F.col("s1")

    def macro(name: str) -> Column:
        return (F.col(f"{name}0") + F.col(f"{name}1")) / 2

    def weighted(name: str) -> Column:
        return ratio(
            F.col(f"{name}0") * F.col("s0") + F.col(f"{name}1") * F.col("s1"), both
        )

    nothing = F.lit(None).cast("double")
    rows = [
        ("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        ("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        ("accuracy", nothing, nothing, F.col("accuracy"), both),
        ("macro avg", macro("p"), macro("r"), macro("f"), both),
        ("weighted avg", weighted("p"), weighted("r"), weighted("f"), both),
    ]
    cells = [cell for name, *values in rows for cell in (F.lit(name), *values)]
    return rates.select(
        F.stack(F.lit(len(rows)), *cells).alias("class", "precision", "recall", "f1_score", "n")
    ).select(
        "class", "precision", "recall", "f1_score", F.col("n").cast("bigint").alias("support")
    )


def _rounded(column: Column | str, name: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return round_half_away(column, METRIC_DIGITS).alias(name)


def _frame_stats(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.avg("label").alias("base_rate"),
        F.count_if(~F.col("is_test")).alias("n_train"),
        F.count_if(F.col("is_test")).alias("n_test"),
        F.count(F.lit(1)).alias("n_all"),
    )


def evaluate_churn(frame: DataFrame, score: str = "score") -> DataFrame:
    """The churn metric record of a frame with label, score and ``is_test``.

    Ranking metrics come from the test part, the base rate from the whole frame.
    """
    summary = ranking_summary(score_ladder(frame.where("is_test"), score))
    stats = _frame_stats(frame)
    flagged = _double("flagged_positives")
    return summary.select(
        _rounded("roc_auc", "roc_auc"),
        _rounded("average_precision", "average_precision"),
        _rounded(stats.select("base_rate").scalar(), "base_churn_rate"),
        _rounded("threshold", "top_decile_threshold"),
        _rounded(safe_divide(flagged, _double("flagged")), "top_decile_precision"),
        _rounded(safe_divide(flagged, _double("positives")), "top_decile_churn_capture_rate"),
        stats.select("n_train").scalar().alias("n_train"),
        stats.select("n_test").scalar().alias("n_test"),
    )


def evaluate_propensity(frame: DataFrame, score: str = "score") -> DataFrame:
    """The upsell metric record of an eligible-accounts frame with label, score and ``is_test``."""
    summary = ranking_summary(score_ladder(frame.where("is_test"), score))
    stats = _frame_stats(frame)
    return summary.select(
        _rounded("roc_auc", "roc_auc"),
        _rounded("average_precision", "average_precision"),
        _rounded(stats.select("base_rate").scalar(), "base_acceptance_rate"),
        stats.select("n_train").scalar().alias("n_train"),
        stats.select("n_test").scalar().alias("n_test"),
        stats.select("n_all").scalar().alias("n_eligible_accounts"),
    )


def quality_gate(metrics: DataFrame, min_auc: float = MIN_PROMOTION_AUC) -> DataFrame:
    """Add ``passed``: the ROC-AUC reaches the minimum; a missing one counts as 0."""
    auc = F.col("roc_auc") if "roc_auc" in metrics.columns else F.lit(0.0)
    return metrics.withColumn("passed", F.coalesce(auc, F.lit(0.0)) >= F.lit(min_auc))
