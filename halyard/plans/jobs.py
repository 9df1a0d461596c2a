"""The three end-to-end jobs, each one Spark application over the two base tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.contract import GENRES, MIN_PROMOTION_AUC, TOP_PLAN, affinity_columns
from halyard.operators.learning import (
    batch_score,
    churn_pipeline,
    feature_importance,
    fit,
    propensity_pipeline,
    scoring_model,
)
from halyard.operators.metrics import evaluate_churn, evaluate_propensity
from halyard.operators.segments import (
    K_RANGE,
    RESTARTS,
    SILHOUETTE_SAMPLE,
    KMeansSweep,
    assign_segments,
    kmeans_sweep,
    segment_profile,
)
from halyard.operators.splitting import stratified_split
from halyard.operators.training import (
    churn_training_view,
    drop_null_affinity,
    eligible_accounts,
    leakage_guard,
    upsell_training_view,
)
from halyard.operators.viewing import viewing_features
from halyard.plans.promotion import promote
from halyard.plans.steps import Steps
from halyard.sources.models import load_model, save_model
from halyard.sources.tables import write_csv, write_metrics_json


@dataclass(frozen=True)
class JobResult:
    """What a job leaves behind: its model, one row of metrics and where its tables are."""

    model: PipelineModel
    metrics: DataFrame
    output: str
    passed: bool | None = None


def _train_and_score(
    frame: DataFrame,
    pipeline: Pipeline,
    steps: Steps,
    evaluate: Callable[[DataFrame], DataFrame],
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Split, store the training frame once, fit, store scores once, evaluate.

    Boosting reads its input in every round and the metrics read the scores more than once, so
    both are stored: neither the feature joins nor the model run again. Each of these is a step
    that a resumed job finds.
    """
    split = steps.table("training_frame", lambda: stratified_split(frame))
    model = steps.model("fitted", lambda: fit(pipeline, split))
    keep = ("account_id", "label", "is_test")
    scored = steps.table("scores", lambda: batch_score(model, split, keep))
    metrics = steps.table("metrics", lambda: evaluate(scored))
    steps.once(
        "metrics_json", lambda: write_metrics_json(metrics, f"{steps.output}/metrics_json")
    )
    return model, split, metrics


def churn_training_job(
    subscribers: DataFrame,
    activity: DataFrame,
    output: str,
    registry: str,
    version: str,
    run: int,
    *,
    genres: Sequence[str] = GENRES,
    digits: int | None = None,
    missing_month: str = "zero",
    **options,
) -> JobResult:
    """Features, training, quality gate and promotion of the churn model.

    Subscribers never pass the driver. The split reads two of their columns, which Spark takes to
    be as small as their share of the stored files and would broadcast, millions of rows at once.
    """
    viewing = viewing_features(activity, genres, missing_month, digits)
    frame = churn_training_view(subscribers.hint("shuffle_hash"), viewing, genres)
    return train_churn_model(frame, output, registry, version, run, genres=genres, **options)


def train_churn_model(
    frame: DataFrame,
    output: str,
    registry: str,
    version: str,
    run: int,
    *,
    genres: Sequence[str] = GENRES,
    min_auc: float = MIN_PROMOTION_AUC,
    resume: bool = False,
    **settings,
) -> JobResult:
    """Training, quality gate and promotion on a frame of the churn view's columns, such as
    ``scan_view(spark, "features.churn_training_view")``.

    The steps are stored below ``output``. A job that lost its driver is started again with
    ``resume``: what was stored is read, the fit included, and a run that is already in the
    promotion log is not promoted twice.
    """
    identity = {"job": "churn", "version": version, "run": run, "genres": list(genres), **settings}
    steps = Steps(frame.sparkSession, output, identity, resume)
    pipeline = churn_pipeline(genres, **settings)
    model, split, metrics = _train_and_score(
        leakage_guard(frame), pipeline, steps, evaluate_churn
    )
    steps.once(
        "feature_importance",
        lambda: write_csv(feature_importance(model, split), f"{output}/feature_importance"),
    )
    passed = promote(scoring_model(model), metrics, registry, version, run, min_auc)
    return JobResult(model, metrics, output, passed)


def propensity_training_job(
    subscribers: DataFrame,
    activity: DataFrame,
    output: str,
    *,
    genres: Sequence[str] = GENRES,
    digits: int | None = None,
    missing_month: str = "zero",
    **options,
) -> JobResult:
    """Features and training of the upsell model on accounts below the top plan."""
    viewing = viewing_features(activity, genres, missing_month, digits)
    frame = upsell_training_view(subscribers, viewing, genres)
    return train_propensity_model(frame, output, genres=genres, **options)


def train_propensity_model(
    frame: DataFrame,
    output: str,
    *,
    genres: Sequence[str] = GENRES,
    top_plan: str = TOP_PLAN,
    resume: bool = False,
    **settings,
) -> JobResult:
    """Training of the upsell model on a frame of the upsell view's columns, of which accounts on
    the top plan are left out. ``resume`` as for the churn model."""
    identity = {"job": "propensity", "top_plan": top_plan, "genres": list(genres), **settings}
    steps = Steps(frame.sparkSession, output, identity, resume)
    eligible = eligible_accounts(leakage_guard(frame), top_plan)
    pipeline = propensity_pipeline(genres, **settings)
    model, _, metrics = _train_and_score(eligible, pipeline, steps, evaluate_propensity)
    steps.model("model", lambda: scoring_model(model))
    return JobResult(model, metrics, output)


def affinity_job(
    activity: DataFrame,
    output: str,
    *,
    genres: Sequence[str] = GENRES,
    k_range: Sequence[int] = K_RANGE,
    restarts: int = RESTARTS,
    sample_size: int = SILHOUETTE_SAMPLE,
    digits: int | None = None,
    missing_month: str = "zero",
    resume: bool = False,
) -> JobResult:
    """Personas from genre shares: choose k, assign every account, profile the segments. ``resume``
    finds the steps of a job that lost its driver, the search over k among them."""
    viewing = viewing_features(activity, genres, missing_month, digits)
    return segment_accounts(
        viewing, output, genres=genres, k_range=k_range, restarts=restarts,
        sample_size=sample_size, resume=resume,
    )


def segment_accounts(
    viewing: DataFrame,
    output: str,
    *,
    genres: Sequence[str] = GENRES,
    k_range: Sequence[int] = K_RANGE,
    restarts: int = RESTARTS,
    sample_size: int = SILHOUETTE_SAMPLE,
    resume: bool = False,
) -> JobResult:
    """The affinity job on a frame of viewing features, such as the view of that name."""
    columns = affinity_columns(genres)
    identity = {"job": "affinity", "genres": list(genres), "k": list(k_range), "restarts": restarts, "sample_size": sample_size}
    steps = Steps(viewing.sparkSession, output, identity, resume)
    known = drop_null_affinity(viewing, genres).select("account_id", *columns)
    affinity = steps.table("affinity", lambda: known)
    found: list[KMeansSweep] = []

    def search() -> DataFrame:
        found.append(kmeans_sweep(affinity, columns, k_range, restarts, sample_size))
        save_model(found[0].model, f"{output}/model")
        return found[0].candidates.withColumn("selected", F.col("k") == found[0].best_k)

    metrics = steps.table("metrics", search)
    model = found[0].model if found else load_model(f"{output}/model")
    segmented = steps.table("segmented", lambda: assign_segments(model, affinity, columns))
    def report() -> None:
        write_csv(segmented.select("account_id", "segment"), f"{output}/assignments")
        write_csv(segment_profile(segmented, genres), f"{output}/profile")
        write_metrics_json(metrics, f"{output}/metrics_json")

    steps.once("reports", report)
    return JobResult(model, metrics, output)
