"""Model promotion: a passing model gets a folder of its own, every run gets a log row."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from halyard.contract import MIN_PROMOTION_AUC
from halyard.operators.metrics import quality_gate
from halyard.sources.models import load_model, save_model

LOG_SCHEMA = "run bigint, version string, roc_auc double, passed boolean, path string"


def _log_path(root: str) -> str:
    return f"{root}/log"


def log_run(
    metrics: DataFrame,
    root: str,
    version: str,
    run: int,
    min_auc: float = MIN_PROMOTION_AUC,
    path: str | None = None,
) -> None:
    """Append (run, version, roc_auc, passed, path of the model) for a one-row metric frame."""
    auc = F.col("roc_auc") if "roc_auc" in metrics.columns else F.lit(None)
    gated = quality_gate(metrics, min_auc)
    gated.select(
        F.lit(run).cast("bigint").alias("run"),
        F.lit(version).alias("version"),
        auc.cast("double").alias("roc_auc"),
        F.col("passed"),
        F.lit(path).cast("string").alias("path"),
    ).write.mode("append").parquet(_log_path(root))


def promotion_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(_log_path(root))


def _logged(spark: SparkSession, root: str, version: str, run: int) -> Row | None:
    """The log row of a run, if it has one."""
    try:
        log = promotion_log(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.where((F.col("run") == run) & (F.col("version") == version)).first()


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The latest passing run, of several versions in it the last by name; no row if none has
    passed."""
    passed = promotion_log(spark, root).where("passed")
    return passed.orderBy(F.desc("run"), F.desc("version"), F.desc("path")).limit(1)


def load_current_model(spark: SparkSession, root: str) -> PipelineModel:
    row = current_version(spark, root).first()
    if row is None:
        raise LookupError(f"no promoted model under {root}")
    return load_model(row["path"])


def promote(
    model: PipelineModel,
    metrics: DataFrame,
    root: str,
    version: str,
    run: int,
    min_auc: float = MIN_PROMOTION_AUC,
) -> bool:
    """Save the model if its metrics pass, then log the run.

    Every attempt saves to a folder of its own, and only the log row, which comes last, makes
    it current: a job that dies in between leaves the current model as it is. A run that is
    already logged is not promoted again; what was decided then is returned.
    """
    done = _logged(metrics.sparkSession, root, version, run)
    if done is not None:
        return done["passed"]
    passed = bool(quality_gate(metrics, min_auc).first()["passed"])
    path = f"{root}/models/{version}/run-{run}-{uuid.uuid4().hex}" if passed else None
    if path is not None:
        save_model(model, path)
    log_run(metrics, root, version, run, min_auc, path)
    return passed
