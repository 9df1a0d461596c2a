"""Scoring new account rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from halyard.operators.learning import batch_score
from halyard.plans.promotion import LOG_SCHEMA, current_version
from halyard.sources.models import load_model


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    schema: StructType,
    sink: str,
    checkpoint: str,
    keep: Sequence[str] = ("account_id",),
    max_files_per_trigger: int = 1_000,
) -> StreamingQuery:
    """Score all parquet files that have arrived in ``source`` since the last run.

    Scoring keeps no state. The checkpoint records which files are done and the file sink which
    output is committed, so a restart neither loses nor repeats rows. ``availableNow`` stops
    after what is there; a scheduler or a longer-lived trigger starts it again.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
    )
    return (
        batch_score(model, rows, keep)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _model_of_batch(spark: SparkSession, registry: str, sink: str, batch_id: int) -> Row:
    """The log row of the model that scores a batch: the current one at the first attempt, which is
    noted beside the scores before any is written, and that same one at every later attempt."""
    note = f"{sink}/_models/{batch_id}"
    try:
        noted = spark.read.schema(LOG_SCHEMA).parquet(note).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        noted = None
    if noted is not None:
        return noted
    current = current_version(spark, registry).first()
    if current is None:
        raise LookupError(f"no promoted model under {registry}")
    spark.createDataFrame([current], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(note)
    return current


def promoted_scorer(
    registry: str, sink: str, keep: Sequence[str] = ("account_id",)
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that scores a batch with the model that is promoted then.

    Scores go to the batch's own directory of ``sink`` (column ``batch``), with ``run`` and ``version`` of
    the model. A repeated batch replaces what it wrote, and with the same model, so its rows
    are the same whatever has been promoted since. Without a promoted model the batch fails
    and is taken up again at the next start.
    """
    models: dict[str, PipelineModel] = {}

    def score(rows: DataFrame, batch_id: int) -> None:
        chosen = _model_of_batch(rows.sparkSession, registry, sink, batch_id)
        if chosen["path"] not in models:
            models.clear()
            models[chosen["path"]] = load_model(chosen["path"])
        scored = batch_score(models[chosen["path"]], rows, keep).select(
            "*",
            F.lit(chosen["run"]).cast("bigint").alias("run"),
            F.lit(chosen["version"]).alias("version"),
            F.lit(batch_id).cast("bigint").alias("batch"),
        )
        scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch"
        ).parquet(sink)

    return score


def score_stream_promoted(
    spark: SparkSession,
    registry: str,
    source: str,
    schema: StructType,
    sink: str,
    checkpoint: str,
    keep: Sequence[str] = ("account_id",),
    max_files_per_trigger: int = 1_000,
    every: str | None = None,
) -> StreamingQuery:
    """Score arriving parquet files, each micro-batch with the model that is current when it starts.

    A promotion takes effect with the next batch, without a restart. ``every`` ('30 seconds')
    keeps the stream running; without it the stream ends after what is there.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source)
        .writeStream.foreachBatch(promoted_scorer(registry, sink, keep))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
