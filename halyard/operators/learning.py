"""Model preparation, boosted-tree models and scoring on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.contract import CATEGORICAL_COLUMNS, GENRES, SEED, numeric_columns
from halyard.operators.order_statistics import quantiles
from halyard.operators.targeting import TOP_DRIVERS, top_drivers
from halyard.sources.workspace import ensure_checkpoint_dir

# --- fixed values: model settings -------------------------------------------
CHURN_SETTINGS = {
    "maxIter": 300,
    "maxDepth": 5,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": SEED,
}
CHURN_POSITIVE_WEIGHT = 6.5
PROPENSITY_SETTINGS = {"maxIter": 250, "maxDepth": 3, "stepSize": 0.05, "seed": SEED}
# --- end of fixed values ----------------------------------------------------

CHECKPOINT_INTERVAL = 10
#: Training rows from which they are dealt evenly over the cores, and the most in one part.
DEAL_FROM, PART_ROWS = 1 << 16, 1 << 18
_ENCODED = "__encoded"


def one_hot_stages(categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> list:
    """Index categories alphabetically and encode every level; an unseen one is all zeros.

    'keep' gives unseen values an extra last index, and ``dropLast`` drops exactly that slot.
    """
    indexed = [f"{c}__index" for c in categorical]
    return [
        StringIndexer(
            inputCols=list(categorical),
            outputCols=indexed,
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=indexed,
            outputCols=[c + _ENCODED for c in categorical],
            dropLast=True,
        ),
    ]


def one_hot(frame: DataFrame, categorical: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """The encoded categories as plain 0/1 columns named ``<column>_<level>``."""
    model = Pipeline(stages=one_hot_stages(categorical)).fit(frame)
    levels = dict(zip(categorical, model.stages[0].labelsArray))
    encoded = model.transform(frame)
    for c in categorical:
        encoded = encoded.withColumn(c + _ENCODED, vector_to_array(c + _ENCODED))
    return encoded.select(
        *frame.columns,
        *[
            F.col(c + _ENCODED)[i].cast("bigint").alias(f"{c}_{level}")
            for c in categorical
            for i, level in enumerate(levels[c])
        ],
    )


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _present(column: str) -> str:
    """SQL for the value as a double; null where it is missing or not a number."""
    return f"nanvl(CAST({_quoted(column)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def missing_flags(columns: Sequence[str]) -> SQLTransformer:
    flags = ", ".join(
        f"CAST({_present(c)} IS NULL AS DOUBLE) AS {_quoted(c + '_missing')}" for c in columns
    )
    return SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__")


class MedianFill(Estimator):
    """Learns exact medians; the fitted stage adds ``<c>_filled`` with nulls replaced by them.

    The fitted stage is a plain SQL transformer, so it is saved with the pipeline. NaN counts
    as missing. A column without any finite median is filled with 0.
    """

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        present = dataset.select(*[F.expr(_present(c)).alias(c) for c in self.columns])
        medians = quantiles(present, self.columns, 0.5).first()

        def literal(c: str) -> str:
            median = medians[c]
            return f"{median if median is not None and math.isfinite(median) else 0.0!r}D"

        filled = ", ".join(
            f"coalesce({_present(c)}, {literal(c)}) AS {_quoted(c + '_filled')}" for c in self.columns
        )
        return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def impute_stages(columns: Sequence[str]) -> list:
    """Flag missing values, then fill them with the training median.

    Spark's tree learners reject NaN, and the assembler rejects nulls.
    """
    return [missing_flags(columns), MedianFill(columns)]


def preparation_stages(genres: Sequence[str] = GENRES) -> list:
    """One-hot categories and filled numeric columns with their flags, in ``features``.

    Every numeric column may be missing: one row without a survey answer must not stop a batch
    or a stream.
    """
    numeric = numeric_columns(genres)
    inputs = [c + _ENCODED for c in CATEGORICAL_COLUMNS] + [f"{c}_filled" for c in numeric]
    return [
        *one_hot_stages(),
        *impute_stages(numeric),
        VectorAssembler(
            inputCols=[*inputs, *[f"{c}_missing" for c in numeric]], outputCol="features"
        ),
    ]


def prepare(frame: DataFrame, genres: Sequence[str] = GENRES) -> DataFrame:
    """``features`` vectors next to the frame's own columns."""
    model = Pipeline(stages=preparation_stages(genres)).fit(frame)
    return model.transform(frame).select(*frame.columns, "features")


def churn_pipeline(genres: Sequence[str] = GENRES, **settings) -> Pipeline:
    """Preparation and a boosted-tree churn classifier; positives weigh 6.5."""
    weight = SQLTransformer(
        statement=f"SELECT *, CASE WHEN label = 1 THEN {CHURN_POSITIVE_WEIGHT}D ELSE 1D END"
        " AS row_weight FROM __THIS__"
    )
    learner = GBTClassifier(
        **{**CHURN_SETTINGS, **settings},
        weightCol="row_weight",
        checkpointInterval=CHECKPOINT_INTERVAL,
    )
    return Pipeline(stages=[*preparation_stages(genres), weight, learner])


def propensity_pipeline(genres: Sequence[str] = GENRES, **settings) -> Pipeline:
    """Preparation and a boosted-tree upsell classifier without weights."""
    learner = GBTClassifier(
        **{**PROPENSITY_SETTINGS, **settings},
        checkpointInterval=CHECKPOINT_INTERVAL,
    )
    return Pipeline(stages=[*preparation_stages(genres), learner])


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows in equal parts, a whole number for each core.

    Every level of every tree is a job with a task per part: one part more than there are cores
    would double the time of each. Few rows stay as they are."""
    if n < DEAL_FROM:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * math.ceil(n / (cores * PART_ROWS)))


def fit(pipeline: Pipeline, frame: DataFrame) -> PipelineModel:
    """Fit on the rows not marked ``is_test`` (on all rows if the frame is not split).

    The learner, which is the last stage, gets its own columns only. Trees are walked from the
    root at each level: they are shallow, and a stored node per row and level (``cacheNodeIds``)
    costs more than the walk and gives the same model.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    train = frame.where(~F.col("is_test")) if "is_test" in frame.columns else frame
    train = train.withColumn("label", F.col("label").cast("double"))
    *preparation, learner = pipeline.getStages()
    prepared = Pipeline(stages=preparation).fit(train)
    inputs = [learner.getFeaturesCol(), learner.getLabelCol()]
    if learner.isDefined("weightCol"):
        inputs.append(learner.getWeightCol())
    rows = _dealt(prepared.transform(train).select(*inputs), train.count())
    return PipelineModel([*prepared.stages, learner.fit(rows)])


def scoring_model(model: PipelineModel) -> PipelineModel:
    """The fitted stages that score needs: without the training weights, which read the label."""
    return PipelineModel(
        [
            s
            for s in model.stages
            if not (isinstance(s, SQLTransformer) and "row_weight" in s.getStatement())
        ]
    )


def batch_score(
    model: PipelineModel, frame: DataFrame, keep: Sequence[str] = ("account_id",)
) -> DataFrame:
    """Probability of label 1 per row, next to the kept columns. Also works on a stream."""
    scored = scoring_model(model).transform(frame)
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def feature_names(model: PipelineModel, frame: DataFrame) -> list[str]:
    """Names of the slots of ``features``, from the schema alone."""
    prepared = PipelineModel(scoring_model(model).stages[:-1]).transform(frame)
    attributes = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    return [
        slots[i].replace(_ENCODED, "").removesuffix("_filled") for i in sorted(slots)
    ]


def feature_importance(
    model: PipelineModel, frame: DataFrame, n: int | None = TOP_DRIVERS
) -> DataFrame:
    """Importance per feature, largest first. Its size is the number of features, not rows."""
    spark: SparkSession = frame.sparkSession
    names = feature_names(model, frame)
    values = model.stages[-1].featureImportances.toArray().tolist()
    importances = spark.createDataFrame(
        list(zip(names, values)), "feature string, importance double"
    )
    return importances if n is None else top_drivers(importances, n)


def assemble(frame: DataFrame, numeric: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as they are next to the one-hot categories, in one vector."""
    stages = [
        *one_hot_stages(),
        VectorAssembler(
            inputCols=[*[c + _ENCODED for c in CATEGORICAL_COLUMNS], *numeric], outputCol=output
        ),
    ]
    return Pipeline(stages=stages).fit(frame).transform(frame).select(*frame.columns, output)


def impute_with_flags(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<c>_missing`` and ``<c>_filled`` for each column."""
    filled = Pipeline(stages=impute_stages(columns)).fit(frame).transform(frame)
    added = [f"{c}_{kind}" for c in columns for kind in ("missing", "filled")]
    return filled.select(*frame.columns, *added)
