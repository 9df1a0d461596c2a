"""Uneven partitions, missing values and repeated promotions."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from checks.tables import LINE_GENRES, line_activity, planted_subscribers
from halyard.contract import GENRES, numeric_columns
from halyard.operators import learning, order_statistics, splitting, training
from halyard.operators.metrics import roc_auc, score_ladder
from halyard.operators.viewing import viewing_features
from halyard.plans import promotion
from tests.conftest import SMALL


def test_ranges_stay_balanced_when_one_partition_holds_nearly_all(spark):
    large = spark.range(0, 40_000, 1, 1).select(F.rand(3).alias("score"), "id")
    small = spark.range(40_000, 40_200, 1, 100).select(F.rand(4).alias("score"), "id")
    frame = large.union(small).cache()
    found = order_statistics._find_ranges(frame, "score", None, 16).assign(frame)
    sizes = [r["count"] for r in found.groupBy("__range").count().collect()]
    assert max(sizes) < 3 * frame.count() / 16


def test_a_heavy_score_with_recent_keys_is_split_evenly(spark):
    rows = spark.range(6_000).select(
        "id", F.when(F.col("id") >= 4_000, 0.5).otherwise(F.rand(1)).alias("score")
    )
    found = order_statistics._find_ranges(rows, "score", "id", 16).assign(rows)
    sizes = [r["count"] for r in found.groupBy("__range", "__part").count().collect()]
    assert max(sizes) < 3 * 6_000 / 16


def test_infinite_scores_are_ranked(spark):
    rng = random.Random(2)
    scores = [math.inf] * 40 + [-math.inf] * 40 + [rng.random() for _ in range(40)]
    rows = [(s, int(s > 0.5)) for s in scores]
    frame = spark.createDataFrame(rows, "score double, label bigint").repartition(4)
    assert roc_auc(score_ladder(frame, ranges=8)).first()["roc_auc"] == pytest.approx(1.0)
    assert order_statistics.quantile(frame, "score", 1.0, ranges=8).first()["quantile"] == math.inf


def test_several_quantiles_scan_the_input_twice(spark, tmp_path):
    path = str(tmp_path / "wide")
    columns = [f"c{i}" for i in range(8)]
    spark.range(500).select(
        *[F.when(F.rand(i) > 0.1, F.rand(i + 50)).alias(c) for i, c in enumerate(columns)]
    ).write.parquet(path)
    frame = spark.read.parquet(path)
    found = order_statistics.quantiles(frame, columns, 0.5, ranges=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 2
    expected = frame.select(*[F.median(c).alias(c) for c in columns]).first()
    assert found.first().asDict() == pytest.approx(expected.asDict())


def _frame(spark):
    viewing = viewing_features(line_activity(spark, SMALL), LINE_GENRES, digits=2)
    view = training.churn_training_view(planted_subscribers(spark, SMALL), viewing, LINE_GENRES)
    return splitting.stratified_split(view)


def test_a_missing_value_in_any_input_does_not_stop_scoring(spark):
    frame = _frame(spark).cache()
    model = learning.fit(learning.churn_pipeline(LINE_GENRES, maxIter=2, maxDepth=2), frame)
    kinds = dict(frame.dtypes)
    for column in numeric_columns(LINE_GENRES):
        holes = [None, math.nan] if kinds[column] == "double" else [None]
        for hole in holes:
            broken = frame.limit(5).withColumn(column, F.lit(hole).cast(kinds[column]))
            scores = [r["score"] for r in learning.batch_score(model, broken).collect()]
            assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)


def test_missing_values_and_odd_genre_names_do_not_stop_training(spark):
    frame = _frame(spark)
    names = dict(zip(LINE_GENRES, ["sci-fi", "war & peace", *GENRES]))
    genres = [names[g] for g in LINE_GENRES]
    for old, new in names.items():
        frame = frame.withColumnRenamed(f"affinity_{old}", f"affinity_{new}")
    for i, column in enumerate(numeric_columns(genres)):
        hole = F.lit(None).cast(dict(frame.dtypes)[column])
        frame = frame.withColumn(column, F.when(F.col("account_id") % 23 == i, hole).otherwise(F.col(f"`{column}`")))
    model = learning.fit(learning.churn_pipeline(genres, maxIter=2, maxDepth=2), frame)
    assert learning.batch_score(model, frame).where("score IS NULL").count() == 0


def _named(version: str) -> PipelineModel:
    return PipelineModel([SQLTransformer(statement=f"SELECT *, '{version}' AS model FROM __THIS__")])


def _current(spark, root: str) -> str:
    return promotion.load_current_model(spark, root).transform(spark.range(1)).first()["model"]


def test_promotion_can_be_repeated_and_interrupted(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "registry")
    good = spark.createDataFrame([(0.9,)], "roc_auc double")
    poor = spark.createDataFrame([(0.6,)], "roc_auc double")
    assert promotion.promote(_named("a"), good, root, "v", 1)
    assert promotion.promote(_named("b"), good, root, "v", 1)
    assert _current(spark, root) == "a"
    assert promotion.promotion_log(spark, root).count() == 1
    assert not promotion.promote(_named("c"), poor, root, "v", 2)

    def dies(*_args):
        raise RuntimeError("lost before the log row")

    with monkeypatch.context() as patched:
        patched.setattr(promotion, "log_run", dies)
        with pytest.raises(RuntimeError):
            promotion.promote(_named("d"), good, root, "v", 3)
    assert _current(spark, root) == "a"
    assert promotion.promote(_named("e"), good, root, "v", 3)
    assert _current(spark, root) == "e"
