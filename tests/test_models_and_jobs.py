from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.tables import HOUR_DIGITS, LINE_GENRES, TOP_PLAN, line_activity, planted_subscribers
from halyard.operators import learning, metrics, splitting, training
from halyard.operators.viewing import viewing_features
from halyard.plans import (
    affinity_job,
    churn_training_job,
    current_version,
    log_run,
    promote,
    promotion_log,
    propensity_training_job,
)
from halyard.plans.promotion import load_current_model
from halyard.sources import load_model, materialise, read_report_csv, save_model
from halyard.streaming import score_stream

SF = "/root/testdata/sf0.01"
ROUNDS = {"maxIter": 5}


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    viewing = viewing_features(line_activity(spark, SF), LINE_GENRES, digits=HOUR_DIGITS)
    view = training.churn_training_view(planted_subscribers(spark, SF), viewing, LINE_GENRES)
    return materialise(splitting.stratified_split(view), str(tmp_path_factory.mktemp("m") / "frame"))


@pytest.fixture(scope="module")
def model(frame):
    return learning.fit(learning.churn_pipeline(LINE_GENRES, **ROUNDS), frame)


def test_defaults_are_the_full_settings(spark):
    churn = learning.churn_pipeline().getStages()[-1]
    upsell = learning.propensity_pipeline().getStages()[-1]
    assert (churn.getMaxIter(), churn.getMaxDepth(), churn.getStepSize()) == (300, 5, 0.05)
    assert (churn.getSubsamplingRate(), churn.getFeatureSubsetStrategy()) == (0.8, "0.8")
    assert churn.getWeightCol() == "row_weight"
    assert (upsell.getMaxIter(), upsell.getMaxDepth(), upsell.getStepSize()) == (250, 3, 0.05)


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "plan string")
    fitted = Pipeline(stages=learning.one_hot_stages(["plan"])).fit(train)
    rows = spark.createDataFrame([("b",), ("new",), (None,)], "plan string")
    got = fitted.transform(rows).select(vector_to_array("plan__encoded")).collect()
    assert [r[0] for r in got] == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_imputation_is_fitted_on_training_rows_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,)], "x double")
    fitted = Pipeline(stages=learning.impute_stages(["x"])).fit(train)
    got = fitted.transform(spark.createDataFrame([(None,), (100.0,)], "x double")).collect()
    assert [(r["x_missing"], r["x_filled"]) for r in got] == [(1.0, 3.0), (0.0, 100.0)]


def test_planted_signal_is_found_and_passes_the_gate(frame, model):
    scored = learning.batch_score(model, frame, ("account_id", "label", "is_test"))
    record = metrics.evaluate_churn(scored)
    assert metrics.quality_gate(record).first()["passed"] is True
    assert 0.65 < record.first()["roc_auc"] < 1.0


def test_labels_without_signal_fail_the_gate(frame):
    coin = F.substring(F.md5(F.concat(F.col("account_id").cast("string"), F.lit(":coin"))), 1, 1)
    noise = frame.withColumn("label", F.when(coin < "8", 1).otherwise(0))
    fitted = learning.fit(learning.churn_pipeline(LINE_GENRES, **ROUNDS), noise)
    scored = learning.batch_score(fitted, noise, ("account_id", "label", "is_test"))
    assert metrics.quality_gate(metrics.evaluate_churn(scored)).first()["passed"] is False


def test_importances_are_named_and_sum_to_one(frame, model):
    rows = learning.feature_importance(model, frame, n=None).collect()
    names = {r["feature"] for r in rows}
    assert {"plan_AUTOMOBILE", "tenure_months", "viewing_trend_3mo", "affinity_A"} <= names
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    top = learning.feature_importance(model, frame).collect()
    assert len(top) == 15
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)


def test_saved_model_gives_identical_scores(spark, frame, model, tmp_path):
    loaded = load_model(save_model(learning.scoring_model(model), str(tmp_path / "model")))
    unlabelled = frame.drop("label", "is_test")
    before = {r["account_id"]: r["score"] for r in learning.batch_score(model, frame).collect()}
    after = {r["account_id"]: r["score"] for r in learning.batch_score(loaded, unlabelled).collect()}
    assert before == after


def test_only_passing_models_become_current(spark, frame, model, tmp_path):
    root = str(tmp_path / "registry")
    good = spark.createDataFrame([(0.8,)], "roc_auc double")
    bad = spark.createDataFrame([(0.6,)], "roc_auc double")
    fitted = learning.scoring_model(model)
    with pytest.raises(LookupError):
        log_run(bad, root, "v0", run=0)
        load_current_model(spark, root)
    assert promote(fitted, good, root, "v1", run=1)
    assert not promote(fitted, bad, root, "v2", run=2)
    assert current_version(spark, root).first()["version"] == "v1"
    assert not (tmp_path / "registry" / "models" / "v2").exists()
    assert promotion_log(spark, root).count() == 3
    assert learning.batch_score(load_current_model(spark, root), frame).count() == frame.count()


def test_stream_scores_each_arriving_file_once(spark, frame, model, tmp_path):
    arriving = frame.drop("label", "is_test")
    source, sink, checkpoint = (str(tmp_path / n) for n in ("source", "sink", "checkpoint"))
    half = F.col("account_id") % 2 == 0

    def run():
        query = score_stream(
            spark, model, source, arriving.schema, sink, checkpoint, max_files_per_trigger=1
        )
        query.awaitTermination()

    arriving.where(half).repartition(2).write.parquet(source)
    run()
    run()
    assert spark.read.parquet(sink).count() == arriving.where(half).count()
    arriving.where(~half).write.mode("append").parquet(source)
    run()
    streamed = {r["account_id"]: r["score"] for r in spark.read.parquet(sink).collect()}
    batch = {r["account_id"]: r["score"] for r in learning.batch_score(model, frame).collect()}
    assert streamed == batch


def test_jobs_leave_their_tables(spark, tmp_path):
    subscribers = planted_subscribers(spark, SF)
    activity = line_activity(spark, SF)
    options = {"genres": LINE_GENRES, "digits": HOUR_DIGITS}
    churn = churn_training_job(
        subscribers, activity, str(tmp_path / "churn"), str(tmp_path / "registry"), "v1", 1,
        **options, **ROUNDS,
    )
    record = churn.metrics.first()
    assert churn.passed and record["n_test"] == -(-(record["n_train"] + record["n_test"]) // 5)
    drivers = read_report_csv(spark, str(tmp_path / "churn" / "feature_importance"))
    assert drivers.count() == 15

    upsell = propensity_training_job(
        subscribers, activity, str(tmp_path / "upsell"), top_plan=TOP_PLAN, missing_month="null",
        **options, **ROUNDS,
    )
    trained = spark.read.parquet(str(tmp_path / "upsell" / "training_frame"))
    assert trained.where("plan = 'AUTOMOBILE'").count() == 0
    row = upsell.metrics.first()
    assert row["n_eligible_accounts"] == row["n_train"] + row["n_test"]
    scores = spark.read.parquet(str(tmp_path / "upsell" / "scores"))
    assert scores.count() == row["n_eligible_accounts"]

    affinity = affinity_job(
        activity, str(tmp_path / "affinity"), k_range=range(3, 4), restarts=1, **options
    )
    assert affinity.metrics.where("selected").first()["k"] == 3
    loaded = load_model(str(tmp_path / "affinity" / "model"))
    assert loaded.stages[-1].getK() == 3


def test_training_rows_are_dealt_over_the_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(10_000).repartition(cores + 1)
    assert learning._dealt(rows, 10_000).rdd.getNumPartitions() == cores + 1
    monkeypatch.setattr(learning, "DEAL_FROM", 1_000)
    dealt = learning._dealt(rows, 10_000)
    sizes = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == cores and max(sizes) - min(sizes) <= cores + 1
    assert dealt.agg(F.count_distinct("id")).first()[0] == 10_000
    monkeypatch.setattr(learning, "PART_ROWS", 1_000)
    assert learning._dealt(rows, 10_000).rdd.getNumPartitions() == cores * -(-10 // cores)


def test_trees_are_the_same_without_stored_nodes(frame, model):
    pipeline = learning.churn_pipeline(LINE_GENRES, **ROUNDS)
    learner = pipeline.getStages()[-1]
    assert not learner.getCacheNodeIds()
    assert not learning.propensity_pipeline(LINE_GENRES).getStages()[-1].getCacheNodeIds()
    learner.setCacheNodeIds(True)
    stored = learning.fit(pipeline, frame).stages[-1]
    assert stored.toDebugString.split("\n")[1:] == model.stages[-1].toDebugString.split("\n")[1:]
