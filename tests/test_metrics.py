from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halyard.operators import metrics
from halyard.operators.splitting import hash_sample, stratified_split


def scored(spark, rows):
    return spark.createDataFrame(
        [(i, float(s), int(y)) for i, (s, y) in enumerate(rows)],
        "account_id bigint, score double, label bigint",
    )


def brute_auc(rows):
    up = [s for s, y in rows if y]
    down = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in up for n in down)
    return wins / (len(up) * len(down))


def brute_ap(rows):
    positives = sum(y for _, y in rows)
    value, recall = 0.0, 0.0
    for threshold in sorted({s for s, _ in rows}, reverse=True):
        taken = [y for s, y in rows if s >= threshold]
        value += (sum(taken) / positives - recall) * sum(taken) / len(taken)
        recall = sum(taken) / positives
    return value


def sample_rows(seed, n=300, levels=None):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = rng.randrange(levels) / levels if levels else rng.random()
        rows.append((s, int(rng.random() < 0.2 + 0.5 * s)))
    return rows


@pytest.mark.parametrize("levels", [None, 3, 40])
def test_ranking_metrics_equal_brute_force(spark, levels):
    rows = sample_rows(3, levels=levels)
    got = metrics.ranking_summary(metrics.score_ladder(scored(spark, rows), ranges=7)).first()
    threshold = float(np.quantile([s for s, _ in rows], 0.9))
    flagged = [y for s, y in rows if s >= threshold]
    assert got["roc_auc"] == pytest.approx(brute_auc(rows))
    assert got["average_precision"] == pytest.approx(brute_ap(rows))
    assert got["threshold"] == pytest.approx(threshold)
    assert (got["flagged"], got["flagged_positives"]) == (len(flagged), sum(flagged))
    assert got["n"] == len(rows) and got["positives"] == sum(y for _, y in rows)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_auc_of_reversed_scores_is_the_complement(spark, seed):
    rows = sample_rows(seed, n=60, levels=9) + [(0.5, 0), (0.5, 1)]
    forward = metrics.roc_auc(metrics.score_ladder(scored(spark, rows))).first()[0]
    backward = metrics.roc_auc(
        metrics.score_ladder(scored(spark, [(-s, y) for s, y in rows]))
    ).first()[0]
    assert forward + backward == pytest.approx(1.0)


def test_all_scores_equal(spark):
    rows = [(0.3, int(i % 4 == 0)) for i in range(40)]
    got = metrics.ranking_summary(metrics.score_ladder(scored(spark, rows))).first()
    assert got["roc_auc"] == 0.5
    assert got["average_precision"] == 0.25
    assert (got["flagged"], got["flagged_positives"]) == (40, 10)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_auc_and_fails_the_gate(spark, label):
    measured = metrics.roc_auc(
        metrics.score_ladder(scored(spark, [(0.1, label), (0.7, label)]))
    )
    row = metrics.quality_gate(measured).first()
    assert row["roc_auc"] is None and row["passed"] is False


def test_gate_with_a_missing_metric_fails(spark):
    assert metrics.quality_gate(spark.range(1)).first()["passed"] is False


def test_gate_passes_at_the_minimum(spark):
    frame = spark.createDataFrame([(0.65,)], "roc_auc double")
    assert metrics.quality_gate(frame).first()["passed"] is True


def test_unscored_rows_are_not_ranked(spark):
    frame = scored(spark, [(0.9, 1), (0.2, 0)]).union(
        spark.createDataFrame([(7, None, 1), (8, 0.4, None)], "account_id bigint, score double, label bigint")
    )
    assert metrics.ranking_summary(metrics.score_ladder(frame)).first()["n"] == 2


def test_empty_frame_has_no_metrics(spark):
    row = metrics.ranking_summary(metrics.score_ladder(scored(spark, []))).first()
    assert (row["n"], row["roc_auc"], row["threshold"]) == (0, None, None)


def test_precision_recall_curve_ends_at_full_recall(spark):
    rows = sample_rows(11, levels=8)
    curve = metrics.precision_recall_curve(metrics.score_ladder(scored(spark, rows)))
    last = curve.orderBy("threshold").first()
    assert last["recall"] == 1.0
    assert last["precision"] == pytest.approx(sum(y for _, y in rows) / len(rows))


def test_classification_report_without_predictions_gives_zero(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "label bigint, prediction bigint")
    report = {r["class"]: r for r in metrics.classification_report(frame).collect()}
    assert report["1"]["precision"] == 0.0 and report["1"]["support"] == 2
    assert report["0"]["recall"] == 1.0
    assert report["accuracy"]["f1_score"] == pytest.approx(1 / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(1 / 3)


def test_capture_rate_is_a_whole_number_of_positives(spark):
    rows = sample_rows(5)
    summary = metrics.ranking_summary(metrics.score_ladder(scored(spark, rows)))
    capture = metrics.capture_and_lift(summary).first()
    caught = capture["capture_rate"] * sum(y for _, y in rows)
    assert caught == pytest.approx(round(caught))


# --- splits and samples -----------------------------------------------------


@pytest.mark.parametrize(("n", "positives"), [(10, 3), (101, 13), (250, 1), (5, 5)])
def test_split_sizes_and_strata(spark, n, positives):
    frame = scored(spark, [(0.0, int(i < positives)) for i in range(n)])
    rows = stratified_split(frame).collect()
    test = [r for r in rows if r["is_test"]]
    assert len(rows) == n
    assert len(test) == -(-n // 5)
    assert abs(sum(r["label"] for r in test) - positives / 5) <= 1


def test_split_does_not_depend_on_partitioning(spark):
    frame = scored(spark, sample_rows(2, n=400))
    first = {r["account_id"]: r["is_test"] for r in stratified_split(frame.repartition(1)).collect()}
    again = {r["account_id"]: r["is_test"] for r in stratified_split(frame.repartition(9)).collect()}
    other = {r["account_id"]: r["is_test"] for r in stratified_split(frame, seed=7).collect()}
    assert first == again
    assert first != other


def test_sample_size_and_repeatability(spark):
    frame = spark.range(1000).withColumnRenamed("id", "account_id")
    ids = {r[0] for r in hash_sample(frame, 37).collect()}
    assert len(ids) == 37
    assert ids == {r[0] for r in hash_sample(frame.repartition(5), 37).collect()}
    assert hash_sample(frame, 5000).count() == 1000
    assert hash_sample(frame, 0).count() == 0


def test_evaluation_record(spark):
    rows = sample_rows(8, n=500)
    frame = scored(spark, rows).withColumn("is_test", F.col("account_id") % 5 == 0)
    record = metrics.evaluate_churn(frame).first().asDict()
    test = [r for i, r in enumerate(rows) if i % 5 == 0]
    assert record["roc_auc"] == pytest.approx(brute_auc(test), abs=5e-5)
    assert (record["n_train"], record["n_test"]) == (400, 100)
    assert record["base_churn_rate"] == pytest.approx(sum(y for _, y in rows) / 500, abs=5e-5)
    assert metrics.evaluate_propensity(frame).first()["n_eligible_accounts"] == 500
