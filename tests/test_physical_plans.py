"""What the optimiser makes of the main queries: shuffles, pruning, pushdown, no cross joins."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from checks.tables import EVENT_GENRES, event_activity, line_activity, subscribers
from halyard.contract import CHURN_LABEL, SUBSCRIBERS, activity_schema
from halyard.operators import training
from halyard.operators.splitting import stratified_split
from halyard.operators.viewing import month_totals, viewing_features
from halyard.plans import churn_training_job, jobs
from tests.conftest import SMALL

PLANNED = [
    "viewing_features_lines",
    "churn_training_view",
    "upsell_training_view",
    "segment_genre_affinity_lines",
    "churn_scorecard",
    "stratified_split",
    "roc_auc",
    "precision_recall_curve",
    "offer_list_ties",
    "retention_targets",
    "quantile_threshold",
    "capture_rate_lift",
    "affinity_index",
    "zscore",
]


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(spark_entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture
def stored_activity(spark, tmp_path):
    path = str(tmp_path / "activity")
    event_activity(spark, SMALL).write.parquet(path)
    return spark.read.schema(activity_schema(EVENT_GENRES)).parquet(path)


def test_features_need_one_shuffle(stored_activity):
    assert exchanges(physical(viewing_features(stored_activity, EVENT_GENRES))) == 1
    assert exchanges(physical(month_totals(stored_activity, missing_month="null"))) == 1


def test_only_the_asked_columns_are_read(stored_activity):
    frame = viewing_features(stored_activity, EVENT_GENRES).select("account_id", "affinity_click")
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", physical(frame))
    assert read == "account_id:bigint,hrs_click:double,total_viewing_hours:double"


def test_the_join_reuses_the_partitioning_of_the_aggregate(spark, stored_activity, tmp_path):
    path = str(tmp_path / "subscribers")
    subscribers(spark, SMALL).write.parquet(path)
    accounts = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        view = training.churn_training_view(
            accounts, viewing_features(stored_activity, EVENT_GENRES), EVENT_GENRES
        )
        plan = physical(view)
        eligible = physical(
            training.eligible_accounts(
                training.upsell_training_view(
                    accounts, viewing_features(stored_activity, EVENT_GENRES), EVENT_GENRES
                ),
                "AUTOMOBILE",
            )
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert exchanges(plan) == 2
    filter_line = next(line for line in eligible.splitlines() if "AUTOMOBILE" in line and "Filter" in line)
    join_line = next(line for line in eligible.splitlines() if "SortMergeJoin" in line)
    assert eligible.index(filter_line) > eligible.index(join_line)
    assert "churn_probability_true" not in plan


def test_large_activity_stays_in_generated_code(spark):
    plan = physical(viewing_features(line_activity(spark, SMALL), ("A", "N", "R"), digits=2))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_the_churn_job_never_broadcasts_accounts(spark, monkeypatch):
    ids = spark.range(300)
    account = F.col("id").alias("account_id")
    values = [F.lit(1).cast(f.dataType).alias(f.name) for f in SUBSCRIBERS if f.name not in ("account_id", CHURN_LABEL)]
    accounts = ids.select(account, (F.col("id") % 3 % 2).alias(CHURN_LABEL), *values)
    hours = [F.lit(1.0).alias(c) for c in ("hrs_p", "hrs_q", "total_viewing_hours")]
    activity = ids.select(account, F.lit(0).cast("bigint").alias("months_ago"), *hours)
    monkeypatch.setattr(jobs, "train_churn_model", lambda frame, *a, **k: frame)
    frame = churn_training_job(accounts, activity, "", "", "v", 1, genres=("p", "q"))
    split = stratified_split(frame)
    assert sum(r["is_test"] for r in split.collect()) == 60
    plan = physical(split)  # the one that ran: adaptive execution has not turned the joins either
    assert "isFinalPlan=true" in plan
    assert re.search(r"ShuffledHashJoin \[account_id", plan)
    assert not re.search(r"Broadcast\w*Join \[account_id", plan)
