from __future__ import annotations

import random
import sys

import pytest
from pyspark.sql import functions as F

from halyard import __main__ as command_line
from halyard.contract import GENRES, SUBSCRIBERS, activity_schema
from halyard.operators import learning
from halyard.plans import DifferentJobError, jobs
from halyard.sources import write_csv


def run(monkeypatch, *arguments):
    monkeypatch.setattr(sys, "argv", ["halyard", *arguments])
    command_line.main()


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(5)
    accounts = [
        (
            i, rng.randrange(1, 90), rng.choice(["Basic TV", "Sky Sports"]), 15.0, 17.5, 1, 3,
            rng.choice(["Wales", "London"]), "mobile_app", 2, 2, "rolling_monthly", 0, 0, 0, 0, 6,
            0.5, 0.1, i % 2, 0.2, i % 3 % 2,
        )
        for i in range(1, 31)
    ]
    activity = []
    for i in range(1, 31):
        for month in range(3):
            hours = [round(rng.random() * 9, 2) for _ in GENRES]
            activity.append((i, month, *hours, round(sum(hours), 2)))
    paths = {}
    for name, rows, schema in (
        ("subscribers", accounts, SUBSCRIBERS),
        ("activity", activity, activity_schema()),
    ):
        paths[name] = write_csv(spark.createDataFrame(rows, schema), str(tmp_path / f"{name}-csv"))
    return paths


def test_views_from_csv(spark, tmp_path, monkeypatch, tables):
    output = str(tmp_path / "views")
    run(
        monkeypatch, "views", "--subscribers", tables["subscribers"],
        "--activity", tables["activity"], "--output", output,
    )
    assert spark.read.parquet(f"{output}/viewing_features").count() == 30
    churn = spark.read.parquet(f"{output}/churn_training_view")
    assert len(churn.columns) == 27 and churn.count() == 30
    rollup = spark.read.parquet(f"{output}/segment_genre_affinity")
    assert sum(r["n_accounts"] for r in rollup.collect()) == 30


def test_parquet_inputs_are_conformed(spark, tmp_path, monkeypatch, tables):
    stored = str(tmp_path / "activity.parquet")
    rows = spark.read.option("header", True).csv(tables["activity"])
    rows.select(*reversed(rows.columns)).write.parquet(stored)
    output = str(tmp_path / "views")
    run(
        monkeypatch, "views", "--subscribers", tables["subscribers"],
        "--activity", stored, "--output", output,
    )
    assert spark.read.parquet(f"{output}/viewing_features").count() == 30


def test_unknown_job_is_refused(monkeypatch):
    with pytest.raises(SystemExit):
        run(monkeypatch, "other")


def test_training_from_a_view_scoring_stream_offers_and_targets(spark, tmp_path, monkeypatch, tables):
    views, churn = str(tmp_path / "views"), str(tmp_path / "churn")
    base = ("--subscribers", tables["subscribers"], "--activity", tables["activity"])
    run(monkeypatch, "views", *base, "--output", views, "--digits", "2", "--missing-month", "null")
    spark.read.parquet(f"{views}/churn_training_view").createOrReplaceTempView("cli_churn_view")
    registry = str(tmp_path / "registry")
    monkeypatch.setitem(learning.CHURN_SETTINGS, "maxIter", 2)
    train = ("--view", "cli_churn_view", "--output", churn, "--registry", registry, "--version", "v1")
    run(monkeypatch, "churn", *train, "--run", "1", "--min-auc", "0.0")
    monkeypatch.setattr(jobs, "fit", lambda *a: pytest.fail("fitted again"))
    run(monkeypatch, "churn", *train, "--run", "1", "--min-auc", "0.0", "--resume")
    with pytest.raises(DifferentJobError):
        run(monkeypatch, "churn", *train, "--run", "2", "--resume")

    accounts = str(tmp_path / "arriving")
    spark.table("cli_churn_view").drop("label").write.parquet(accounts)
    stream = str(tmp_path / "stream")
    run(
        monkeypatch, "stream", "--registry", registry, "--source", accounts, "--like", accounts,
        "--output", stream, "--checkpoint", str(tmp_path / "checkpoint"),
    )
    scored = spark.read.parquet(stream)
    assert scored.count() == 30 and {r["version"] for r in scored.collect()} == {"v1"}

    offers = str(tmp_path / "offers")
    run(monkeypatch, "offers", "--scores", stream, "--budget", "7", "--output", offers)
    assert sorted(r["offer_rank"] for r in spark.read.parquet(offers).collect()) == list(range(1, 8))

    segments, targets = str(tmp_path / "segments"), str(tmp_path / "targets")
    viewing = spark.read.parquet(f"{views}/viewing_features")
    viewing.withColumn("segment", F.col("account_id") % 3).write.parquet(segments)
    run(
        monkeypatch, "retention", "--scores", stream, "--segmented", segments, "--output", targets,
        "--quantile", "0.8",
    )
    found = spark.read.parquet(targets)
    assert 6 <= found.count() < 30 and found.where("offer LIKE '%_save_offer'").count() == found.count()


@pytest.mark.parametrize("given", [(), ("--view", "v", "--activity", "a"), ("--subscribers", "s")])
def test_a_job_needs_either_a_view_or_its_tables(monkeypatch, given):
    with pytest.raises(SystemExit):
        run(monkeypatch, "propensity", "--output", "o", *given)
