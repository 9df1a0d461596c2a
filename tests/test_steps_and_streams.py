"""Streams that follow promotions, jobs that are taken up again, range tables, reports in order."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from halyard.contract import CHURN_VIEW_ACCOUNT_COLUMNS, SUBSCRIBERS, viewing_columns
from halyard.operators import order_statistics, segments
from halyard.plans import (
    DifferentJobError,
    affinity_job,
    jobs,
    promote,
    promotion_log,
    segment_accounts,
    train_churn_model,
)
from halyard.plans.steps import Steps
from halyard.sources import ranges
from halyard.sources.tables import SchemaError, ensure_database, read_report_in_order, write_csv
from halyard.streaming import promoted_scorer, score_stream_promoted

# --- a stream that follows the promoted model -----------------------------------------


def fitted(spark, value: float) -> PipelineModel:
    """A fitted pipeline whose score is ``value`` for every row, learned from constant labels."""
    positives = round(value * 100)
    rows = [(0.0, float(i < positives)) for i in range(100)]
    learner = LogisticRegression(regParam=0.0, maxIter=50, tol=1e-12)
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"), learner]
    return Pipeline(stages=stages).fit(spark.createDataFrame(rows, "x double, label double"))


@pytest.fixture(scope="module")
def models(spark):
    return {value: fitted(spark, value) for value in (0.25, 0.75)}


def passing(spark):
    return spark.createDataFrame([(0.9,)], "roc_auc double")


def arrive(spark, source: str, ids) -> None:
    rows = spark.createDataFrame([(i, 0.0) for i in ids], "account_id bigint, x double")
    rows.coalesce(1).write.mode("append").parquet(source)


def scores_of(spark, sink: str) -> dict:
    found = spark.read.parquet(sink).collect()
    assert len({r.account_id for r in found}) == len(found)
    return {r.account_id: (r.run, r.version, r.batch, round(r.score, 3)) for r in found}


def test_a_promotion_between_two_starts_takes_effect(spark, models, tmp_path):
    root, source, sink, checkpoint = (str(tmp_path / n) for n in ("registry", "in", "out", "check"))

    def run():
        score_stream_promoted(
            spark, root, source, spark.read.parquet(source).schema, sink, checkpoint
        ).awaitTermination()

    arrive(spark, source, range(3))
    promote(models[0.25], passing(spark), root, "one", run=1)
    run()
    promote(models[0.75], passing(spark), root, "two", run=2)
    run()  # nothing new
    arrive(spark, source, range(3, 5))
    run()
    first, second = (1, "one", 0, 0.25), (2, "two", 1, 0.75)
    assert scores_of(spark, sink) == {0: first, 1: first, 2: first, 3: second, 4: second}


def test_a_promotion_reaches_a_running_stream(spark, models, tmp_path):
    root, source, sink, checkpoint = (str(tmp_path / n) for n in ("registry", "in", "out", "check"))
    arrive(spark, source, range(2))
    promote(models[0.25], passing(spark), root, "one", run=1)
    schema = spark.read.parquet(source).schema
    query = score_stream_promoted(spark, root, source, schema, sink, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        promote(models[0.75], passing(spark), root, "two", run=2)
        arrive(spark, source, range(2, 4))
        query.processAllAvailable()
    finally:
        query.stop()
    assert {i: s[1] for i, s in scores_of(spark, sink).items()} == {0: "one", 1: "one", 2: "two", 3: "two"}


def test_a_repeated_batch_gives_the_same_rows(spark, models, tmp_path):
    root, sink = str(tmp_path / "registry"), str(tmp_path / "out")
    rows = spark.createDataFrame([(i, 0.0) for i in range(4)], "account_id bigint, x double")
    promote(models[0.25], passing(spark), root, "one", run=1)
    promoted_scorer(root, sink)(rows.where("account_id < 2"), 0)
    before = scores_of(spark, sink)
    promote(models[0.75], passing(spark), root, "two", run=2)
    again = promoted_scorer(root, sink)  # a driver that was started anew
    again(rows.where("account_id < 2"), 0)
    assert scores_of(spark, sink) == before
    again(rows.where("account_id >= 2"), 1)
    assert {s[1] for i, s in scores_of(spark, sink).items() if i >= 2} == {"two"}
    assert {i: s for i, s in scores_of(spark, sink).items() if i < 2} == before


def test_files_wait_for_the_first_promotion(spark, models, tmp_path):
    root, source, sink, checkpoint = (str(tmp_path / n) for n in ("registry", "in", "out", "check"))
    arrive(spark, source, range(2))
    schema = spark.read.parquet(source).schema
    failing = spark.createDataFrame([(0.1,)], "roc_auc double")
    assert not promote(models[0.25], failing, root, "none", run=0)
    with pytest.raises(StreamingQueryException, match="no promoted model"):
        score_stream_promoted(spark, root, source, schema, sink, checkpoint).awaitTermination()
    promote(models[0.75], passing(spark), root, "two", run=2)
    score_stream_promoted(spark, root, source, schema, sink, checkpoint).awaitTermination()
    assert {s[1] for s in scores_of(spark, sink).values()} == {"two"}


# --- jobs that are taken up again ---------------------------------------------------------


@pytest.fixture(scope="module")
def churn_frame(spark):
    rng = random.Random(3)
    kinds = {f.name: f.dataType.simpleString() for f in SUBSCRIBERS}
    accounts = [c for c in CHURN_VIEW_ACCOUNT_COLUMNS if c != "account_id"]
    features = [c for c in viewing_columns() if c != "account_id"]
    rows = []
    for i in range(200):
        values = [rng.choice("ab") if kinds[c] == "string" else rng.randrange(9) for c in accounts]
        values = [float(v) if kinds[c] == "double" else v for v, c in zip(values, accounts)]
        rows.append((i, *values, *[rng.random() for _ in features], int(rng.random() < 0.4)))
    schema = ", ".join(
        ["account_id bigint", *(f"{c} {kinds[c]}" for c in accounts), *(f"{c} double" for c in features), "label bigint"]
    )
    return spark.createDataFrame(rows, schema)


def test_a_job_that_died_after_its_fit_does_not_fit_again(spark, churn_frame, tmp_path, monkeypatch):
    output, registry = str(tmp_path / "job"), str(tmp_path / "registry")
    fits, fit, score = [], jobs.fit, jobs.batch_score

    def start(**options):
        return train_churn_model(churn_frame, output, registry, "v", 1, min_auc=0.0, maxIter=2, **options)

    monkeypatch.setattr(jobs, "fit", lambda *a: fits.append(1) or fit(*a))
    monkeypatch.setattr(jobs, "batch_score", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        start()
    monkeypatch.setattr(jobs, "batch_score", score)
    done = start(resume=True)
    assert fits == [1] and done.passed
    again = start(resume=True)
    assert fits == [1] and again.metrics.collect() == done.metrics.collect()
    assert promotion_log(spark, registry).count() == 1
    with pytest.raises(DifferentJobError):
        start(resume=True, maxDepth=2)
    start()  # anew
    assert fits == [1, 1]


def test_a_step_without_its_mark_is_made_again(spark, tmp_path):
    steps = Steps(spark, str(tmp_path), {"job": "x"}, resume=False)
    spark.range(3).write.parquet(str(tmp_path / "table"))  # half a step: no mark
    assert steps.table("table", lambda: spark.range(5)).count() == 5
    again = Steps(spark, str(tmp_path), {"job": "x"}, resume=True)
    assert again.table("table", lambda: pytest.fail("made again")).count() == 5
    done = []
    again.once("report", lambda: done.append(1))
    again.once("report", lambda: done.append(1))
    assert done == [1]


def test_the_affinity_job_finds_its_search(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    genres = ("p", "q", "r")
    rows = []
    for i in range(60):
        shares = [rng.random() + (i % 3 == g) * 3 for g in range(3)]
        rows.append((i, *[s / sum(shares) for s in shares]))
    rows.append((60, None, 0.5, 0.5))
    frame = spark.createDataFrame(rows, "account_id bigint, affinity_p double, affinity_q double, affinity_r double")
    options = {"genres": genres, "k_range": (2, 3), "restarts": 2}
    output = str(tmp_path / "segments")
    first = segment_accounts(frame, output, **options)
    monkeypatch.setattr(jobs, "kmeans_sweep", lambda *a: pytest.fail("searched again"))
    again = segment_accounts(frame, output, resume=True, **options)
    assert again.metrics.collect() == first.metrics.collect()
    assert first.metrics.where("selected").first()["k"] == 3
    assert spark.read.parquet(f"{output}/segmented").count() == 60
    assert affinity_job.__kwdefaults__["resume"] is False


# --- tables partitioned by ranges ---------------------------------------------------------


def test_a_range_table_reads_the_partitions_of_its_keys(spark, tmp_path):
    ensure_database(spark, "halyard_test")
    name, keys = "halyard_test.accounts", ranges.KeyRanges("account_id", 0, 100, 10)
    rows = spark.range(-5, 115).select(F.col("id").alias("account_id"), (F.col("id") * 2.0).alias("x"))
    unknown = spark.createDataFrame([(None, 1.0)], "account_id bigint, x double")
    ranges.ensure_range_table(spark, name, rows.schema, keys, str(tmp_path / "accounts"))
    ranges.ensure_range_table(spark, name, rows.schema, keys, str(tmp_path / "accounts"))
    ranges.load_range_table(rows.where("account_id % 2 = 0").union(unknown), name)
    ranges.load_range_table(rows.where("account_id % 2 <> 0").select("x", "account_id"), name)
    assert ranges.table_ranges(spark, name) == keys
    stored = spark.table(name)
    assert stored.count() == 121 and stored.columns[-1] == ranges.BUCKET
    assert stored.where("account_bucket <> width_bucket(account_id, 0, 100, 10)").count() == 0
    found = ranges.read_range_table(spark, name, 42, 47)
    assert sorted(r.account_id for r in found.collect()) == list(range(42, 48))
    folders = {r[0].split("account_bucket=")[1].split("/")[0] for r in found.select(F.input_file_name()).collect()}
    assert folders == {"5"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "account_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {ranges.read_range_table(spark, name, last=-1).count(), ranges.read_range_table(spark, name, 110).count()} == {5}
    assert ranges.read_range_table(spark, name).count() == 121
    ranges.load_range_table(rows.where("account_id < 10"), name, overwrite=True)
    assert spark.table(name).count() == 15


def test_a_range_table_refuses_what_would_misplace_rows(spark, tmp_path):
    ensure_database(spark, "halyard_test")
    rows = spark.range(3).withColumnRenamed("id", "account_id")
    place = str(tmp_path / "t")
    ranges.ensure_range_table(spark, "halyard_test.t", rows.schema, ranges.KeyRanges(count=4), place)
    with pytest.raises(SchemaError, match="other ranges"):
        ranges.ensure_range_table(spark, "halyard_test.t", rows.schema, ranges.KeyRanges(count=5), place)
    with pytest.raises(SchemaError):
        ranges.load_range_table(rows.withColumn(ranges.BUCKET, F.lit(1)), "halyard_test.t")
    with pytest.raises(SchemaError):
        ranges.ensure_range_table(spark, "halyard_test.u", rows.schema, ranges.KeyRanges("other"), place)
    spark.sql(f"CREATE TABLE halyard_test.plain (account_id BIGINT) USING parquet LOCATION '{tmp_path}/plain'")
    with pytest.raises(SchemaError, match="not partitioned by ranges"):
        ranges.read_range_table(spark, "halyard_test.plain", 1, 2)


# --- reports, cuts and silhouettes ----------------------------------------------------------


def test_reports_are_read_in_the_order_they_were_written(spark, tmp_path):
    rng = random.Random(6)
    values = [(f"f{i}", rng.random()) for i in range(500)]
    frame = spark.createDataFrame(values, "feature string, importance double").repartition(7)
    path = write_csv(frame.repartitionByRange(5, F.desc("importance")).sortWithinPartitions(F.desc("importance")), str(tmp_path / "r"))
    found = read_report_in_order(spark, path, frame.schema).orderBy("place").collect()
    assert [r.place for r in found] == list(range(1, 501))
    assert [r.importance for r in found] == sorted((v for _, v in values), reverse=True)


@pytest.mark.parametrize("parts", [1, 40])
def test_sketches_are_merged_in_the_cluster(spark, monkeypatch, parts):
    frame = spark.range(5000).select(
        F.sqrt("id").alias("root"), F.lit(2.0).alias("same"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 9 > 0, F.col("id")).otherwise(math.inf).alias("open"),
    ).repartition(parts)
    columns = ["root", "same", "none", "open"]
    monkeypatch.setattr(order_statistics, "DRIVER_RANGES", 10**9)
    on_driver = order_statistics._cut_points(frame, columns, 30)
    monkeypatch.setattr(order_statistics, "DRIVER_RANGES", 0)
    rows = []
    merge = order_statistics._merged_cuts
    monkeypatch.setattr(
        order_statistics, "_merged_cuts", lambda *a: rows.append(merge(*a).count()) or merge(*a)
    )
    merged = order_statistics._cut_points(frame, columns, 30)
    assert rows == [3]  # a row per column with a value, whatever the number of partitions
    assert [len(c) for c in merged] == [len(c) for c in on_driver] == [29, 29, 0, 29]
    for ours, theirs in zip(merged, on_driver):
        assert ours == sorted(ours)
        assert np.abs(np.array(ours) - theirs).max(initial=0) <= max(theirs, default=0) / 29
    wanted = sorted(math.sqrt(i) for i in range(5000))
    for q in (0.1, 0.5, 0.9):
        found = order_statistics.quantile(frame, "root", q).scalar()
        assert frame.select(found.alias("q")).first()["q"] == pytest.approx(np.quantile(wanted, q))


@pytest.mark.parametrize("part", [7, 512])
def test_sampled_silhouettes_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(segments, "PART", part)
    rng = np.random.default_rng(5)
    points = rng.normal(size=(90, 2))
    group = rng.integers(0, 3, 90)
    alone = np.where(np.arange(90) == 4, 9, group % 2)
    rows = [(i, float(x), float(y), int(g), int(a), 1) for i, ((x, y), g, a) in enumerate(zip(points, group, alone))]
    frame = spark.createDataFrame(rows, "account_id bigint, x double, y double, g int, alone int, one int")
    found = {
        r.assignment: r
        for r in segments.sampled_silhouette(frame, ["x", "y"], ["g", "alone", "one"], 1_000).collect()
    }
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))

    def plain(labels):
        values = []
        for i, own in enumerate(labels):
            same = (labels == own) & (np.arange(90) != i)
            others = [distance[i, labels == c].mean() for c in set(labels) - {own}]
            a, b = (distance[i, same].mean() if same.any() else 0.0), min(others)
            values.append((b - a) / max(a, b) if same.any() else 0.0)
        return np.mean(values)

    assert found["g"].silhouette == pytest.approx(plain(group))
    assert found["alone"].silhouette == pytest.approx(plain(alone))
    assert found["one"].silhouette is None and {r.n_sampled for r in found.values()} == {90}
    assert segments.sampled_silhouette(frame.limit(0), ["x"], ["g"], 5).collect() == []
