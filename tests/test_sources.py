from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from halyard.contract import activity_schema
from halyard.sources import (
    SchemaError,
    conform,
    ensure_checkpoint_dir,
    ensure_database,
    materialise,
    read_account_range,
    read_csv,
    read_report_json,
    with_range_bucket,
    workspace_path,
    write_by_range,
    write_csv,
    write_metrics_json,
)

SCHEMA = activity_schema(("sport",))


def test_csv_round_trip_keeps_nulls(spark, tmp_path):
    rows = [(1, 0, 1.25, 2.5), (2, None, None, 0.0)]
    path = write_csv(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in read_csv(spark, path, SCHEMA).collect()) == rows


@pytest.mark.parametrize(
    "text",
    [
        "account_id,months_ago,hrs_sport,total_viewing_hours\n1,zero,1.0,1.0\n",
        "account_id,hrs_sport,months_ago,total_viewing_hours\n1,1.0,0,1.0\n",
    ],
    ids=["wrong value", "wrong header"],
)
def test_malformed_csv_is_an_error(spark, tmp_path, text):
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "bad.csv"), SCHEMA).collect()


def test_conform_names_missing_and_unexpected_columns(spark):
    frame = spark.createDataFrame([(1, 2)], "account_id int, other int")
    with pytest.raises(SchemaError, match="months_ago.*other"):
        conform(frame, SCHEMA)


def test_conform_casts_and_orders(spark):
    frame = spark.createDataFrame([("2.5", "1.5", "3", "1")], "total_viewing_hours string, hrs_sport string, months_ago string, account_id string")
    got = conform(frame, SCHEMA)
    assert got.schema == SCHEMA
    assert tuple(got.first()) == (1, 3, 1.5, 2.5)


def test_range_bucket_edges(spark):
    keys = [(-1,), (0,), (4999,), (5000,), (49999,), (50000,)]
    frame = with_range_bucket(spark.createDataFrame(keys, "account_id bigint"))
    assert [r["account_bucket"] for r in frame.collect()] == [0, 1, 1, 2, 10, 11]


def test_range_read_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "ranges")
    write_by_range(spark.range(-5, 60_000).withColumnRenamed("id", "account_id"), path)
    frame = read_account_range(spark, path, 5_000, 11_000)
    assert frame.count() == 6_001
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(account_bucket" in plan
    assert {r[0] for r in frame.select("account_bucket").distinct().collect()} == {2, 3}
    assert read_account_range(spark, path).count() == 60_005
    assert read_account_range(spark, path, last=-1).count() == 5


def test_metrics_json_keeps_null_metrics(spark, tmp_path):
    record = spark.createDataFrame([(None, 0.25, 7)], "roc_auc double, ap double, n bigint")
    path = write_metrics_json(record, str(tmp_path / "metrics"))
    assert '"roc_auc":null' in "".join(p.read_text() for p in (tmp_path / "metrics").glob("*.json"))
    assert tuple(read_report_json(spark, path, record.schema).first()) == (None, 0.25, 7)


def test_materialise_stores_rows_once(spark, tmp_path):
    frame = spark.range(10).withColumn("x", F.rand())
    stored = materialise(frame, str(tmp_path / "stored"))
    assert stored.collect() == stored.collect()
    assert stored.columns == frame.columns


def test_database_creation_is_repeatable(spark):
    ensure_database(spark, "halyard_test")
    ensure_database(spark, "halyard_test")
    assert spark.catalog.databaseExists("halyard_test")


def test_workspace_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = ensure_checkpoint_dir(spark)
    if configured:
        assert folder == configured
    first, second = workspace_path(spark, "x"), workspace_path(spark, "x")
    assert first.startswith(folder) and first != second
