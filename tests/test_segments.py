from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from halyard.operators import segments
from halyard.operators.rollups import affinity_index, affinity_long
from halyard.operators.targeting import best_candidate

GENRES = ("sport", "news", "kids")
COLUMNS = [f"affinity_{g}" for g in GENRES]
SCHEMA = "account_id bigint, affinity_sport double, affinity_news double, affinity_kids double"


def blobs(spark, per_blob=40, seed=1):
    rng = random.Random(seed)
    rows = []
    for b in range(3):
        for _ in range(per_blob):
            shares = [0.1 + rng.random() * 0.05 for _ in range(3)]
            shares[b] += 0.7
            rows.append((len(rows), *shares))
    return spark.createDataFrame(rows, SCHEMA)


def brute_silhouette(points, labels):
    values = []
    for i, p in enumerate(points):
        gaps = {}
        for j, q in enumerate(points):
            if i != j:
                gaps.setdefault(labels[j], []).append(math.dist(p, q))
        own = gaps.pop(labels[i], None)
        if not own:
            values.append(0.0)
            continue
        a, b = sum(own) / len(own), min(sum(g) / len(g) for g in gaps.values())
        values.append((b - a) / max(a, b))
    return sum(values) / len(values)


def test_silhouette_equals_brute_force_with_a_singleton(spark):
    rng = random.Random(4)
    rows = [(i, rng.random(), rng.random(), rng.random(), rng.randrange(4)) for i in range(120)]
    rows.append((120, 5.0, 5.0, 5.0, 9))
    frame = spark.createDataFrame(rows, SCHEMA + ", segment int").repartition(6)
    got = segments.sampled_silhouette(frame, COLUMNS, ["segment"]).first()
    expected = brute_silhouette([r[1:4] for r in rows], [r[4] for r in rows])
    assert got["silhouette"] == pytest.approx(expected, abs=1e-12)
    assert got["n_sampled"] == 121


def test_silhouette_of_one_cluster_is_null(spark):
    frame = blobs(spark).withColumn("segment", F.lit(0))
    assert segments.sampled_silhouette(frame, COLUMNS, ["segment"]).first()["silhouette"] is None


def test_a_sample_may_be_larger_than_the_table(spark):
    frame = blobs(spark).withColumn("segment", F.floor(F.col("account_id") / 40).cast("int"))
    everyone = segments.sampled_silhouette(frame, COLUMNS, ["segment"], sample_size=10**6)
    assert everyone.first()["n_sampled"] == frame.count()


def test_silhouettes_of_several_assignments_share_one_sample(spark):
    frame = blobs(spark).withColumn("good", F.floor(F.col("account_id") / 40).cast("int"))
    frame = frame.withColumn("bad", (F.col("account_id") % 3).cast("int"))
    got = {
        r["assignment"]: (r["silhouette"], r["n_sampled"])
        for r in segments.sampled_silhouette(frame, COLUMNS, ["good", "bad"], 50).collect()
    }
    assert got["good"][1] == got["bad"][1] == 50
    assert got["good"][0] > 0.8 > 0.1 > got["bad"][0]


def test_sweep_finds_the_three_personas_with_stable_ids(spark):
    affinity = blobs(spark)
    found = segments.kmeans_sweep(affinity, COLUMNS, range(2, 5), restarts=2)
    assert found.best_k == 3
    assert best_candidate(found.candidates).first()["k"] == 3
    assigned = segments.assign_segments(found.model, affinity, COLUMNS)
    profile = {r["segment"]: r for r in segments.segment_profile(assigned, GENRES).collect()}
    assert {s: r["dominant_genre"] for s, r in profile.items()} == dict(enumerate(GENRES))
    assert {r["n_accounts"] for r in profile.values()} == {40}


def test_best_candidate_prefers_the_smaller_k(spark):
    rows = [(5, 0.3), (4, 0.3), (3, 0.1), (6, None)]
    frame = spark.createDataFrame(rows, "k int, silhouette double")
    assert best_candidate(frame).first()["k"] == 4


def test_profile_takes_the_first_of_two_equal_shares_after_rounding(spark):
    rows = [(1, 0.40004, 0.40001, 0.2), (2, 0.4, 0.40004, 0.2)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.lit(0))
    assert segments.segment_profile(frame, GENRES).first()["dominant_genre"] == "sport"


def test_affinity_index_and_long_form(spark):
    frame = blobs(spark).withColumn("segment", F.floor(F.col("account_id") / 40).cast("int"))
    index = {r["segment"]: r for r in affinity_index(frame, genres=GENRES).collect()}
    assert index[0]["index_affinity_sport"] > 2 > 1 > index[1]["index_affinity_sport"]
    long = affinity_long(segments.segment_profile(frame, GENRES), genres=GENRES)
    assert long.columns == ["segment", "genre", "share"]
    assert long.count() == 9


def test_full_silhouette_is_reported_under_its_own_name(spark):
    frame = blobs(spark).withColumn("segment", F.floor(F.col("account_id") / 40).cast("int"))
    row = segments.full_silhouette(frame, COLUMNS, "segment").first()
    assert row["assignment"] == "segment" and row["silhouette_squared"] > 0.9
