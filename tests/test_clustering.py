from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from halyard.operators import clustering, segments

COLUMNS = ["affinity_p", "affinity_q", "affinity_r"]
SCHEMA = "account_id bigint, " + ", ".join(f"{c} double" for c in COLUMNS)


def uneven(spark, n=600, seed=3):
    random = np.random.default_rng(seed)
    shares = random.dirichlet([1.0, 2.0, 0.7], n)
    return spark.createDataFrame([(i, *map(float, s)) for i, s in enumerate(shares)], SCHEMA)


def points_of(frame):
    return np.array([r[1:] for r in frame.orderBy("account_id").collect()])


def squared(points, centres):
    return ((points[:, None] - centres[None]) ** 2).sum(axis=2)


@pytest.fixture
def jobs_of(spark):
    """The number of Spark jobs that a call starts."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def count(group, call):
        context.setJobGroup(group, group)
        try:
            call()
            return len(tracker.getJobIdsForGroup(group))
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    return count


def test_more_restarts_are_no_more_jobs(spark, jobs_of, monkeypatch):
    monkeypatch.setattr(clustering, "TOLERANCE", -1.0)  # all fits take every step
    monkeypatch.setattr(clustering, "MAX_ITERATIONS", 3)
    affinity = uneven(spark)
    one = jobs_of("one", lambda: segments.kmeans_sweep(affinity, COLUMNS, range(3, 5), restarts=1))
    many = jobs_of("many", lambda: segments.kmeans_sweep(affinity, COLUMNS, range(3, 5), restarts=6))
    assert many == one


def test_costs_are_those_of_the_centres_and_as_low_as_fits_one_by_one(spark):
    frame = uneven(spark).repartition(5)
    points = points_of(frame)
    fits = clustering.fit_all(frame, COLUMNS, "account_id", range(3, 6), range(42, 52))
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(frame).cache()
    for k, found in fits.items():
        assert len(found.centres) == k
        assert found.cost == pytest.approx(squared(points, found.centres).min(axis=1).sum(), rel=1e-12)
        alone = [KMeans(k=k, seed=s, featuresCol="v").fit(vectors) for s in (42, 43)]
        assert found.cost <= 1.01 * min(m.summary.trainingCost for m in alone)


def test_fits_do_not_depend_on_partitions(spark):
    frame = uneven(spark)
    one, other = (
        clustering.fit_all(frame.repartition(n), COLUMNS, "account_id", [4], [1]) for n in (1, 7)
    )
    assert one[4].centres == pytest.approx(other[4].centres, abs=1e-9)


def test_fewer_distinct_rows_than_centres(spark):
    rows = [(i % 7 or None, *[(0.2, 0.3, 0.5), (0.6, 0.2, 0.2)][i % 2]) for i in range(40)]
    fits = clustering.fit_all(spark.createDataFrame(rows, SCHEMA), COLUMNS, "account_id", [2, 3], [5])
    for found in fits.values():
        assert sorted(found.centres.tolist()) == [[0.2, 0.3, 0.5], [0.6, 0.2, 0.2]]
        assert found.cost == 0


def test_no_row_is_drawn_twice_and_few_rows_are_all_drawn(spark):
    frame = uneven(spark, 30)
    chosen = [np.empty((0, 3))]
    for size in (1, 10, 50):
        chosen = clustering._draw(frame, COLUMNS, "account_id", [9], chosen, size)
    assert sorted(chosen[0].tolist()) == sorted(points_of(frame).tolist())


def test_rows_are_drawn_by_their_distance(spark):
    rows = [(i, 0.0, 0.0, float(i % 2 + 1)) for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA)
    seeds = list(range(200))
    start = [np.zeros((1, 3)) for _ in seeds]
    drawn = clustering._draw(frame, COLUMNS, "account_id", seeds, start, 1)
    far = sum(c[1][2] == 2.0 for c in drawn)
    assert 140 <= far <= 180  # four fifths are expected


def test_the_model_has_exactly_the_centres(spark):
    centres = np.random.default_rng(8).normal(size=(6, 3))
    model = segments._model_of(clustering.Clusters(centres, 0.0), 6, 42, spark)
    assert sorted(c.tolist() for c in model.clusterCenters()) == sorted(centres.tolist())
    alone = segments._model_of(clustering.Clusters(centres[:1], 0.0), 6, 42, spark)
    assert [c.tolist() for c in alone.clusterCenters()] == centres[:1].tolist()
