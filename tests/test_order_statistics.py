from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halyard.operators.order_statistics import quantile, running_totals, standardise, zscore
from halyard.operators.targeting import offer_list


def brute_running(rows, descending):
    ordered = sorted(rows, key=lambda r: ((-r[1] if descending else r[1]), r[0]))
    total, result = 0, {}
    for key, _, amount in ordered:
        total += amount
        result[key] = total
    return result


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("hot_share", [0.0, 0.34, 1.0])
def test_running_totals_with_heavy_ties(spark, descending, hot_share):
    rng = random.Random(7)
    rows = [
        (i, 0.5 if rng.random() < hot_share else rng.random(), rng.randrange(0, 9))
        for i in range(500)
    ]
    frame = spark.createDataFrame(rows, "id bigint, score double, amount bigint").repartition(5)
    got = running_totals(
        frame, "score", ["amount"], descending=descending, tie_break="id", ranges=16
    )
    assert {r["id"]: r["amount_running"] for r in got.collect()} == brute_running(rows, descending)
    assert {r["amount_total"] for r in got.collect()} == {sum(r[2] for r in rows)}


def test_a_heavy_value_is_split_into_several_parts(spark):
    from halyard.operators import order_statistics

    frame = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("score")
    )
    cut = order_statistics._find_ranges(frame, "score", "id", 16).assign(frame)
    sizes = [r["count"] for r in cut.groupBy("__range", "__part").count().collect()]
    assert max(sizes) < 120


def test_running_totals_up_to_a_limit(spark):
    frame = spark.createDataFrame([(i, float(i), 2) for i in range(100)], "id bigint, s double, c bigint")
    got = running_totals(frame, "s", ["c"], up_to=("c", F.lit(31)), tie_break="id", ranges=8)
    assert sorted(r["id"] for r in got.collect()) == list(range(85, 100))


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(-50, 50).map(lambda v: v / 8), min_size=1, max_size=120),
    st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]),
)
def test_quantile_equals_numpy(spark, values, q):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = quantile(frame, "v", q, ranges=6).first()[0]
    assert got == pytest.approx(float(np.quantile(values, q)), abs=1e-12)


def test_quantile_of_nothing_is_null(spark):
    assert quantile(spark.createDataFrame([], "v double"), "v", 0.5).first()[0] is None


def test_zscore_uses_the_population_deviation(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert sorted(r["v_z"] for r in zscore(frame, ["v"]).collect()) == [-1.0, 1.0]


def test_a_constant_column_is_scaled_to_zero(spark):
    frame = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [r["v_scaled"] for r in standardise(frame, ["v"]).collect()] == [0.0, 0.0]
    assert [r["v_z"] for r in zscore(frame, ["v"]).collect()] == [None, None]


def test_offer_list_takes_ties_by_key_and_stops_at_the_budget(spark):
    rows = [(5, 0.9, 10), (1, 0.7, 10), (2, 0.7, 10), (3, 0.7, 10), (4, 0.1, 1)]
    frame = spark.createDataFrame(rows, "account_id bigint, score double, cost bigint")
    by_cost = offer_list(frame, 35, cost="cost").orderBy("offer_rank").collect()
    assert [(r["account_id"], r["running_cost"]) for r in by_cost] == [(5, 10), (1, 20), (2, 30)]
    assert {r["account_id"] for r in offer_list(frame, 2).collect()} == {5, 1}
    assert offer_list(frame, 0).count() == 0
