from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halyard import functions as H
from halyard.functions.scorecard import churn_scorecard, risk_flags, upsell_scorecard


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_safe_divide_gives_null_for_zero_and_null(spark):
    rows = [(6.0, 3.0), (1.0, 0.0), (1.0, None), (None, 2.0), (0.0, 4.0)]
    got = values(spark, rows, "a double, b double", H.safe_divide(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [2.0, None, None, None, 0.0]


def test_round_half_away_on_ties_and_large_values(spark):
    rows = [(0.0625,), (-0.0625,), (2.5,), (-0.00001,), (1e300,), (None,)]
    got = [g[0] for g in values(spark, rows, "x double", H.round_half_away(F.col("x"), 3))]
    assert got == [0.063, -0.063, 2.5, 0.0, 1e300, None]
    assert math.copysign(1.0, got[3]) == 1.0


def test_round_half_away_keeps_nan(spark):
    got = values(spark, [(float("nan"),)], "x double", H.round_half_away(F.col("x"), 2))
    assert math.isnan(got[0][0])


def test_clip_keeps_null(spark):
    got = values(spark, [(-5.0,), (3.0,), (9.0,), (None,)], "x double", H.clip(F.col("x"), 0.0, 4.0))
    assert [g[0] for g in got] == [0.0, 3.0, 4.0, None]


def test_sigmoid_does_not_overflow(spark):
    got = values(spark, [(-1000.0,), (0.0,), (1000.0,)], "x double", H.sigmoid(F.col("x")))
    assert [g[0] for g in got] == [0.0, 0.5, 1.0]


def test_flag_treats_null_as_false(spark):
    got = values(spark, [(1,), (5,), (None,)], "x bigint", H.flag(F.col("x") > 2))
    assert [g[0] for g in got] == [0, 1, 0]


def test_first_largest_takes_the_first_tie_and_skips_null_and_nan(spark):
    rows = [
        (0.4, 0.4, 0.2),
        (None, 0.1, 0.3),
        (float("nan"), 0.7, 0.1),
        (None, None, None),
    ]
    column = H.first_largest({"x": F.col("a"), "y": F.col("b"), "z": F.col("c")})
    got = values(spark, rows, "a double, b double, c double", column)
    assert [g[0] for g in got] == ["x", "z", "y", None]


def test_strip_prefix_only_at_the_start(spark):
    got = values(
        spark, [("affinity_news",), ("x_affinity_news",)], "n string",
        H.strip_prefix(F.col("n"), "affinity_"),
    )
    assert [g[0] for g in got] == ["news", "x_affinity_news"]


def test_null_if_zero(spark):
    got = values(spark, [(0.0,), (2.0,), (None,)], "x double", H.null_if_zero(F.col("x")))
    assert [g[0] for g in got] == [None, 2.0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10_000_000, 10_000_000), min_size=1, max_size=200))
def test_exact_sum_does_not_depend_on_order(spark, cents):
    rows = [(c / 100,) for c in cents]
    forward = spark.createDataFrame(rows, "x double").repartition(7)
    backward = spark.createDataFrame(rows[::-1], "x double").repartition(3)
    sums = [f.agg(H.exact_sum(F.col("x"), 2)).first()[0] for f in (forward, backward)]
    assert sums == [sum(cents) / 100] * 2


ACCOUNT = {
    "plan": "Basic TV",
    "months_since_last_price_rise": 5,
    "months_to_contract_end": 3,
    "support_contacts_last_90d": 0,
    "billing_dispute_last_90d": 0,
    "outage_reported_last_90d": 0,
    "nps_last_survey": 0,
    "competitor_ad_exposure_score": 0.0,
    "tenure_months": 0,
    "current_monthly_price_gbp": 0.0,
    "num_devices_registered": 0,
}


def account(spark, **changes):
    return spark.createDataFrame([{**ACCOUNT, **changes}])


@pytest.mark.parametrize(
    ("changes", "logit"),
    [
        ({}, -2.6),
        ({"months_since_last_price_rise": 2}, -1.7),
        ({"months_to_contract_end": 0}, -2.1),
        ({"support_contacts_last_90d": 9}, -1.2),
        ({"nps_last_survey": 10, "billing_dispute_last_90d": 1}, -2.6),
    ],
)
def test_churn_scorecard(spark, changes, logit):
    got = account(spark, **changes).select(churn_scorecard(F.lit(0.0))).first()[0]
    assert got == pytest.approx(1 / (1 + math.exp(-logit)), abs=5e-5)


def test_upsell_scorecard_lowers_the_top_plan(spark):
    low = account(spark, plan="Ultimate TV").select(upsell_scorecard(F.lit(0.0))).first()[0]
    high = account(spark, num_devices_registered=2).select(upsell_scorecard(F.lit(0.0))).first()[0]
    assert low == pytest.approx(1 / (1 + math.exp(3.0)), abs=5e-5)
    assert high == pytest.approx(1 / (1 + math.exp(1.1)), abs=5e-5)


def test_risk_flags_turn_null_into_zero(spark):
    frame = spark.createDataFrame(
        [(1, None, None, None), (2, 2, -1, "Ultimate TV")],
        "account_id bigint, months_since_last_price_rise bigint, months_to_contract_end bigint,"
        " plan string",
    )
    got = {tuple(r) for r in risk_flags(frame).collect()}
    assert got == {(1, 0, 0, 0), (2, 1, 1, 1)}
