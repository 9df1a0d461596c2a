from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from halyard.contract import SUBSCRIBERS, activity_schema
from halyard.operators import rollups, training
from halyard.operators.viewing import key_violations, month_totals, union_months, viewing_features
from halyard.plans.views import register_feature_views

GENRES = ("sport", "news")


def activity(spark, rows):
    return spark.createDataFrame(rows, activity_schema(GENRES))


def features(spark, rows, **options):
    got = viewing_features(activity(spark, rows), GENRES, **options).collect()
    return {r["account_id"]: r.asDict() for r in got}


@pytest.mark.parametrize("digits", [None, 2])
def test_trend_and_shares(spark, digits):
    rows = [(1, 2, 3.0, 1.0, 4.0), (1, 1, 0.0, 0.0, 0.0), (1, 0, 1.0, 4.0, 5.0)]
    got = features(spark, rows, digits=digits)[1]
    assert got["avg_total_viewing_hours"] == 3.0
    assert got["viewing_trend_3mo"] == 0.25
    assert got["affinity_sport"] == pytest.approx(4 / 9)
    assert got["affinity_news"] == pytest.approx(5 / 9)


@pytest.mark.parametrize(
    ("months", "option", "trend"),
    [
        ([(2, 4.0), (0, 6.0)], "zero", 0.5),
        ([(2, 4.0)], "zero", -1.0),
        ([(2, 4.0)], "null", None),
        ([(0, 6.0)], "zero", None),
        ([(0, 6.0), (2, 0.0)], "zero", None),
    ],
)
def test_missing_months(spark, months, option, trend):
    rows = [(1, m, h, 0.0, h) for m, h in months]
    assert features(spark, rows, missing_month=option)[1]["viewing_trend_3mo"] == trend


def test_nothing_watched_gives_null_and_is_dropped_before_clustering(spark):
    frame = viewing_features(
        activity(spark, [(1, m, 0.0, 0.0, 0.0) for m in range(3)] + [(2, 0, 1.0, 0.0, 1.0)]), GENRES
    )
    idle = frame.where("account_id = 1").first()
    assert idle["affinity_sport"] is None and idle["viewing_trend_3mo"] is None
    assert [r["account_id"] for r in training.drop_null_affinity(frame, GENRES).collect()] == [2]


def test_duplicate_months_are_summed_and_reported(spark):
    frame = activity(spark, [(1, 0, 1.0, 0.0, 1.0), (1, 0, 2.0, 0.0, 2.0), (2, 0, 1.0, 0.0, 1.0)])
    totals = {r["account_id"]: r["hrs_month_current"] for r in month_totals(frame).collect()}
    assert totals == {1: 3.0, 2: 1.0}
    assert [tuple(r) for r in key_violations(frame).collect()] == [(1, 0, 2)]


def test_pivot_keeps_absent_months_null(spark):
    frame = activity(spark, [(1, 0, 1.0, 0.0, 1.0)])
    assert tuple(month_totals(frame, missing_month="null").first()) == (1, 1.0, None, None)


def test_unknown_missing_month_option(spark):
    with pytest.raises(ValueError):
        month_totals(activity(spark, [(1, 0, 1.0, 0.0, 1.0)]), missing_month="other")


def test_union_months_matches_columns_by_name_and_keeps_duplicates(spark):
    one = activity(spark, [(1, 0, 1.0, 0.0, 1.0)])
    two = one.select(*reversed(one.columns))
    assert [tuple(r) for r in union_months(one, two).collect()] == [(1, 0, 1.0, 0.0, 1.0)] * 2


def subscriber(account_id, plan="Basic TV", churned=0, accepted=1):
    return (
        account_id, 10, plan, 15.0, 16.5, 1, 4, "London", "mobile_app", 2, 3, "18mo_contract", 5,
        0, 0, 0, 7, 0.25, 0.1, churned, 0.4, accepted,
    )


@pytest.fixture
def base(spark):
    accounts = [
        subscriber(1, churned=1),
        subscriber(2, plan=None),
        subscriber(3, plan="Ultimate TV"),
        subscriber(9),
    ]
    subscribers = spark.createDataFrame(accounts, SUBSCRIBERS)
    viewing = activity(spark, [(i, m, 1.0, 2.0, 3.0) for i in (1, 2, 3, 77) for m in range(3)])
    return subscribers, viewing


def test_views_hold_only_accounts_on_both_sides(base):
    subscribers, rows = base
    viewing = viewing_features(rows, GENRES)
    churn = training.churn_training_view(subscribers, viewing, GENRES)
    upsell = training.upsell_training_view(subscribers, viewing, GENRES)
    assert {r["account_id"]: r["label"] for r in churn.collect()} == {1: 1, 2: 0, 3: 0}
    assert {r["account_id"]: r["label"] for r in upsell.collect()} == {1: 1, 2: 1, 3: 1}
    assert "base_monthly_price_gbp" not in churn.columns
    assert "base_monthly_price_gbp" in upsell.columns
    assert not set(training.HIDDEN_COLUMNS) & (set(churn.columns) | set(upsell.columns))


def test_eligibility_keeps_an_unknown_plan(base):
    kept = training.eligible_accounts(base[0]).collect()
    assert {r["account_id"] for r in kept} == {1, 2, 9}


def test_leakage_guard(base):
    with pytest.raises(training.LeakageError, match="churn_probability_true"):
        training.leakage_guard(base[0])


def test_column_selection_helpers(base):
    view = training.churn_training_view(base[0], viewing_features(base[1], GENRES), GENRES)
    numeric = training.columns_except(view)
    assert "tenure_months" in numeric and "plan" not in numeric and "label" not in numeric
    assert training.columns_with_prefix(view) == ["affinity_sport", "affinity_news"]


def test_base_price_of_known_and_unknown_plans(spark):
    plans = spark.createDataFrame([("Sky Cinema",), ("Other",), (None,)], "plan string")
    got = [r[1] for r in training.with_base_price(plans).collect()]
    assert got == [36.0, None, None]


def test_rollup_counts_accounts_with_null_shares(spark, base):
    idle = activity(spark, [(1, 0, 0.0, 0.0, 0.0), (9, 0, 1.0, 1.0, 2.0)])
    got = rollups.segment_genre_affinity(base[0], viewing_features(idle, GENRES), GENRES).collect()
    assert [(r["plan"], r["avg_affinity_sport"], r["n_accounts"]) for r in got] == [
        ("Basic TV", 0.5, 2)
    ]


def test_sql_views_agree_with_plain_sql(spark, base):
    """The same features written as SQL over the base tables."""
    subscribers, rows = base
    register_feature_views(subscribers, rows, GENRES)
    subscribers.createOrReplaceTempView("subscribers")
    rows.createOrReplaceTempView("viewing_activity")
    twin = spark.sql(
        """
        SELECT s.plan, s.region, count(*) AS n_accounts, avg(v.share) AS share
        FROM subscribers s JOIN (
          SELECT account_id, try_divide(avg(hrs_sport), avg(total_viewing_hours)) AS share
          FROM viewing_activity GROUP BY account_id) v USING (account_id)
        GROUP BY s.plan, s.region
        """
    )
    view = spark.sql(
        "SELECT plan, region, n_accounts, avg_affinity_sport FROM segment_genre_affinity"
    )
    ours = {(r[0], r[1]): (r[2], r[3]) for r in view.collect()}
    theirs = {(r[0], r[1]): (r[2], round(r[3], 3)) for r in twin.collect()}
    assert ours == theirs


def test_views_are_lazy(spark, base):
    broken = base[1].withColumn("total_viewing_hours", F.raise_error(F.lit("was read")).cast("double"))
    assert len(register_feature_views(base[0], broken, GENRES)) == 4
