"""Sources, projections, joins, aggregations, scalar functions and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    CHURN_PROBABILITY_SQL,
    EVENT_GENRES,
    EVENT_ROWS_SQL,
    HOUR_DIGITS,
    LINE_GENRES,
    PRICES,
    SUBSCRIBER_COLUMNS,
    TOP_PLAN,
    UPSELL_PROBABILITY_SQL,
    VECTOR_GENRES,
    event_activity,
    event_rows,
    half_away,
    line_activity,
    read,
    scored_orders,
    subscribers,
    vectors,
    with_tables,
)
from halyard import functions as H
from halyard.contract import (
    CHURN_VIEW_ACCOUNT_COLUMNS,
    SUBSCRIBERS,
    activity_schema,
    affinity_columns,
    viewing_columns,
)
from halyard.functions import scorecard
from halyard.operators import metrics, order_statistics, rollups, segments, targeting, training
from halyard.operators import viewing as V
from halyard.plans.views import register_feature_views
from halyard.sources import ranges, tables
from halyard.sources.workspace import workspace_path


def _viewing(spark: SparkSession, sf: str) -> DataFrame:
    return V.viewing_features(event_activity(spark, sf), EVENT_GENRES, digits=HOUR_DIGITS)


def _line_viewing(spark: SparkSession, sf: str) -> DataFrame:
    return V.viewing_features(line_activity(spark, sf), LINE_GENRES, digits=HOUR_DIGITS)


def _rounded(frame: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return frame.withColumns({c: H.round_half_away(F.col(c), digits) for c in columns})


ACTIVITY_COLUMNS = ", ".join(activity_schema(EVENT_GENRES).fieldNames())
VIEWING_COLUMNS = ", ".join(viewing_columns(EVENT_GENRES))
LINE_VIEWING_COLUMNS = ", ".join(viewing_columns(LINE_GENRES))
ACCOUNT_COLUMNS = ", ".join(f"s.{c}" for c in CHURN_VIEW_ACCOUNT_COLUMNS)
UPSELL_ACCOUNT_COLUMNS = ", ".join(
    f"s.{c}" for c in SUBSCRIBERS.fieldNames() if c not in training.HIDDEN_COLUMNS
)
CHURN_VIEW_SQL = (
    f"SELECT {ACCOUNT_COLUMNS}, {VIEWING_COLUMNS}, s.churned_next_60d AS label"
    " FROM subscribers s JOIN viewing v ON s.account_id = v.account_id"
)
UPSELL_VIEW_SQL = (
    f"SELECT {UPSELL_ACCOUNT_COLUMNS}, {VIEWING_COLUMNS}, s.accepted_upsell_offer AS label"
    " FROM subscribers s JOIN viewing v ON s.account_id = v.account_id"
)


def _rollup_sql(viewing: str, genres: tuple[str, ...]) -> str:
    averages = ", ".join(
        f"{half_away(f'avg({c})', 3)} AS avg_{c}" for c in affinity_columns(genres)
    )
    return (
        f"SELECT plan, region, {averages}, count(*) AS n_accounts FROM subscribers s"
        f" JOIN {viewing} v ON s.account_id = v.account_id GROUP BY plan, region"
    )


# --- sources and sinks ------------------------------------------------------


@query("read_csv", with_tables("subscribers") + f"SELECT {SUBSCRIBER_COLUMNS} FROM subscribers")
def read_csv(spark, sf):
    path = tables.write_csv(subscribers(spark, sf), workspace_path(spark, "subscribers-csv"))
    return tables.read_csv(spark, path, SUBSCRIBERS)


@query("write_csv", with_tables("activity") + f"SELECT {ACTIVITY_COLUMNS} FROM activity")
def write_csv(spark, sf):
    path = tables.write_csv(event_activity(spark, sf), workspace_path(spark, "activity-csv"))
    return tables.read_csv(spark, path, activity_schema(EVENT_GENRES))


@query("table_schema", with_tables("subscribers") + f"SELECT {SUBSCRIBER_COLUMNS} FROM subscribers")
def table_schema(spark, sf):
    untyped = subscribers(spark, sf)
    untyped = untyped.select(*[F.col(c).cast("string").alias(c) for c in reversed(untyped.columns)])
    return tables.conform(untyped, SUBSCRIBERS)


@query(
    "ensure_database",
    with_tables("subscribers", "activity")
    + "SELECT 'subscribers' AS table_name, count(*) AS n_rows FROM subscribers"
    " UNION ALL SELECT 'viewing_activity', count(*) FROM activity",
)
def ensure_database(spark, sf):
    place = workspace_path(spark, "database")
    for name in ("halyard_raw", "halyard_features"):
        tables.ensure_database(spark, name, f"{place}/{name}")
        tables.ensure_database(spark, name)
    declared = {
        "subscribers": (subscribers(spark, sf), SUBSCRIBERS),
        "viewing_activity": (event_activity(spark, sf), activity_schema(EVENT_GENRES)),
    }
    counts = []
    for name, (frame, schema) in declared.items():
        table = f"halyard_raw.{name}"
        tables.ensure_table(spark, table, schema, f"{place}/{name}")
        tables.load_table(frame, table, schema)
        stored = tables.scan_view(spark, table).agg(F.count("*").alias("n_rows"))
        counts.append(stored.select(F.lit(name).alias("table_name"), "n_rows"))
    return reduce(DataFrame.unionByName, counts)


_BUCKET_SQL = (
    "SELECT CAST(greatest(0, least(11, floor((o_orderkey - 0) / 1000e0) + 1)) AS BIGINT)"
    " AS account_bucket, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key"
    " FROM orders GROUP BY 1"
)


@query("range_partitioned_write", _BUCKET_SQL)
def range_partitioned_write(spark, sf):
    path = workspace_path(spark, "orders-by-range")
    ranges.write_by_range(read(spark, sf, "orders"), path, "o_orderkey", 0, 10_000, 10)
    stored = ranges.read_account_range(spark, path, key="o_orderkey", low=0, high=10_000, count=10)
    return stored.groupBy(F.col("account_bucket").cast("bigint").alias("account_bucket")).agg(
        F.count("*").alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query(
    "range_table",
    "SELECT o_orderkey, o_totalprice, CAST(floor(o_orderkey / 1000e0) + 1 AS BIGINT) AS account_bucket"
    " FROM orders WHERE o_orderkey BETWEEN 700 AND 1300",
)
def range_table(spark, sf):
    """A catalogue table partitioned by ranges of its key, filled twice and read by key."""
    orders = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    place = workspace_path(spark, "range-table")
    tables.ensure_database(spark, "halyard_ranges")
    name = f"halyard_ranges.orders_{place.rsplit('-', 1)[1]}"
    keys = ranges.KeyRanges("o_orderkey", 0, 10_000, 10)
    for odd in (0, 1):
        ranges.ensure_range_table(spark, name, orders.schema, keys, place)
        ranges.load_range_table(orders.where(F.col("o_orderkey") % 2 == odd), name)
    found = ranges.read_range_table(spark, name, 700, 1_300)
    return found.select("o_orderkey", "o_totalprice", "account_bucket")


@query("width_bucket", _BUCKET_SQL)
def width_bucket(spark, sf):
    bucketed = ranges.with_range_bucket(read(spark, sf, "orders"), "o_orderkey", 0, 10_000, 10)
    return bucketed.groupBy("account_bucket").agg(
        F.count("*").alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query("scan_view", with_tables("subscribers", "viewing") + CHURN_VIEW_SQL)
def scan_view(spark, sf):
    register_feature_views(
        subscribers(spark, sf), event_activity(spark, sf), EVENT_GENRES, HOUR_DIGITS
    )
    return tables.scan_view(spark, "churn_training_view")


@query("materialise_parquet", with_tables("subscribers", "viewing") + CHURN_VIEW_SQL)
def materialise_parquet(spark, sf):
    return tables.materialise(
        churn_training_view(spark, sf), workspace_path(spark, "churn-training")
    )


@query(
    "register_views",
    with_tables("subscribers", "viewing")
    + f"SELECT r.plan, count(*) AS n, {half_away('avg(avg_total_viewing_hours)', 4)} AS hours,"
    " sum(label) AS churned FROM (" + CHURN_VIEW_SQL + ") r GROUP BY r.plan",
)
def register_views(spark, sf):
    register_feature_views(
        subscribers(spark, sf), event_activity(spark, sf), EVENT_GENRES, HOUR_DIGITS
    )
    by_plan = spark.sql(
        "SELECT plan, count(*) AS n, avg(avg_total_viewing_hours) AS hours, sum(label) AS churned"
        " FROM churn_training_view GROUP BY plan"
    )
    return _rounded(by_plan, ["hours"], 4)


_PROFILE_SQL_INNER = (
    "SELECT segment, "
    + ", ".join(f"{half_away(f'avg({c})', 3)} AS {c}" for c in affinity_columns(VECTOR_GENRES))
    + ", count(*) AS n_accounts FROM vectors GROUP BY segment"
)
_DOMINANT_CASE = (
    "CASE greatest(" + ", ".join(affinity_columns(VECTOR_GENRES)) + ") "
    + " ".join(f"WHEN affinity_{g} THEN '{g}'" for g in VECTOR_GENRES)
    + " END"
)
PROFILE_SQL = with_tables("vectors", profile=_PROFILE_SQL_INNER) + (
    f"SELECT *, {_DOMINANT_CASE} AS dominant_genre FROM profile"
)


@query("read_reports", PROFILE_SQL)
def read_reports(spark, sf):
    profile = segments.segment_profile(vectors(spark, sf), VECTOR_GENRES)
    path = tables.write_csv(profile, workspace_path(spark, "segment-report"))
    return tables.read_report_csv(spark, path, profile.schema)


# --- projections and filters ------------------------------------------------


@query(
    "project",
    with_tables("viewing")
    + "SELECT account_id, avg_total_viewing_hours AS hours, viewing_trend_3mo AS trend FROM viewing",
)
def project(spark, sf):
    return _viewing(spark, sf).select(
        "account_id",
        F.col("avg_total_viewing_hours").alias("hours"),
        F.col("viewing_trend_3mo").alias("trend"),
    )


@query(
    "star_except",
    with_tables("subscribers")
    + "SELECT * EXCLUDE (churn_probability_true, upsell_probability_true, churned_next_60d,"
    " accepted_upsell_offer) FROM subscribers",
)
def star_except(spark, sf):
    return training.drop_columns(subscribers(spark, sf), training.HIDDEN_COLUMNS)


@query(
    "rename_label",
    with_tables("subscribers") + "SELECT account_id, churned_next_60d AS label FROM subscribers",
)
def rename_label(spark, sf):
    labelled = training.with_label(subscribers(spark, sf), "churned_next_60d")
    return labelled.select("account_id", "label")


@query(
    "eligible_accounts",
    with_tables("subscribers")
    + f"SELECT account_id, plan FROM subscribers WHERE plan IS DISTINCT FROM '{TOP_PLAN}'",
)
def eligible_accounts(spark, sf):
    return training.eligible_accounts(subscribers(spark, sf), TOP_PLAN).select("account_id", "plan")


@query(
    "drop_null_affinity",
    with_tables("viewing")
    + "SELECT account_id, affinity_click FROM (SELECT s.c_custkey AS account_id, v.* EXCLUDE"
    " (account_id) FROM customer s LEFT JOIN viewing v ON s.c_custkey = v.account_id) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in affinity_columns(EVENT_GENRES)),
)
def drop_null_affinity(spark, sf):
    accounts = read(spark, sf, "customer").select(F.col("c_custkey").alias("account_id"))
    everyone = accounts.join(_viewing(spark, sf), "account_id", "left")
    return training.drop_null_affinity(everyone, EVENT_GENRES).select(
        "account_id", "affinity_click"
    )


@query(
    "columns_by_exclusion",
    with_tables("subscribers", "viewing")
    + "SELECT * EXCLUDE (plan, region, primary_device, contract_type, account_id, label) FROM ("
    + CHURN_VIEW_SQL
    + ")",
)
def columns_by_exclusion(spark, sf):
    view = churn_training_view(spark, sf)
    return view.select(*training.columns_except(view))


@query(
    "columns_by_prefix",
    with_tables("viewing")
    + "SELECT account_id, " + ", ".join(affinity_columns(EVENT_GENRES)) + " FROM viewing",
)
def columns_by_prefix(spark, sf):
    view = _viewing(spark, sf)
    return view.select("account_id", *training.columns_with_prefix(view, "affinity_"))


@query("leakage_guard", with_tables("subscribers", "viewing") + UPSELL_VIEW_SQL)
def leakage_guard(spark, sf):
    return training.leakage_guard(upsell_training_view(spark, sf))


@query(
    "score_mask",
    with_tables("scored_orders")
    + "SELECT account_id, score FROM scored_orders"
    " WHERE score >= (SELECT quantile_cont(score, 0.9) FROM scored_orders)",
)
def score_mask(spark, sf):
    scored = scored_orders(spark, sf)
    threshold = order_statistics.quantile(scored, "score", 0.9)
    return metrics.at_or_above(scored, threshold.scalar()).select("account_id", "score")


@query(
    "ordered_key_output",
    with_tables("viewing") + f"SELECT account_id, {VIEWING_COLUMNS} FROM viewing",
)
def ordered_key_output(spark, sf):
    return _viewing(spark, sf)


@query(
    "risk_flags",
    with_tables("subscribers")
    + "SELECT account_id, CAST(months_since_last_price_rise <= 2 AS BIGINT) AS recent_price_rise,"
    " CAST(months_to_contract_end <= 0 AS BIGINT) AS out_of_contract,"
    f" CAST(plan = '{TOP_PLAN}' AS BIGINT) AS on_top_plan FROM subscribers",
)
def risk_flags(spark, sf):
    return scorecard.risk_flags(subscribers(spark, sf), TOP_PLAN)


# --- joins ------------------------------------------------------------------


@query("churn_training_view", with_tables("subscribers", "viewing") + CHURN_VIEW_SQL)
def churn_training_view(spark, sf):
    return training.churn_training_view(subscribers(spark, sf), _viewing(spark, sf), EVENT_GENRES)


@query("upsell_training_view", with_tables("subscribers", "viewing") + UPSELL_VIEW_SQL)
def upsell_training_view(spark, sf):
    return training.upsell_training_view(subscribers(spark, sf), _viewing(spark, sf), EVENT_GENRES)


@query(
    "segment_genre_affinity",
    with_tables("subscribers", "viewing") + _rollup_sql("viewing", EVENT_GENRES),
)
def segment_genre_affinity(spark, sf):
    return rollups.segment_genre_affinity(
        subscribers(spark, sf), _viewing(spark, sf), EVENT_GENRES
    )


@query(
    "segment_genre_affinity_lines",
    with_tables("subscribers", "line_viewing") + _rollup_sql("line_viewing", LINE_GENRES),
)
def segment_genre_affinity_lines(spark, sf):
    return rollups.segment_genre_affinity(
        subscribers(spark, sf), _line_viewing(spark, sf), LINE_GENRES
    )


@query(
    "plan_price_lookup",
    "SELECT c_custkey AS account_id, CASE c_mktsegment "
    + " ".join(f"WHEN '{p}' THEN {v}e0" for p, v in PRICES.items())
    + " END AS price FROM customer",
)
def plan_price_lookup(spark, sf):
    plans = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("plan")
    )
    return training.with_base_price(plans, PRICES, "price").select("account_id", "price")


# --- aggregations -----------------------------------------------------------


def _month_sql(k: int, otherwise: str) -> str:
    return (
        f"CAST(sum(CASE WHEN months_ago = {k} THEN CAST(total_viewing_hours AS DECIMAL(18,2))"
        f" {otherwise} END) AS DOUBLE)"
    )


@query(
    "conditional_sum_pivot",
    with_tables("activity")
    + f"SELECT account_id, {_month_sql(0, 'ELSE 0')} AS hrs_month_current,"
    f" {_month_sql(1, 'ELSE 0')} AS hrs_month_minus1, {_month_sql(2, 'ELSE 0')} AS hrs_month_minus2"
    " FROM activity GROUP BY account_id",
)
def conditional_sum_pivot(spark, sf):
    return V.month_totals(event_activity(spark, sf), digits=HOUR_DIGITS)


@query(
    "pivot_months",
    with_tables("line_activity")
    + f"SELECT account_id, {_month_sql(0, '')} AS hrs_month_current,"
    f" {_month_sql(1, '')} AS hrs_month_minus1, {_month_sql(2, '')} AS hrs_month_minus2"
    " FROM line_activity GROUP BY account_id",
)
def pivot_months(spark, sf):
    return V.month_totals(line_activity(spark, sf), missing_month="null", digits=HOUR_DIGITS)


@query(
    "viewing_averages",
    with_tables("activity")
    + "SELECT account_id, "
    + ", ".join(
        f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}) AS {a}"
        for c, a in [(f"hrs_{g}", f"avg_hrs_{g}") for g in EVENT_GENRES]
        + [("total_viewing_hours", "avg_total_viewing_hours")]
    )
    + " FROM activity GROUP BY account_id",
)
def viewing_averages(spark, sf):
    return V.viewing_averages(event_activity(spark, sf), EVENT_GENRES, HOUR_DIGITS)


@query(
    "viewing_features",
    with_tables("viewing") + f"SELECT account_id, {VIEWING_COLUMNS} FROM viewing",
)
def viewing_features(spark, sf):
    return _viewing(spark, sf)


@query(
    "viewing_features_lines",
    with_tables("line_viewing") + f"SELECT account_id, {LINE_VIEWING_COLUMNS} FROM line_viewing",
)
def viewing_features_lines(spark, sf):
    return _line_viewing(spark, sf)


@query(
    "base_rate",
    with_tables("subscribers") + "SELECT avg(churned_next_60d) AS base_rate FROM subscribers",
)
def base_rate(spark, sf):
    return rollups.base_rate(subscribers(spark, sf), "churned_next_60d")


_RATE_SQL = "SELECT plan, avg({0}) AS rate FROM subscribers GROUP BY plan"


@query("rate_by_plan", with_tables("subscribers") + _RATE_SQL.format("churned_next_60d"))
def rate_by_plan(spark, sf):
    return rollups.rate_by_plan(subscribers(spark, sf))


def _written(spark: SparkSession, report: DataFrame) -> DataFrame:
    """A sorted report as it stands in its files, with the place of every row."""
    path = tables.write_csv(report, workspace_path(spark, "report"))
    return tables.read_report_in_order(spark, path, report.schema)


def _placed_sql(report: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({report})"


_PLACED_RATE_SQL = with_tables("subscribers") + _placed_sql(_RATE_SQL, "rate, plan NULLS FIRST")


@query("report_plan_churn", _PLACED_RATE_SQL.format("churned_next_60d"))
def report_plan_churn(spark, sf):
    return _written(spark, rollups.rate_by_plan(subscribers(spark, sf)))


@query("sorted_rates", _PLACED_RATE_SQL.format("accepted_upsell_offer"))
def sorted_rates(spark, sf):
    return _written(spark, rollups.rate_by_plan(subscribers(spark, sf), "accepted_upsell_offer"))


_MIX_SQL = (
    "SELECT c_mktsegment AS plan, count(*) AS n_accounts FROM customer"
    " WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment"
)


@query("plan_mix", _MIX_SQL)
def plan_mix(spark, sf):
    return rollups.plan_mix(subscribers(spark, sf))


@query("report_plan_mix", _placed_sql(_MIX_SQL, "n_accounts DESC, plan"))
def report_plan_mix(spark, sf):
    return _written(spark, rollups.plan_mix(subscribers(spark, sf)))


@query(
    "median_tenure",
    with_tables("subscribers")
    + "SELECT median(tenure_months) AS median_tenure_months FROM subscribers",
)
def median_tenure(spark, sf):
    return rollups.median(subscribers(spark, sf), "tenure_months")


@query(
    "report_base_rates",
    with_tables("subscribers")
    + "SELECT avg(churned_next_60d) AS churn_rate, avg(accepted_upsell_offer) AS upsell_rate,"
    " median(tenure_months) AS median_tenure_months FROM subscribers",
)
def report_base_rates(spark, sf):
    return rollups.base_rates_report(subscribers(spark, sf))


@query(
    "zscore",
    f"SELECT c_custkey AS account_id, {half_away('(c_acctbal - m) / s', 6)} AS balance_z"
    " FROM customer, (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)",
)
def zscore(spark, sf):
    customers = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_acctbal").alias("balance")
    )
    scaled = order_statistics.zscore(customers, ["balance"]).select("account_id", "balance_z")
    return _rounded(scaled, ["balance_z"], 6)


@query(
    "standardise",
    with_tables("vectors")
    + "SELECT account_id, "
    + ", ".join(
        half_away(
            f"({c} - (SELECT avg({c}) FROM vectors))"
            f" / coalesce(nullif((SELECT stddev_pop({c}) FROM vectors), 0), 1)",
            6,
        )
        + f" AS {c}_scaled"
        for c in affinity_columns(VECTOR_GENRES)
    )
    + " FROM vectors",
)
def standardise(spark, sf):
    columns = affinity_columns(VECTOR_GENRES)
    scaled = [f"{c}_scaled" for c in columns]
    frame = order_statistics.standardise(vectors(spark, sf), columns).select("account_id", *scaled)
    return _rounded(frame, scaled, 6)


@query(
    "quantile_threshold",
    f"SELECT {half_away('quantile_cont(o_totalprice, 0.9)', 4)} AS threshold FROM orders",
)
def quantile_threshold(spark, sf):
    found = order_statistics.quantile(read(spark, sf, "orders"), "o_totalprice", 0.9, "threshold")
    return _rounded(found, ["threshold"], 4)


@query(
    "dominant_genre",
    with_tables("viewing")
    + "SELECT account_id, CASE greatest("
    + ", ".join(affinity_columns(EVENT_GENRES))
    + ") "
    + " ".join(f"WHEN affinity_{g} THEN '{g}'" for g in EVENT_GENRES)
    + " END AS dominant_genre FROM viewing",
)
def dominant_genre(spark, sf):
    return segments.dominant_genre(_viewing(spark, sf), EVENT_GENRES).select(
        "account_id", "dominant_genre"
    )


@query(
    "best_candidate",
    with_tables("viewing")
    + "SELECT genre, share FROM ("
    + " UNION ALL ".join(
        f"SELECT '{g}' AS genre, {half_away(f'avg(affinity_{g})', 4)} AS share FROM viewing"
        for g in EVENT_GENRES
    )
    + ") ORDER BY share DESC, genre LIMIT 1",
)
def best_candidate(spark, sf):
    means = _viewing(spark, sf).agg(
        *[
            H.round_half_away(F.avg(c), 4).alias(c) for c in affinity_columns(EVENT_GENRES)
        ]
    ).withColumn("segment", F.lit("all"))
    candidates = rollups.affinity_long(means, genres=EVENT_GENRES).select("genre", "share")
    return targeting.best_candidate(candidates, "share", "genre")


@query("frame_counts", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def frame_counts(spark, sf):
    return rollups.frame_counts(read(spark, sf, "lineitem"))


@query(
    "key_uniqueness",
    f"SELECT account_id, months_ago, count(*) AS n_rows FROM ({EVENT_ROWS_SQL})"
    " GROUP BY account_id, months_ago HAVING count(*) > 1",
)
def key_uniqueness(spark, sf):
    return V.key_violations(event_rows(spark, sf))


@query(
    "affinity_index",
    with_tables("subscribers", "line_viewing")
    + "SELECT plan, "
    + ", ".join(
        half_away(
            f"avg({c}) / nullif((SELECT avg(l.{c}) FROM line_viewing l JOIN subscribers t"
            " ON l.account_id = t.account_id), 0)",
            6,
        )
        + f" AS index_{c}"
        for c in affinity_columns(LINE_GENRES)
    )
    + " FROM subscribers s JOIN line_viewing v ON s.account_id = v.account_id GROUP BY plan",
)
def affinity_index(spark, sf):
    plans = subscribers(spark, sf).select("account_id", "plan")
    joined = plans.join(_line_viewing(spark, sf), "account_id")
    index = rollups.affinity_index(joined, "plan", LINE_GENRES)
    return _rounded(index, index.columns[1:], 6)


@query(
    "union_months",
    with_tables("activity") + f"SELECT {ACTIVITY_COLUMNS} FROM activity",
)
def union_months(spark, sf):
    activity = event_activity(spark, sf)
    month = F.col("months_ago")
    extracts = [activity.where(month == m) for m in (2, 1, 0)]
    others = activity.where(month.isNull() | ~month.isin(2, 1, 0))
    return V.union_months(*extracts, others)


# --- scalar functions -------------------------------------------------------


@query(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) AS ratio FROM lineitem",
)
def safe_divide(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        H.safe_divide(F.col("l_extendedprice"), F.col("l_tax")).alias("ratio"),
    )


@query(
    "viewing_trend_3mo",
    with_tables("line_viewing") + "SELECT account_id, viewing_trend_3mo FROM line_viewing",
)
def viewing_trend_3mo(spark, sf):
    totals = V.month_totals(line_activity(spark, sf), months=(0, 2), digits=HOUR_DIGITS)
    trend = V.trend(F.col("hrs_month_current"), F.col("hrs_month_minus2"))
    return totals.select("account_id", trend.alias("viewing_trend_3mo"))


@query(
    "genre_shares",
    with_tables("line_viewing")
    + "SELECT account_id, " + ", ".join(affinity_columns(LINE_GENRES)) + " FROM line_viewing",
)
def genre_shares(spark, sf):
    averages = V.viewing_averages(line_activity(spark, sf), LINE_GENRES, HOUR_DIGITS)
    return V.genre_shares(averages, LINE_GENRES)


@query(
    "if_null_zero_to_null",
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount,"
    " CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0e0 END AS returned FROM lineitem",
)
def if_null_zero_to_null(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        H.null_if_zero(F.col("l_discount")).alias("discount"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0).alias("returned"),
    )


@query(
    "round_half_up",
    "SELECT l_orderkey, l_linenumber, "
    + half_away("l_extendedprice * (1 - l_discount)", 2)
    + " AS price, "
    + half_away("-l_quantity / 16", 3)
    + " AS part FROM lineitem",
)
def round_half_up(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        H.round_half_away(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("price"),
        H.round_half_away(-F.col("l_quantity") / 16, 3).alias("part"),
    )


@query(
    "strip_prefix",
    with_tables("viewing")
    + " UNION ALL ".join(
        f"SELECT account_id, '{g}' AS genre, affinity_{g} AS share FROM viewing"
        for g in EVENT_GENRES
    ),
)
def strip_prefix(spark, sf):
    columns = affinity_columns(EVENT_GENRES)
    long = _viewing(spark, sf).unpivot(["account_id"], columns, "genre", "share")
    return long.withColumn("genre", H.strip_prefix(F.col("genre"), "affinity_"))


@query(
    "bool_to_int",
    "SELECT o_orderkey, CAST(coalesce(o_totalprice >= 250000, FALSE) AS BIGINT) AS is_large"
    " FROM orders",
)
def bool_to_int(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", H.flag(F.col("o_totalprice") >= 250_000).alias("is_large")
    )


@query(
    "clip",
    "SELECT c_custkey, least(greatest(c_acctbal, 0e0), 5000e0) AS balance FROM customer",
)
def clip(spark, sf):
    return read(spark, sf, "customer").select(
        "c_custkey", H.clip(F.col("c_acctbal"), 0.0, 5000.0).alias("balance")
    )


@query(
    "log1p_exp_sigmoid",
    f"SELECT l_orderkey, l_linenumber, {half_away('ln(1 + l_quantity)', 4)} AS log_quantity, "
    + half_away("1e0 / (1e0 + exp(-(l_quantity - 25) / 4))", 4)
    + " AS probability FROM lineitem",
)
def log1p_exp_sigmoid(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        H.round_half_away(F.log1p("l_quantity"), 4).alias("log_quantity"),
        H.round_half_away(H.sigmoid((F.col("l_quantity") - 25) / 4), 4).alias("probability"),
    )


_ENGAGED_SQL = (
    "SELECT s.*, (v.avg_total_viewing_hours - avg(v.avg_total_viewing_hours) OVER ())"
    " / stddev_pop(v.avg_total_viewing_hours) OVER () AS z"
    " FROM subscribers s JOIN line_viewing v ON s.account_id = v.account_id"
)


def _engaged(spark: SparkSession, sf: str) -> DataFrame:
    hours = _line_viewing(spark, sf).select("account_id", "avg_total_viewing_hours")
    joined = subscribers(spark, sf).join(hours, "account_id")
    return order_statistics.zscore(joined, ["avg_total_viewing_hours"], suffix="_z")


@query(
    "churn_scorecard",
    with_tables("subscribers", "line_viewing", engaged=_ENGAGED_SQL)
    + f"SELECT account_id, {CHURN_PROBABILITY_SQL} AS churn_probability FROM engaged",
)
def churn_scorecard(spark, sf):
    return _engaged(spark, sf).select(
        "account_id",
        H.churn_scorecard(F.col("avg_total_viewing_hours_z")).alias("churn_probability"),
    )


@query(
    "upsell_scorecard",
    with_tables("subscribers", "line_viewing", engaged=_ENGAGED_SQL)
    + f"SELECT account_id, {UPSELL_PROBABILITY_SQL} AS upsell_probability FROM engaged",
)
def upsell_scorecard(spark, sf):
    return _engaged(spark, sf).select(
        "account_id",
        H.upsell_scorecard(F.col("avg_total_viewing_hours_z"), TOP_PLAN).alias(
            "upsell_probability"
        ),
    )


# --- reports ----------------------------------------------------------------


@query(
    "report_affinity_long",
    with_tables("vectors", profile=_PROFILE_SQL_INNER)
    + " UNION ALL ".join(
        f"SELECT segment, '{g}' AS genre, affinity_{g} AS share FROM profile"
        for g in VECTOR_GENRES
    ),
)
def report_affinity_long(spark, sf):
    profile = segments.segment_profile(vectors(spark, sf), VECTOR_GENRES)
    return rollups.affinity_long(profile, genres=VECTOR_GENRES)


@query("segment_profile", PROFILE_SQL)
def segment_profile(spark, sf):
    return segments.segment_profile(vectors(spark, sf), VECTOR_GENRES)
