"""The generated tables, mapped onto the subscriber and activity contract.

Each mapping exists twice: as DataFrames for Spark and as SQL text for DuckDB. The base tables
(subscribers and activity) are stored once per application, as they would be in production; every
query computes its own features from them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.contract import SUBSCRIBERS, activity_schema
from halyard.functions import churn_scorecard, exact_sum, flag, round_half_away, upsell_scorecard
from halyard.functions.scorecard import CHURN_WEIGHTS, UPSELL_WEIGHTS
from halyard.operators.order_statistics import zscore
from halyard.operators.training import with_base_price
from halyard.sources.tables import conform, materialise
from halyard.sources.workspace import workspace_path

TOP_PLAN = "AUTOMOBILE"
PRICES = {
    "BUILDING": 15.0,
    "FURNITURE": 26.0,
    "HOUSEHOLD": 36.0,
    "MACHINERY": 46.0,
    "AUTOMOBILE": 65.0,
}
EVENT_GENRES = ("click", "error", "purchase", "signup", "view")
LINE_GENRES = ("A", "N", "R")
CUT = "2000-08-01"
HOUR_DIGITS = 2


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "region": "r_regionkey int, r_name string",
}


_stored: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Share what ``make`` gives between the queries of one Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def stored(mapping: Callable[[SparkSession, str], DataFrame]):
    """Make a mapping a base table: stored on first use, as the tables of a warehouse are."""

    @wraps(mapping)
    def table(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make() -> DataFrame:
            return materialise(mapping(spark, sf_dir), workspace_path(spark, mapping.__name__))

        return once(spark, sf_dir, mapping.__name__, make)

    return table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table with its declared schema: no job to infer one from file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# --- Spark ------------------------------------------------------------------


def _monthly(rows: DataFrame, genres: tuple[str, ...]) -> DataFrame:
    """(account_id, months_ago, genre, hours) rows to one row per account and month."""
    monthly = rows.groupBy("account_id", "months_ago").agg(
        *[
            exact_sum(F.when(F.col("genre") == g, F.col("hours")).otherwise(0.0), 2).alias(f"hrs_{g}")
            for g in genres
        ],
        exact_sum(F.col("hours"), 2).alias("total_viewing_hours"),
    )
    return conform(monthly, activity_schema(genres))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as (account_id, months_ago, genre, hours): thirty days are three ten-day months."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_id"),
        F.expr("cast(datediff(date'2024-01-30', to_date(ts)) div 10 as bigint)").alias("months_ago"),
        F.col("event_type").alias("genre"),
        F.col("value").alias("hours"),
    )


@stored
def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(event_rows(spark, sf_dir), EVENT_GENRES)


@stored
def line_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as activity of the ordering customer; this is the large one."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", "l_shipdate"
    )
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("account_id"),
        F.expr(
            "cast(least(greatest(datediff(date'2001-11-04', to_date(l_shipdate)) div 834, 0), 2)"
            " as bigint)"
        ).alias("months_ago"),
        F.col("l_returnflag").alias("genre"),
        F.col("l_quantity").alias("hours"),
    )
    return _monthly(rows, LINE_GENRES)


def _order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.col("o_orderdate") < F.expr(f"timestamp_ntz'{CUT}'")
    date = F.to_date("o_orderdate")
    return (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min(F.when(before, date)).alias("first_before"),
            F.max(F.when(before, date)).alias("last_before"),
            F.count_if(before).alias("n_before"),
            F.max_by(
                "o_orderpriority",
                F.when(before, F.struct(F.col("o_orderdate"), F.col("o_orderkey"))),
            ).alias("last_priority"),
            F.count_if(~before).alias("n_after"),
            exact_sum(F.when(~before, F.col("o_totalprice")), 2).alias("after_total"),
        )
    )


def _base_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _order_history(spark, sf_dir)
    average_after = history.agg(F.avg("after_total")).scalar()
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customers = read(spark, sf_dir, "customer")
    joined = (
        customers.join(history, customers.c_custkey == history.o_custkey, "left")
        .join(places, customers.c_nationkey == places.n_nationkey, "inner")
        .withColumn("plan", F.col("c_mktsegment"))
    )
    months_since_first = F.expr(f"datediff(date'{CUT}', first_before) div 30")
    months_since_last = F.expr(f"datediff(date'{CUT}', last_before) div 30")
    key = F.col("c_custkey")
    return with_base_price(joined, PRICES).select(
        key.alias("account_id"),
        F.greatest(F.coalesce(months_since_first, F.lit(1)), F.lit(1)).alias("tenure_months"),
        "plan",
        "base_monthly_price_gbp",
        round_half_away(F.abs("c_acctbal") / 100, 2).alias("current_monthly_price_gbp"),
        F.least(F.coalesce("n_before", F.lit(0)), F.lit(6)).alias("n_price_rises_since_joining"),
        F.least(F.coalesce(months_since_last, F.lit(14)), F.lit(14)).alias(
            "months_since_last_price_rise"
        ),
        F.col("r_name").alias("region"),
        F.col("last_priority").alias("primary_device"),
        (key % 5 + 1).alias("num_devices_registered"),
        (F.col("c_nationkey") % 5 + 1).alias("household_size_est"),
        F.when(key % 2 == 0, "rolling_monthly").otherwise("18mo_contract").alias("contract_type"),
        F.when(key % 2 == 0, F.lit(0)).otherwise(key % 22 - 3).alias("months_to_contract_end"),
        (key % 6).alias("support_contacts_last_90d"),
        flag(key % 17 == 0).alias("billing_dispute_last_90d"),
        flag(key % 11 == 0).alias("outage_reported_last_90d"),
        (key % 11).alias("nps_last_survey"),
        ((key * 7919 % 1000) / F.lit(1000.0)).alias("competitor_ad_exposure_score"),
        F.coalesce("n_before", F.lit(0)).alias("engagement"),
        flag(F.coalesce("n_after", F.lit(0)) == 0).alias("churned_next_60d"),
        flag(F.col("after_total") > average_after).alias("accepted_upsell_offer"),
    )


@stored
def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as subscribers. Engagement of the scorecards is the number of early orders."""
    accounts = zscore(_base_accounts(spark, sf_dir), ["engagement"])
    scored = accounts.withColumns(
        {
            "churn_probability_true": churn_scorecard(F.col("engagement_z")),
            "upsell_probability_true": upsell_scorecard(F.col("engagement_z"), TOP_PLAN),
        }
    )
    return conform(scored, SUBSCRIBERS, allow_extra=True)


@stored
def planted_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers whose labels follow the scorecards, with about 6% of them flipped."""
    base = subscribers(spark, sf_dir)
    noise = F.substring(F.md5(F.concat(F.col("account_id").cast("string"), F.lit(":noise"))), 1, 1)

    def planted(probability: str):
        limits = base.agg((F.avg(probability) + F.stddev_pop(probability)).alias("limit"))
        signal = F.col(probability) >= limits.scalar()
        return F.when(noise == "0", flag(~signal)).otherwise(flag(signal))

    return base.withColumns(
        {
            "churned_next_60d": planted("churn_probability_true"),
            "accepted_upsell_offer": planted("upsell_probability_true"),
        }
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with many ties: document labels."""
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("account_id"),
        ((F.col("doc_id") * 7919 % 101) / F.lit(101.0)).alias("score"),
        F.col("quality").cast("bigint").alias("label"),
    )


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores without order in them: a hash of the order key."""
    digits = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8)
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account_id"),
        (F.conv(digits, 16, 10).cast("bigint") / F.lit(4294967296.0)).alias("score"),
        flag(F.col("o_orderstatus") == "F").alias("label"),
    )


VECTOR_GENRES = tuple(f"d{i}" for i in range(64))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions of the embeddings as shares, their label as a fixed segment."""
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("account_id"),
        *[
            F.col("embedding")[i].cast("double").alias(f"affinity_{g}")
            for i, g in enumerate(VECTOR_GENRES)
        ],
        F.col("label").alias("segment"),
    )


# --- SQL --------------------------------------------------------------------


def half_away(expression: str, digits: int) -> str:
    return f"(sign({expression}) * floor(abs({expression}) * 1e{digits} + 0.5) / 1e{digits} + 0e0)"


def _monthly_sql(rows: str, genres: tuple[str, ...]) -> str:
    hours = "".join(
        f"CAST(sum(CASE WHEN genre = '{g}' THEN CAST(hours AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)"
        f" AS hrs_{g}, "
        for g in genres
    )
    return (
        f"SELECT account_id, months_ago, {hours}"
        "CAST(sum(CAST(hours AS DECIMAL(18,2))) AS DOUBLE) AS total_viewing_hours"
        f" FROM ({rows}) GROUP BY account_id, months_ago"
    )


EVENT_ROWS_SQL = (
    "SELECT user_id AS account_id,"
    " CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') // 10 AS BIGINT) AS months_ago,"
    " event_type AS genre, value AS hours FROM events"
)
LINE_ROWS_SQL = (
    "SELECT o_custkey AS account_id,"
    " CAST(least(greatest(date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-04') // 834, 0),"
    " 2) AS BIGINT) AS months_ago, l_returnflag AS genre, l_quantity AS hours"
    " FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)


def _features_sql(activity: str, genres: tuple[str, ...]) -> str:
    averages = "".join(f"avg_hrs_{g} / nullif(avg_total, 0) AS affinity_{g}, " for g in genres)
    inner = "".join(
        f"CAST(sum(CAST(hrs_{g} AS DECIMAL(18,2))) AS DOUBLE) / count(hrs_{g}) AS avg_hrs_{g}, "
        for g in genres
    )

    def month(k: int) -> str:
        return (
            f"CAST(sum(CASE WHEN months_ago = {k} THEN CAST(total_viewing_hours AS DECIMAL(18,2))"
            " ELSE 0 END) AS DOUBLE)"
        )

    return (
        "SELECT account_id, avg_total AS avg_total_viewing_hours,"
        f" (m0 - m2) / nullif(m2, 0) AS viewing_trend_3mo, {averages.rstrip(', ')} FROM ("
        f"SELECT account_id, {month(0)} AS m0, {month(2)} AS m2, {inner}"
        "CAST(sum(CAST(total_viewing_hours AS DECIMAL(18,2))) AS DOUBLE)"
        " / count(total_viewing_hours) AS avg_total"
        f" FROM {activity} GROUP BY account_id)"
    )


def _churn_logit_sql() -> str:
    w = CHURN_WEIGHTS
    return (
        f"{w['intercept']}e0 + {w['engagement_z']}e0 * z"
        f" + {w['recent_price_rise']}e0 * CASE WHEN months_since_last_price_rise <= 2 THEN 1 ELSE 0 END"
        f" + {w['out_of_contract']}e0 * CASE WHEN months_to_contract_end <= 0 THEN 1 ELSE 0 END"
        f" + {w['support_contacts']}e0 * least(greatest(support_contacts_last_90d, 0), 4)"
        f" + {w['billing_dispute']}e0 * billing_dispute_last_90d"
        f" + {w['outage']}e0 * outage_reported_last_90d"
        f" + {w['nps']}e0 * nps_last_survey"
        f" + {w['competitor_exposure']}e0 * competitor_ad_exposure_score"
        f" + {w['log_tenure']}e0 * ln(1 + tenure_months)"
        f" + {w['price']}e0 * current_monthly_price_gbp"
    )


def _upsell_logit_sql() -> str:
    w = UPSELL_WEIGHTS
    return (
        f"{w['intercept']}e0 + {w['engagement_z']}e0 * z"
        f" + {w['top_plan']}e0 * CASE WHEN plan = '{TOP_PLAN}' THEN 1 ELSE 0 END"
        f" + {w['devices']}e0 * num_devices_registered"
        f" + {w['nps']}e0 * nps_last_survey"
    )


def probability_sql(logit: str) -> str:
    return half_away(f"(1e0 / (1e0 + exp(-({logit}))))", 4)


CHURN_PROBABILITY_SQL = probability_sql(_churn_logit_sql())
UPSELL_PROBABILITY_SQL = probability_sql(_upsell_logit_sql())

_PRICE_SQL = (
    "CASE c_mktsegment " + " ".join(f"WHEN '{p}' THEN {v}e0" for p, v in PRICES.items()) + " END"
)

SUBSCRIBER_COLUMNS = ", ".join(SUBSCRIBERS.fieldNames())

CTES = {
    "history": f"""
SELECT o_custkey,
  min(CASE WHEN early THEN CAST(o_orderdate AS DATE) END) AS first_before,
  max(CASE WHEN early THEN CAST(o_orderdate AS DATE) END) AS last_before,
  count(*) FILTER (WHERE early) AS n_before,
  max(CASE WHEN early AND place = 1 THEN o_orderpriority END) AS last_priority,
  count(*) FILTER (WHERE NOT early) AS n_after,
  CAST(sum(CASE WHEN NOT early THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS after_total
FROM (
  SELECT *, o_orderdate < TIMESTAMP '{CUT}' AS early,
    row_number() OVER (PARTITION BY o_custkey, o_orderdate < TIMESTAMP '{CUT}'
                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM orders)
GROUP BY o_custkey""",
    "accounts": f"""
SELECT c_custkey AS account_id,
  CAST(greatest(coalesce(date_diff('day', first_before, DATE '{CUT}') // 30, 1), 1) AS BIGINT)
    AS tenure_months,
  c_mktsegment AS plan,
  {_PRICE_SQL} AS base_monthly_price_gbp,
  {half_away("(abs(c_acctbal) / 100)", 2)} AS current_monthly_price_gbp,
  CAST(least(coalesce(n_before, 0), 6) AS BIGINT) AS n_price_rises_since_joining,
  CAST(least(coalesce(date_diff('day', last_before, DATE '{CUT}') // 30, 14), 14) AS BIGINT)
    AS months_since_last_price_rise,
  r_name AS region,
  last_priority AS primary_device,
  CAST(c_custkey % 5 + 1 AS BIGINT) AS num_devices_registered,
  CAST(c_nationkey % 5 + 1 AS BIGINT) AS household_size_est,
  CASE WHEN c_custkey % 2 = 0 THEN 'rolling_monthly' ELSE '18mo_contract' END AS contract_type,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE c_custkey % 22 - 3 END AS BIGINT)
    AS months_to_contract_end,
  CAST(c_custkey % 6 AS BIGINT) AS support_contacts_last_90d,
  CAST(c_custkey % 17 = 0 AS BIGINT) AS billing_dispute_last_90d,
  CAST(c_custkey % 11 = 0 AS BIGINT) AS outage_reported_last_90d,
  CAST(c_custkey % 11 AS BIGINT) AS nps_last_survey,
  CAST(c_custkey * 7919 % 1000 AS DOUBLE) / 1000e0 AS competitor_ad_exposure_score,
  coalesce(n_before, 0) AS engagement,
  CAST(coalesce(n_after, 0) = 0 AS BIGINT) AS churned_next_60d,
  CAST(coalesce(after_total > (SELECT avg(after_total) FROM history), FALSE) AS BIGINT)
    AS accepted_upsell_offer
FROM customer
LEFT JOIN history ON c_custkey = o_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "standard": """
SELECT *, (engagement - (SELECT avg(engagement) FROM accounts))
  / (SELECT stddev_pop(engagement) FROM accounts) AS z FROM accounts""",
    "subscribers": f"""
SELECT {SUBSCRIBER_COLUMNS} FROM (
  SELECT *, {CHURN_PROBABILITY_SQL} AS churn_probability_true,
    {UPSELL_PROBABILITY_SQL} AS upsell_probability_true
  FROM standard)""",
    "activity": _monthly_sql(EVENT_ROWS_SQL, EVENT_GENRES),
    "viewing": _features_sql("activity", EVENT_GENRES),
    "line_activity": _monthly_sql(LINE_ROWS_SQL, LINE_GENRES),
    "line_viewing": _features_sql("line_activity", LINE_GENRES),
    "planted": f"""
WITH limits AS (SELECT avg(churn_probability_true) + stddev_pop(churn_probability_true) AS churn,
  avg(upsell_probability_true) + stddev_pop(upsell_probability_true) AS upsell FROM subscribers),
marked AS (SELECT s.*, substr(md5(concat(account_id, ':noise')), 1, 1) = '0' AS flipped,
  churn_probability_true >= churn AS churns, upsell_probability_true >= upsell AS upgrades
  FROM subscribers s, limits)
SELECT account_id, plan, CAST(churns <> flipped AS BIGINT) AS churned,
  CAST(upgrades <> flipped AS BIGINT) AS upgraded FROM marked""",
    "scored_labels": """
SELECT doc_id AS account_id, CAST(doc_id * 7919 % 101 AS DOUBLE) / 101e0 AS score,
  CAST(quality AS BIGINT) AS label FROM labels""",
    "scored_orders": """
SELECT o_orderkey AS account_id,
  CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE)
    / 4294967296e0 AS score,
  CAST(o_orderstatus = 'F' AS BIGINT) AS label FROM orders""",
    "vectors": "SELECT vec_id AS account_id, "
    + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS affinity_{g}" for i, g in enumerate(VECTOR_GENRES)
    )
    + ", label AS segment FROM embeddings",
}

_NEEDS = {
    "accounts": ("history",),
    "standard": ("accounts",),
    "subscribers": ("standard",),
    "planted": ("subscribers",),
    "viewing": ("activity",),
    "line_viewing": ("line_activity",),
}


def with_tables(*names: str, **extra: str) -> str:
    """A WITH clause that defines the named mappings, what they need and any extra relations."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"
