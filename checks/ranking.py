"""Ranking metrics, splits, target lists and segment measures on deterministic scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    VECTOR_GENRES,
    half_away,
    read,
    scored_labels,
    scored_orders,
    vectors,
    with_tables,
)
from halyard import functions as H
from halyard.contract import affinity_columns
from halyard.operators import metrics, rollups, segments, splitting, targeting
from halyard.plans import promotion
from halyard.sources import tables
from halyard.sources.workspace import workspace_path

VECTOR_COLUMNS = affinity_columns(VECTOR_GENRES)


def _ladder_ctes(source: str, where: str = "") -> dict[str, str]:
    return {
        "levels": "SELECT score, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n"
        f" FROM {source} {where} GROUP BY score",
        "ladder": "SELECT score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS seen,"
        " sum(p) OVER () AS pt, sum(n) OVER () AS nt FROM levels WINDOW w AS (ORDER BY score DESC)",
    }


_AUC = "sum(p * ((nt - pt) - (seen - tp) + (n - p) / 2)) / nullif(max(pt) * max(nt - pt), 0)"
_AP = "sum(p / nullif(pt, 0) * tp / seen)"


def _round6(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: H.round_half_away(F.col(c), 6) for c in columns})


def _auc_sql(source: str) -> str:
    return with_tables(source, **_ladder_ctes(source)) + (
        f"SELECT {half_away(_AUC, 6)} AS roc_auc FROM ladder"
    )


def _ap_sql(source: str) -> str:
    return with_tables(source, **_ladder_ctes(source)) + (
        f"SELECT {half_away(_AP, 6)} AS average_precision FROM ladder"
    )


@query("roc_auc", _auc_sql("scored_orders"))
def roc_auc(spark, sf):
    return _round6(metrics.roc_auc(metrics.score_ladder(scored_orders(spark, sf))), "roc_auc")


@query("roc_auc_ties", _auc_sql("scored_labels"))
def roc_auc_ties(spark, sf):
    return _round6(metrics.roc_auc(metrics.score_ladder(scored_labels(spark, sf))), "roc_auc")


@query("average_precision", _ap_sql("scored_orders"))
def average_precision(spark, sf):
    ladder = metrics.score_ladder(scored_orders(spark, sf))
    return _round6(metrics.average_precision(ladder), "average_precision")


@query("average_precision_ties", _ap_sql("scored_labels"))
def average_precision_ties(spark, sf):
    ladder = metrics.score_ladder(scored_labels(spark, sf))
    return _round6(metrics.average_precision(ladder), "average_precision")


@query(
    "precision_recall_curve",
    with_tables("scored_orders", **_ladder_ctes("scored_orders"))
    + "SELECT score AS threshold, tp / seen AS precision, tp / nullif(pt, 0) AS recall FROM ladder",
)
def precision_recall_curve(spark, sf):
    return metrics.precision_recall_curve(metrics.score_ladder(scored_orders(spark, sf)))


def _flag_cte(source: str) -> str:
    return (
        "SELECT *, CAST(score >= (SELECT quantile_cont(score, 0.9) FROM "
        f"{source}) AS BIGINT) AS prediction FROM {source}"
    )


@query(
    "top_decile_flag",
    with_tables("scored_labels", flagged=_flag_cte("scored_labels"))
    + "SELECT account_id, score, label, prediction FROM flagged",
)
def top_decile_flag(spark, sf):
    return metrics.with_top_flag(scored_labels(spark, sf))


_REPORT_COUNTS = (
    "SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,"
    " CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,"
    " CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,"
    " CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM flagged"
)
_REPORT_RATES = (
    "SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,"
    " tn + fp AS s0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,"
    " 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1, (tp + tn) / (tp + fp + fn + tn) AS acc"
    " FROM counts"
)


@query(
    "classification_report",
    with_tables(
        "scored_orders",
        flagged=_flag_cte("scored_orders"),
        counts=_REPORT_COUNTS,
        rates=_REPORT_RATES,
        report="SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM rates"
        " UNION ALL SELECT '1', p1, r1, f1, s1 FROM rates"
        " UNION ALL SELECT 'accuracy', NULL, NULL, acc, s0 + s1 FROM rates"
        " UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 FROM rates"
        " UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1),"
        " (r0 * s0 + r1 * s1) / (s0 + s1), (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 FROM rates",
    )
    + f"SELECT class, {half_away('p', 6)} AS precision, {half_away('r', 6)} AS recall,"
    f" {half_away('f', 6)} AS f1_score, CAST(s AS BIGINT) AS support FROM report",
)
def classification_report(spark, sf):
    flagged = metrics.with_top_flag(scored_orders(spark, sf))
    report = metrics.classification_report(flagged)
    return _round6(report, "precision", "recall", "f1_score")


@query(
    "capture_rate_lift",
    with_tables("scored_labels", flagged=_flag_cte("scored_labels"))
    + "SELECT sum(prediction)::BIGINT AS flagged,"
    " sum(prediction * label)::BIGINT AS flagged_positives,"
    f" {half_away('sum(prediction * label) / sum(prediction)', 6)} AS precision,"
    f" {half_away('sum(prediction * label) / sum(label)', 6)} AS capture_rate,"
    f" {half_away('sum(prediction * label) / sum(prediction) / avg(label)', 6)} AS lift FROM flagged",
)
def capture_rate_lift(spark, sf):
    summary = metrics.ranking_summary(metrics.score_ladder(scored_labels(spark, sf)))
    return _round6(metrics.capture_and_lift(summary), "precision", "capture_rate", "lift")


@query(
    "write_metrics_json",
    with_tables("scored_orders", **_ladder_ctes("scored_orders"))
    + f"SELECT CAST(max(nt) AS BIGINT) AS n, CAST(max(pt) AS BIGINT) AS positives,"
    f" {half_away(_AUC, 6)} AS roc_auc, {half_away(_AP, 6)} AS average_precision FROM ladder",
)
def write_metrics_json(spark, sf):
    summary = metrics.ranking_summary(metrics.score_ladder(scored_orders(spark, sf)))
    record = summary.select("n", "positives", "roc_auc", "average_precision")
    record = _round6(record, "roc_auc", "average_precision")
    path = tables.write_metrics_json(record, workspace_path(spark, "metrics"))
    return tables.read_report_json(spark, path, record.schema)


# --- splits -----------------------------------------------------------------


def split_cte(source: str) -> dict[str, str]:
    return {
        "strata": f"SELECT label, count(*) AS n FROM {source} GROUP BY label",
        "shares": "SELECT *, ((sum(n) OVER () + 4) // 5) AS take_all,"
        " ((sum(n) OVER () + 4) // 5) * n // sum(n) OVER () AS base,"
        " (((sum(n) OVER () + 4) // 5) * n) % (sum(n) OVER ()) AS remainder FROM strata",
        "quotas": "SELECT label, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label)"
        " <= take_all - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM shares",
        "split": "SELECT s.*, row_number() OVER (PARTITION BY s.label ORDER BY"
        " md5(concat(s.account_id, ':42')), s.account_id) <= q.take AS is_test"
        f" FROM {source} s JOIN quotas q ON s.label = q.label",
    }


@query(
    "stratified_split",
    with_tables("scored_orders", **split_cte("scored_orders"))
    + "SELECT account_id, label, is_test FROM split",
)
def stratified_split(spark, sf):
    split = splitting.stratified_split(scored_orders(spark, sf))
    return split.select("account_id", "label", "is_test")


def _stored_split(spark: SparkSession, sf: str) -> DataFrame:
    """Split and scores stored once, as the training jobs do: evaluation reads them several times."""
    split = splitting.stratified_split(scored_orders(spark, sf))
    return tables.materialise(split, workspace_path(spark, "scores"))


def _evaluation_sql(base_name: str, top: bool, everyone: str = "") -> str:
    source = "scored_orders"
    ctes = split_cte(source) | _ladder_ctes("split", "WHERE is_test")
    ctes["cut"] = "SELECT quantile_cont(score, 0.9) AS q FROM split WHERE is_test"
    top_columns = (
        f"{half_away('(SELECT q FROM cut)', 4)} AS top_decile_threshold, "
        + half_away(
            "(SELECT avg(label) FROM split WHERE is_test AND score >= (SELECT q FROM cut))", 4
        )
        + " AS top_decile_precision, "
        + half_away(
            "(SELECT sum(label) FROM split WHERE is_test AND score >= (SELECT q FROM cut)) / max(pt)",
            4,
        )
        + " AS top_decile_churn_capture_rate, "
        if top
        else ""
    )
    return with_tables(source, **ctes) + (
        f"SELECT {half_away(_AUC, 4)} AS roc_auc, {half_away(_AP, 4)} AS average_precision,"
        f" {half_away('(SELECT avg(label) FROM split)', 4)} AS {base_name}, {top_columns}"
        " (SELECT count(*) FROM split WHERE NOT is_test) AS n_train,"
        f" (SELECT count(*) FROM split WHERE is_test) AS n_test{everyone} FROM ladder"
    )


@query("evaluate_churn", _evaluation_sql("base_churn_rate", top=True))
def evaluate_churn(spark, sf):
    return metrics.evaluate_churn(_stored_split(spark, sf))


@query(
    "evaluate_propensity",
    _evaluation_sql(
        "base_acceptance_rate",
        top=False,
        everyone=", (SELECT count(*) FROM split) AS n_eligible_accounts",
    ),
)
def evaluate_propensity(spark, sf):
    return metrics.evaluate_propensity(_stored_split(spark, sf))


# --- gate and promotion log -------------------------------------------------


@query(
    "quality_gate",
    with_tables("scored_labels", **_ladder_ctes("scored_labels"))
    + f"SELECT {half_away(_AUC, 6)} AS roc_auc, {_AUC} >= 0.65 AS passed FROM ladder",
)
def quality_gate(spark, sf):
    measured = metrics.roc_auc(metrics.score_ladder(scored_labels(spark, sf)))
    return _round6(metrics.quality_gate(measured), "roc_auc")


def _candidate_scores(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Three candidate scorings of orders: by chance, one that knows the price, and chance
    reversed. Only the second passes the gate."""
    scored = scored_orders(spark, sf)
    priced = scored.join(
        read(spark, sf, "orders").select(F.col("o_orderkey").alias("account_id"), "o_totalprice"),
        "account_id",
    )
    return {
        "hash": scored,
        "price": priced.select(
            (F.col("o_totalprice") / F.lit(500000.0) + F.col("score") * F.lit(0.5)).alias("score"),
            H.flag(F.col("o_totalprice") > 250000).alias("label"),
        ),
        "reversed": scored.withColumn("score", -F.col("score")),
    }


def _candidate_model(version: str) -> PipelineModel:
    """A model small enough to save in a check: it names itself on every row."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, '{version}' AS model FROM __THIS__")])


def _candidate_sql(version: str, run: int, rows: str) -> str:
    levels = (
        "SELECT score, CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS n"
        f" FROM ({rows}) GROUP BY score"
    )
    ladder = (
        "SELECT score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS seen, sum(p) OVER () AS pt,"
        f" sum(n) OVER () AS nt FROM ({levels}) WINDOW w AS (ORDER BY score DESC)"
    )
    return (
        f"SELECT CAST({run} AS BIGINT) AS run, '{version}' AS version,"
        f" {half_away(_AUC, 6)} AS roc_auc, {_AUC} >= 0.65 AS passed FROM ({ladder})"
    )


_RUNS_SQL = " UNION ALL ".join(
    [
        _candidate_sql("hash", 1, "SELECT score, label FROM scored_orders"),
        _candidate_sql(
            "price",
            2,
            "SELECT o_totalprice / 500000.0::DOUBLE + score * 0.5::DOUBLE AS score,"
            " CAST(o_totalprice > 250000 AS BIGINT) AS label"
            " FROM scored_orders JOIN orders ON account_id = o_orderkey",
        ),
        _candidate_sql("reversed", 3, "SELECT -score AS score, label FROM scored_orders"),
    ]
)


@query(
    "gated_promotion",
    with_tables("scored_orders", runs=_RUNS_SQL)
    + "SELECT *, run = (SELECT max(run) FROM runs WHERE passed) AS is_current,"
    " (SELECT version FROM runs WHERE passed ORDER BY run DESC LIMIT 1) AS loaded FROM runs",
)
def gated_promotion(spark, sf):
    """Promote candidates in turn, each twice as after a retry; ``loaded`` is what the registry's
    current model says of itself."""
    root = workspace_path(spark, "registry")
    for run, (version, scored) in enumerate(_candidate_scores(spark, sf).items(), start=1):
        measured = metrics.roc_auc(metrics.score_ladder(scored))
        for _ in range(2):
            promotion.promote(_candidate_model(version), measured, root, version, run)
    current = promotion.current_version(spark, root).select("run")
    log = promotion.promotion_log(spark, root).drop("path")
    marked = _round6(log, "roc_auc").withColumn("is_current", F.col("run") == current.scalar())
    loaded = promotion.load_current_model(spark, root).transform(marked)
    return loaded.withColumnRenamed("model", "loaded")


# --- lists ------------------------------------------------------------------


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_totalprice").alias("score"),
        F.rint(F.col("o_totalprice") * 100).cast("bigint").alias("pence"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("band"),
    )


_OFFERS_SQL = (
    "SELECT o_orderkey AS account_id, o_totalprice AS score,"
    " CAST(round(o_totalprice * 100) AS BIGINT) AS pence,"
    " CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS band FROM orders"
)


@query(
    "offer_list_budget",
    with_tables(
        offers=_OFFERS_SQL,
        ranked="SELECT *, row_number() OVER w AS offer_rank,"
        " CAST(sum(pence) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_cost"
        " FROM offers WINDOW w AS (ORDER BY score DESC, account_id)",
    )
    + "SELECT account_id, score, pence AS cost, offer_rank, running_cost FROM ranked"
    " WHERE running_cost <= (SELECT sum(pence) // 5 FROM offers)",
)
def offer_list_budget(spark, sf):
    offers = _offers(spark, sf)
    fifth = offers.agg(F.expr("sum(pence) div 5")).scalar()
    return targeting.offer_list(offers, fifth, cost="pence")


@query(
    "offer_list_ties",
    with_tables(
        offers=_OFFERS_SQL,
        ranked="SELECT *, row_number() OVER (ORDER BY band DESC, account_id) AS offer_rank FROM offers",
    )
    + "SELECT account_id, band, CAST(1 AS BIGINT) AS cost, offer_rank, offer_rank AS running_cost"
    " FROM ranked WHERE offer_rank <= (SELECT count(*) // 2 FROM offers)",
)
def offer_list_ties(spark, sf):
    """Five distinct scores only, so every score is a heavy one."""
    offers = _offers(spark, sf)
    half = offers.agg(F.expr("count(*) div 2")).scalar()
    return targeting.offer_list(offers, half, score="band")


_TARGET_PROFILE = (
    "SELECT *, CASE greatest(" + ", ".join(VECTOR_COLUMNS) + ") "
    + " ".join(f"WHEN affinity_{g} THEN '{g}'" for g in VECTOR_GENRES)
    + " END AS dominant_genre FROM (SELECT segment, "
    + ", ".join(f"{half_away(f'avg({c})', 3)} AS {c}" for c in VECTOR_COLUMNS)
    + " FROM vectors GROUP BY segment)"
)


@query(
    "retention_targets",
    with_tables("scored_orders", "vectors", profile=_TARGET_PROFILE)
    + "SELECT s.account_id, s.score, v.segment, p.dominant_genre,"
    " p.dominant_genre || '_save_offer' AS offer FROM scored_orders s"
    " JOIN vectors v ON s.account_id = v.account_id JOIN profile p ON v.segment = p.segment"
    " WHERE s.score >= (SELECT quantile_cont(score, 0.9) FROM scored_orders)",
)
def retention_targets(spark, sf):
    segmented = vectors(spark, sf)
    profile = segments.segment_profile(segmented, VECTOR_GENRES)
    return targeting.retention_targets(scored_orders(spark, sf), segmented, profile)


# --- segments on fixed assignments ------------------------------------------


_SQUARED = "(" + " + ".join(f"(x.{c} - y.{c}) ** 2" for c in VECTOR_COLUMNS) + ")"


def _silhouette_ctes(points: str, distance: str) -> str:
    return with_tables(
        "vectors",
        points=points,
        gaps=f"SELECT x.account_id, x.segment AS own, y.segment AS other, sum({distance}) AS total,"
        " count(*) AS n FROM points x CROSS JOIN points y GROUP BY 1, 2, 3",
        sides="SELECT account_id, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,"
        " min(CASE WHEN own <> other THEN total / n END) AS b FROM gaps GROUP BY account_id",
    )


_MEAN_SILHOUETTE = half_away("avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0))", 6)


def _silhouette_sql() -> str:
    sampled = "SELECT * FROM vectors ORDER BY md5(concat(account_id, ':42')), account_id LIMIT 5000"
    return _silhouette_ctes(sampled, f"sqrt{_SQUARED}") + (
        f"SELECT 'segment' AS assignment, {_MEAN_SILHOUETTE} AS silhouette, count(*) AS n_sampled"
        " FROM sides"
    )


@query("silhouette_sampled", _silhouette_sql())
def silhouette_sampled(spark, sf):
    measured = segments.sampled_silhouette(vectors(spark, sf), VECTOR_COLUMNS, ["segment"])
    return _round6(measured, "silhouette")


_POINTS_SQL = (
    "SELECT o_orderkey AS account_id, o_totalprice / 100000e0 AS x,"
    " CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) / 1000e0 AS y,"
    " CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, CAST(o_orderkey % 3 AS INTEGER) AS third FROM orders"
)


def _gaps_sql(assignment: str) -> str:
    return (
        f"SELECT x.account_id, x.{assignment} AS own, y.{assignment} AS other,"
        " sum(sqrt((x.x - y.x) ** 2 + (x.y - y.y) ** 2)) AS total, count(*) AS n"
        " FROM points x CROSS JOIN points y GROUP BY 1, 2, 3"
    )


def _order_silhouettes_sql() -> str:
    sides = (
        "SELECT account_id, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,"
        " min(CASE WHEN own <> other THEN total / n END) AS b FROM ({}) GROUP BY account_id"
    )
    return with_tables(
        everyone=_POINTS_SQL,
        points="SELECT * FROM everyone ORDER BY md5(concat(account_id, ':42')), account_id LIMIT 5000",
    ) + " UNION ALL ".join(
        f"SELECT '{name}' AS assignment, {_MEAN_SILHOUETTE} AS silhouette, count(*) AS n_sampled"
        f" FROM ({sides.format(_gaps_sql(name))})"
        for name in ("priority", "third")
    )


@query("silhouette_sampled_orders", _order_silhouettes_sql())
def silhouette_sampled_orders(spark, sf):
    """A table of more rows than the sample has; two assignments of the same rows."""
    points = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("account_id"),
        (F.col("o_totalprice") / 100000.0).alias("x"),
        (F.date_diff("o_orderdate", F.lit("1992-01-01").cast("date")) / 1000.0).alias("y"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        (F.col("o_orderkey") % 3).cast("int").alias("third"),
    )
    measured = segments.sampled_silhouette(points, ["x", "y"], ["priority", "third"])
    return _round6(measured, "silhouette")


@query(
    "silhouette_full",
    _silhouette_ctes("SELECT * FROM vectors", _SQUARED)
    + f"SELECT 'segment' AS assignment, {_MEAN_SILHOUETTE} AS silhouette_squared FROM sides",
)
def silhouette_full(spark, sf):
    measured = segments.full_silhouette(vectors(spark, sf), VECTOR_COLUMNS, "segment")
    return _round6(measured, "silhouette_squared")


@query(
    "affinity_index_segments",
    with_tables("vectors")
    + "SELECT segment, "
    + ", ".join(
        half_away(f"avg({c}) / (SELECT avg({c}) FROM vectors)", 4) + f" AS index_{c}"
        for c in VECTOR_COLUMNS
    )
    + " FROM vectors GROUP BY segment",
)
def affinity_index_segments(spark, sf):
    index = rollups.affinity_index(vectors(spark, sf), genres=VECTOR_GENRES)
    return index.select(
        "segment", *[H.round_half_away(F.col(c), 4).alias(c) for c in index.columns[1:]]
    )
