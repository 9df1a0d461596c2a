"""Model preparation, training, scoring, clustering, jobs and streaming.

Every job runs with the library's full settings, once per input; the queries about its parts read
what the job left behind. Every query trains on and scores all accounts.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.ranking import split_cte
from checks.registry import query
from checks.tables import (
    EVENT_GENRES,
    HOUR_DIGITS,
    LINE_GENRES,
    TOP_PLAN,
    event_activity,
    half_away,
    line_activity,
    once,
    planted_subscribers,
    read,
    subscribers,
    with_tables,
)
from halyard import functions as H
from halyard.contract import (
    ACCOUNT_NUMERIC_COLUMNS,
    CATEGORICAL_COLUMNS,
    affinity_columns,
    numeric_columns,
)
from halyard.operators import learning, segments, splitting, targeting, training
from halyard.operators.viewing import viewing_features
from halyard.plans import (
    affinity_job,
    churn_training_job,
    jobs,
    promote,
    propensity_training_job,
    train_churn_model,
    train_propensity_model,
)
from halyard.plans.jobs import JobResult
from halyard.plans.promotion import load_current_model
from halyard.sources import load_model, save_model
from halyard.sources.tables import (
    IMPORTANCE_SCHEMA,
    materialise,
    read_report_csv,
    read_report_in_order,
    register_views,
    scan_view,
    write_csv,
)
from halyard.sources.workspace import workspace_path
from halyard.streaming import score_stream, score_stream_promoted


def _viewing(spark: SparkSession, sf: str) -> DataFrame:
    return viewing_features(line_activity(spark, sf), LINE_GENRES, digits=HOUR_DIGITS)


@dataclass(frozen=True)
class _Done:
    """A finished job and the registry it promotes to."""

    result: JobResult
    registry: str | None = None


def _churn_job(spark: SparkSession, sf: str) -> _Done:
    def make() -> _Done:
        registry = workspace_path(spark, "registry")
        result = churn_training_job(
            planted_subscribers(spark, sf),
            line_activity(spark, sf),
            workspace_path(spark, "churn-job"),
            registry,
            version="v1",
            run=1,
            genres=LINE_GENRES,
            digits=HOUR_DIGITS,
        )
        return _Done(result, registry)

    return once(spark, sf, "churn_job", make)


def _propensity_job(spark: SparkSession, sf: str) -> _Done:
    def make() -> _Done:
        return _Done(
            propensity_training_job(
                planted_subscribers(spark, sf),
                line_activity(spark, sf),
                workspace_path(spark, "propensity-job"),
                genres=LINE_GENRES,
                top_plan=TOP_PLAN,
                digits=HOUR_DIGITS,
            )
        )

    return once(spark, sf, "propensity_job", make)


def _affinity_job(spark: SparkSession, sf: str) -> _Done:
    def make() -> _Done:
        output = workspace_path(spark, "affinity-job")
        activity = line_activity(spark, sf)
        return _Done(affinity_job(activity, output, genres=LINE_GENRES, digits=HOUR_DIGITS))

    return once(spark, sf, "affinity_job", make)


def _churn_frame(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_churn_job(spark, sf).result.output}/training_frame")


def _churn_model(spark: SparkSession, sf: str) -> PipelineModel:
    return _churn_job(spark, sf).result.model


def _account_counts_sql(columns: str, where: str = "") -> str:
    return with_tables("subscribers", "line_viewing") + (
        f"SELECT {columns} FROM subscribers s JOIN line_viewing v ON s.account_id = v.account_id{where}"
    )


# --- preparation ------------------------------------------------------------

_LEVELS = {
    "plan": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
    "primary_device": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    "contract_type": ("18mo_contract", "rolling_monthly"),
}


@query(
    "one_hot",
    with_tables("subscribers")
    + "SELECT account_id, plan, region, primary_device, contract_type, "
    + ", ".join(
        f"CAST(coalesce({c} = '{level}', FALSE) AS BIGINT) AS \"{c}_{level}\""
        for c, levels in _LEVELS.items()
        for level in levels
    )
    + " FROM subscribers",
)
def one_hot(spark, sf):
    return learning.one_hot(
        subscribers(spark, sf).select(
            "account_id", "plan", "region", "primary_device", "contract_type"
        )
    )


@query(
    "assemble",
    with_tables("subscribers")
    + "SELECT account_id, CAST(29 AS BIGINT) AS n_slots, "
    + half_away(
        " + ".join(ACCOUNT_NUMERIC_COLUMNS)
        + " + 3 + CASE WHEN primary_device IS NULL THEN 0 ELSE 1 END",
        4,
    )
    + " AS slot_sum FROM subscribers",
)
def assemble(spark, sf):
    slots = vector_to_array("features")
    assembled = learning.assemble(subscribers(spark, sf), ACCOUNT_NUMERIC_COLUMNS)
    total = F.reduce(slots, F.lit(0.0), lambda total, slot: total + slot)
    return assembled.select(
        "account_id",
        F.size(slots).cast("bigint").alias("n_slots"),
        H.round_half_away(total, 4).alias("slot_sum"),
    )


@query(
    "impute_with_flag",
    with_tables("viewing")
    + "SELECT c_custkey AS account_id, CAST(viewing_trend_3mo IS NULL AS DOUBLE)"
    " AS viewing_trend_3mo_missing, coalesce(viewing_trend_3mo,"
    " (SELECT median(viewing_trend_3mo) FROM viewing)) AS viewing_trend_3mo_filled"
    " FROM customer LEFT JOIN viewing ON c_custkey = account_id",
)
def impute_with_flag(spark, sf):
    viewing = viewing_features(event_activity(spark, sf), EVENT_GENRES, digits=HOUR_DIGITS)
    accounts = read(spark, sf, "customer").select(F.col("c_custkey").alias("account_id"))
    everyone = accounts.join(viewing.select("account_id", "viewing_trend_3mo"), "account_id", "left")
    return learning.impute_with_flags(everyone, ["viewing_trend_3mo"]).drop("viewing_trend_3mo")


# --- models -----------------------------------------------------------------


@query("churn_model")
def churn_model(spark, sf):
    frame = _churn_frame(spark, sf)
    model = _churn_model(spark, sf)
    return learning.batch_score(model, frame.where("is_test"), ("account_id", "label"))


@query("propensity_model")
def propensity_model(spark, sf):
    result = _propensity_job(spark, sf).result
    frame = spark.read.parquet(f"{result.output}/training_frame")
    return learning.batch_score(result.model, frame.where("is_test"), ("account_id", "label"))


@query("batch_score")
def batch_score(spark, sf):
    return learning.batch_score(_churn_model(spark, sf), _churn_frame(spark, sf))


@query("feature_importance")
def feature_importance(spark, sf):
    return learning.feature_importance(_churn_model(spark, sf), _churn_frame(spark, sf), n=None)


@query("top_drivers")
def top_drivers(spark, sf):
    importances = learning.feature_importance(
        _churn_model(spark, sf), _churn_frame(spark, sf), n=None
    )
    return targeting.top_drivers(importances)


@query(
    "top_drivers_customers",
    "SELECT c_name AS feature, c_acctbal AS importance,"
    " row_number() OVER (ORDER BY c_acctbal DESC, c_name) AS place FROM customer"
    " QUALIFY place <= 15",
)
def top_drivers_customers(spark, sf):
    """The same ranking on a table of which SQL knows the values, in the order it was written."""
    importances = read(spark, sf, "customer").select(
        F.col("c_name").alias("feature"), F.col("c_acctbal").alias("importance")
    )
    path = write_csv(targeting.top_drivers(importances), workspace_path(spark, "drivers"))
    return read_report_in_order(spark, path, IMPORTANCE_SCHEMA)


@query(
    "top_drivers_check",
    "SELECT unnest(range(1, 16)) AS place, TRUE AS in_order, TRUE AS is_largest",
)
def top_drivers_check(spark, sf):
    """The churn job's report as written: each importance no larger than the one before, and each
    that of the feature with that many larger ones."""
    job = _churn_job(spark, sf).result
    path = f"{job.output}/feature_importance"
    drivers = read_report_in_order(spark, path, IMPORTANCE_SCHEMA)
    everything = learning.feature_importance(job.model, _churn_frame(spark, sf), n=None)
    sizes = F.array_sort(F.collect_list((-F.col("importance"))))
    largest = everything.agg(sizes).scalar()
    before = F.lag("importance").over(Window.orderBy("place"))
    return drivers.select(
        "place",
        F.coalesce(F.col("importance") <= before, F.lit(True)).alias("in_order"),
        (F.col("importance") == -F.element_at(largest, F.col("place").cast("int"))).alias("is_largest"),
    )


def _training_ctes(label: str, where: str = "") -> dict[str, str]:
    """Rows that a job trains on, and their split into training and test rows."""
    rows = (
        f"SELECT p.account_id, p.plan, {label} AS label FROM {{}} p"
        f" JOIN line_viewing v ON p.account_id = v.account_id{where}"
    )
    return {"training": rows, **split_cte("training")}


def _test_rows_sql(source: str, label: str, where: str = "") -> str:
    ctes = _training_ctes(label, where)
    ctes["training"] = ctes["training"].format(source)
    return with_tables(source, "line_viewing", **ctes) + (
        "SELECT account_id, label, TRUE AS is_probability FROM split WHERE is_test"
    )


def _test_rows(scored: DataFrame) -> DataFrame:
    inside = F.coalesce(F.col("score").between(0.0, 1.0), F.lit(False))
    return scored.select(
        "account_id", F.col("label").cast("bigint").alias("label"), inside.alias("is_probability")
    )


_ELIGIBLE = f" WHERE plan IS DISTINCT FROM '{TOP_PLAN}'"


@query("churn_model_check", _test_rows_sql("planted", "churned"))
def churn_model_check(spark, sf):
    """Which accounts the churn model was tested on, with which labels."""
    return _test_rows(churn_model(spark, sf))


@query("propensity_model_check", _test_rows_sql("planted", "upgraded", _ELIGIBLE))
def propensity_model_check(spark, sf):
    return _test_rows(propensity_model(spark, sf))


#: Rounds of boosting of the fit on the natural label; the jobs have the full settings.
NATURAL_ROUNDS = 20


@query("churn_model_natural", _test_rows_sql("subscribers", "churned_next_60d"))
def churn_model_natural(spark, sf):
    """A fit on the label that the tables themselves give: no order after the cut."""
    view = training.churn_training_view(subscribers(spark, sf), _viewing(spark, sf), LINE_GENRES)
    frame = materialise(splitting.stratified_split(view), workspace_path(spark, "natural"))
    model = learning.fit(learning.churn_pipeline(LINE_GENRES, maxIter=NATURAL_ROUNDS), frame)
    tested = frame.where("is_test")
    return _test_rows(learning.batch_score(model, tested, ("account_id", "label")))


def _feature_names_sql() -> str:
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}_' || {c} FROM trained WHERE {c} IS NOT NULL" for c in CATEGORICAL_COLUMNS
    )
    numeric = numeric_columns(LINE_GENRES)
    names = ", ".join(f"('{c}'), ('{c}_missing')" for c in numeric)
    ctes = _training_ctes("churned")
    ctes["training"] = ctes["training"].format("planted")
    ctes["trained"] = "SELECT s.* FROM subscribers s JOIN split t USING (account_id) WHERE NOT is_test"
    return with_tables("planted", "line_viewing", **ctes) + (
        f"SELECT feature, TRUE AS is_share, 1e0 AS total FROM ({levels} UNION ALL"
        f" SELECT * FROM (VALUES {names})) AS f(feature)"
    )


@query("feature_importance_check", _feature_names_sql())
def feature_importance_check(spark, sf):
    """Every feature of the contract has an importance; none is negative and they add up to 1."""
    found = feature_importance(spark, sf)
    total = H.round_half_away(found.agg(F.sum("importance")).scalar(), 9)
    is_share = F.col("importance").between(0.0, 1.0)
    return found.select("feature", is_share.alias("is_share"), total.alias("total"))


_IN_RANGE_SQL = _account_counts_sql("count(*) AS n_accounts, CAST(0 AS BIGINT) AS n_outside")


@query("batch_score_range", _IN_RANGE_SQL)
def batch_score_range(spark, sf):
    """How many accounts are scored, and how many scores are no probability."""
    scored = learning.batch_score(_churn_model(spark, sf), _churn_frame(spark, sf))
    inside = F.coalesce(F.col("score").between(0.0, 1.0), F.lit(False))
    return scored.agg(
        F.count("*").alias("n_accounts"), F.count_if(~inside).alias("n_outside")
    )


def _sizes_sql(counts: str, also: str = "") -> str:
    return (
        f"SELECT n - (20 * n + 99) // 100 AS n_train, (20 * n + 99) // 100 AS n_test{also} FROM ({counts})"
    )


@query("churn_job_sizes", _sizes_sql(_account_counts_sql("count(*) AS n")))
def churn_job_sizes(spark, sf):
    return _churn_job(spark, sf).result.metrics.select(
        F.col("n_train").cast("bigint"), F.col("n_test").cast("bigint")
    )


@query(
    "propensity_job_sizes",
    _sizes_sql(
        _account_counts_sql("count(*) AS n", f" WHERE plan IS DISTINCT FROM '{TOP_PLAN}'"),
        ", n AS n_eligible",
    ),
)
def propensity_job_sizes(spark, sf):
    return _propensity_job(spark, sf).result.metrics.select(
        F.col("n_train").cast("bigint"),
        F.col("n_test").cast("bigint"),
        F.col("n_eligible_accounts").cast("bigint").alias("n_eligible"),
    )


_SAME_METRICS_SQL = (
    "SELECT TRUE AS auc_equal, TRUE AS precision_equal, CAST(1 AS BIGINT) AS n_fits,"
    " TRUE AS resumed_equal"
)


def _recomputed(spark: SparkSession, done: _Done, resume) -> DataFrame:
    """Metrics of a job next to those that Spark's own evaluator finds in the stored scores, and
    the metrics of a second start that finds every step done."""
    result = done.result
    tested = spark.read.parquet(f"{result.output}/scores").where("is_test")
    tested = tested.withColumn("label", F.col("label").cast("double"))
    areas = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    area = areas.evaluate(tested, {areas.metricName: "areaUnderROC"})
    ladder = Window.orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    steps = tested.groupBy("score").agg(F.sum("label").alias("p"), F.count("*").alias("n"))
    at = F.col("p") * F.sum("p").over(ladder) / F.sum("n").over(ladder)
    precision = steps.select(at.alias("x"), "p").agg(F.sum("x") / F.sum("p")).scalar()
    fits = []
    again = resume(fits)
    same = result.metrics.exceptAll(again.metrics).isEmpty()
    return result.metrics.select(
        (F.abs(F.col("roc_auc") - F.lit(area)) <= 1e-4).alias("auc_equal"),
        (F.abs(F.col("average_precision") - precision) <= 1e-4).alias("precision_equal"),
        F.lit(1 + len(fits)).cast("bigint").alias("n_fits"),
        F.lit(same).alias("resumed_equal"),
    )


@contextmanager
def _counted_fits(fits: list):
    """Fits of the jobs are noted in ``fits`` while this lasts."""
    fit = jobs.fit
    jobs.fit = lambda *arguments: fits.append(1) or fit(*arguments)
    try:
        yield
    finally:
        jobs.fit = fit


@query("churn_job_check", _SAME_METRICS_SQL)
def churn_job_check(spark, sf):
    done = _churn_job(spark, sf)

    def resume(fits):
        view = training.churn_training_view(planted_subscribers(spark, sf), _viewing(spark, sf), LINE_GENRES)
        register_views({"checked_churn_view": view})
        with _counted_fits(fits):
            return train_churn_model(
                scan_view(spark, "checked_churn_view"), done.result.output, done.registry,
                "v1", 1, genres=LINE_GENRES, resume=True,
            )

    return _recomputed(spark, done, resume)


@query("propensity_job_check", _SAME_METRICS_SQL)
def propensity_job_check(spark, sf):
    done = _propensity_job(spark, sf)

    def resume(fits):
        view = training.upsell_training_view(planted_subscribers(spark, sf), _viewing(spark, sf), LINE_GENRES)
        register_views({"checked_upsell_view": view})
        with _counted_fits(fits):
            return train_propensity_model(
                scan_view(spark, "checked_upsell_view"), done.result.output,
                genres=LINE_GENRES, top_plan=TOP_PLAN, resume=True,
            )

    return _recomputed(spark, done, resume)


_SAME_SCORES_SQL = _account_counts_sql("count(*) AS n_accounts, CAST(0 AS BIGINT) AS n_different")


def _compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many accounts are scored, and how many differ between two scorings."""
    both = left.join(right.withColumnRenamed("score", "other"), "account_id", "full")
    return both.agg(
        F.count("*").alias("n_accounts"),
        F.count_if(~F.col("score").eqNullSafe(F.col("other"))).alias("n_different"),
    )


@query("save_load_model", _SAME_SCORES_SQL)
def save_load_model(spark, sf):
    """Scores of a saved and reloaded model next to those of the model in memory."""
    frame, model = _churn_frame(spark, sf), _churn_model(spark, sf)
    path = save_model(learning.scoring_model(model), workspace_path(spark, "model"))
    loaded = load_model(path)
    return _compared(learning.batch_score(model, frame), learning.batch_score(loaded, frame))


@query("stream_score", _SAME_SCORES_SQL)
def stream_score(spark, sf):
    """Scores of the streaming job next to batch scores of the same accounts."""
    frame, model = _churn_frame(spark, sf), _churn_model(spark, sf)
    arriving = frame.drop("label", "is_test")
    source, sink, checkpoint = (
        workspace_path(spark, f"stream-{name}") for name in ("source", "sink", "checkpoint")
    )
    materialise(arriving, source)
    running = score_stream(spark, model, source, arriving.schema, sink, checkpoint)
    running.awaitTermination()
    streamed = spark.read.parquet(sink)
    return _compared(learning.batch_score(model, frame), streamed)


@query("batch_score_check", _SAME_SCORES_SQL)
def batch_score_check(spark, sf):
    """Scores of the whole training frame next to those that the job stored."""
    stored = spark.read.parquet(f"{_churn_job(spark, sf).result.output}/scores")
    return _compared(batch_score(spark, sf), stored.select("account_id", "score"))


@query(
    "stream_score_promoted",
    with_tables("subscribers", "line_viewing")
    + "SELECT CAST(1 + s.account_id % 2 AS BIGINT) AS run, 'v' || (1 + s.account_id % 2) AS version,"
    " CAST(s.account_id % 2 AS BIGINT) AS batch, count(*) AS n_accounts, CAST(0 AS BIGINT) AS n_different"
    " FROM subscribers s JOIN line_viewing v ON s.account_id = v.account_id GROUP BY s.account_id % 2",
)
def stream_score_promoted(spark, sf):
    """Accounts arrive in two files, between which a second fitted model is promoted."""
    frame, job = _churn_frame(spark, sf), _churn_job(spark, sf)
    source, sink, checkpoint, registry = (
        workspace_path(spark, f"promoted-{name}")
        for name in ("source", "sink", "checkpoint", "registry")
    )
    quick = learning.fit(learning.churn_pipeline(LINE_GENRES, maxIter=NATURAL_ROUNDS), frame)
    scores = []
    for turn, model in enumerate((job.result.model, quick)):
        serving = learning.scoring_model(model)
        promote(serving, job.result.metrics, registry, f"v{turn + 1}", turn + 1, min_auc=0.0)
        arriving = frame.where(F.col("account_id") % 2 == turn)
        rows = arriving.drop("label", "is_test")
        rows.write.mode("append").parquet(source)
        score_stream_promoted(
            spark, registry, source, rows.schema, sink, checkpoint
        ).awaitTermination()
        scores.append(learning.batch_score(serving, arriving).withColumnRenamed("score", "wanted"))
    streamed = spark.read.parquet(sink).join(scores[0].union(scores[1]), "account_id", "full")
    return streamed.groupBy("run", "version", F.col("batch").cast("bigint").alias("batch")).agg(
        F.count("*").alias("n_accounts"),
        F.count_if(~F.col("score").eqNullSafe(F.col("wanted"))).alias("n_different"),
    )


# --- segments ---------------------------------------------------------------


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return _affinity_job(spark, sf).result.metrics


@query("assign_segments")
def assign_segments(spark, sf):
    result = _affinity_job(spark, sf).result
    affinity = spark.read.parquet(f"{result.output}/affinity")
    assigned = segments.assign_segments(result.model, affinity, affinity_columns(LINE_GENRES))
    return assigned.select("account_id", "segment")


def _centres(model: PipelineModel) -> list[list[float]]:
    return [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]


def _nearest(affinity: DataFrame, centres: list[list[float]]) -> DataFrame:
    """The nearest centre of every account, found again from the shares themselves: ``best`` is
    (squared distance, centre)."""
    columns = affinity_columns(LINE_GENRES)
    moments = affinity.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns],
    ).first()
    scaled = [(F.col(c) - moments[f"{c}_mean"]) / moments[f"{c}_sd"] for c in columns]

    def squared(centre: list[float]):
        return sum(((x - v) ** 2 for x, v in zip(scaled, centre)), F.lit(0.0))

    distances = [F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return affinity.select("account_id", F.least(*distances).alias("best"), F.array(*distances).alias("all"))


_SEGMENTS_SQL = with_tables("line_viewing") + "SELECT count(*) AS n_accounts, {} FROM line_viewing WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in affinity_columns(LINE_GENRES)
)


@query("assign_segments_check", _SEGMENTS_SQL.format("CAST(0 AS BIGINT) AS n_not_nearest"))
def assign_segments_check(spark, sf):
    """Accounts, and how many of them are not in the segment of their nearest centre (1e-9 apart
    counts as equally near). Segments are numbered by strongest genre, then by value."""
    result = _affinity_job(spark, sf).result
    centres = _centres(result.model)
    order = sorted(range(len(centres)), key=lambda i: (centres[i].index(max(centres[i])), centres[i]))
    affinity = spark.read.parquet(f"{result.output}/affinity")
    near = _nearest(affinity, [centres[i] for i in order])
    written = read_report_csv(spark, f"{result.output}/assignments", "account_id bigint, segment int")
    own = F.element_at(F.col("all"), F.col("segment") + 1)["d"]
    away = F.coalesce(own > F.col("best.d") + 1e-9, F.lit(True))
    both = near.join(written, "account_id", "full")
    return both.agg(F.count("*").alias("n_accounts"), F.count_if(away).alias("n_not_nearest"))


@query(
    "kmeans_sweep_check",
    _SEGMENTS_SQL.format("CAST(6 AS BIGINT) AS n_candidates, TRUE AS inertia_equal, TRUE AS best_is_selected"),
)
def kmeans_sweep_check(spark, sf):
    """The selected candidate has the best silhouette, the smallest k of several, and the inertia
    that its centres give."""
    result = _affinity_job(spark, sf).result
    affinity = spark.read.parquet(f"{result.output}/affinity")
    near = _nearest(affinity, _centres(result.model))
    found = near.agg(F.count("*").alias("n_accounts"), F.sum("best.d").alias("inertia")).first()
    chosen = F.max_by("k", F.struct(F.col("silhouette"), -F.col("k")))
    inertia = F.max(F.when(F.col("selected"), F.col("inertia")))
    return result.metrics.agg(
        F.lit(found["n_accounts"]).cast("bigint").alias("n_accounts"),
        F.count("*").alias("n_candidates"),
        (F.abs(inertia / F.lit(found["inertia"]) - 1) < 1e-9).alias("inertia_equal"),
        (chosen == F.max(F.when(F.col("selected"), F.col("k")))).alias("best_is_selected"),
    )


# --- jobs -------------------------------------------------------------------


@query(
    "affinity_job_check",
    _SEGMENTS_SQL.format("TRUE AS once_each, TRUE AS profile_adds_up, TRUE AS resumed_equal"),
)
def affinity_job_check(spark, sf):
    """Assignments and profile as written, and a second start that finds every step done."""
    result = _affinity_job(spark, sf).result
    written = read_report_csv(spark, f"{result.output}/assignments", "account_id bigint, segment int")
    again = affinity_job(
        line_activity(spark, sf), result.output, genres=LINE_GENRES, digits=HOUR_DIGITS, resume=True
    )
    same = result.metrics.exceptAll(again.metrics).isEmpty()
    profile = spark.read.option("header", True).csv(f"{result.output}/profile")
    total = profile.agg(F.sum(F.col("n_accounts").cast("bigint"))).scalar()
    return written.agg(
        F.count("*").alias("n_accounts"),
        (F.count("*") == F.count_distinct("account_id")).alias("once_each"),
        (total == F.count("*")).alias("profile_adds_up"),
        F.lit(same).alias("resumed_equal"),
    )


@query("churn_training_job")
def churn_training_job_query(spark, sf):
    """Metrics of the job; if its model was promoted, it is read back and scores (else 0 rows)."""
    job = _churn_job(spark, sf)
    n_scored = F.lit(0).cast("bigint")
    if job.result.passed:
        current = load_current_model(spark, job.registry)
        scored = learning.batch_score(current, _churn_frame(spark, sf))
        n_scored = scored.agg(F.count("score")).scalar()
    return job.result.metrics.select(
        "*", F.lit(job.result.passed).alias("passed"), n_scored.alias("n_scored")
    )


@query("propensity_training_job")
def propensity_training_job_query(spark, sf):
    return _propensity_job(spark, sf).result.metrics


@query("affinity_job")
def affinity_job_query(spark, sf):
    output = _affinity_job(spark, sf).result.output
    return read_report_csv(spark, f"{output}/assignments", "account_id bigint, segment int")
