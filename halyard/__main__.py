"""Run a job from the command line, for example with spark-submit.

    python -m halyard churn --subscribers S --activity A --output O --registry R --version V --run N
    python -m halyard churn --view features.churn_training_view --output O --registry R ...
    python -m halyard propensity --subscribers S --activity A --output O
    python -m halyard affinity --activity A --output O
    python -m halyard views --subscribers S --activity A --output O
    python -m halyard score --registry R --accounts P --output O
    python -m halyard stream --registry R --source P --like P --output O --checkpoint C
    python -m halyard offers --scores P --budget N --output O
    python -m halyard retention --scores P --segmented P --output O

Tables are CSV with header, or parquet where the path ends in ``.parquet``; scores, segmented and
arriving accounts are parquet. ``--view`` names a table or view of the session's catalogue in place
of the two base tables. ``--digits`` makes sums of hours exact, ``--missing-month null`` tells an absent
month from one without hours, and ``--resume`` takes up a job that lost its driver. Cluster
settings, with spark.checkpoint.dir among them, come from the session's configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from halyard.contract import MIN_PROMOTION_AUC, SUBSCRIBERS, TOP_DECILE, TOP_PLAN, activity_schema
from halyard.operators.learning import batch_score
from halyard.operators.segments import segment_profile
from halyard.operators.targeting import offer_list, retention_targets
from halyard.operators.viewing import viewing_features
from halyard.plans.jobs import (
    affinity_job,
    churn_training_job,
    propensity_training_job,
    segment_accounts,
    train_churn_model,
    train_propensity_model,
)
from halyard.plans.promotion import load_current_model
from halyard.plans.views import views_over
from halyard.sources.tables import conform, materialise, read_csv, scan_view
from halyard.streaming import score_stream_promoted

NEEDED = {
    "churn": ("output", "registry", "version", "run"),
    "propensity": ("output",),
    "affinity": ("output",),
    "views": ("subscribers", "activity", "output"),
    "score": ("registry", "accounts", "output"),
    "stream": ("registry", "source", "like", "output", "checkpoint"),
    "offers": ("scores", "output"),
    "retention": ("scores", "segmented", "output"),
}
BASE_TABLES = {
    "churn": ("subscribers", "activity"),
    "propensity": ("subscribers", "activity"),
    "affinity": ("activity",),
}


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return conform(spark.read.parquet(path), schema)
    return read_csv(spark, path, schema)


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="halyard", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, names in NEEDED.items():
        options = jobs.add_parser(job)
        for name in names:
            options.add_argument(f"--{name}", required=True, type=int if name == "run" else str)
        if job in BASE_TABLES:
            for name in (*BASE_TABLES[job], "view"):
                options.add_argument(f"--{name}")
            options.add_argument("--resume", action="store_true")
        if job in (*BASE_TABLES, "views"):
            options.add_argument("--digits", type=int)
            options.add_argument("--missing-month", choices=("zero", "null"), default="zero")
        if job == "churn":
            options.add_argument("--min-auc", type=float, default=MIN_PROMOTION_AUC)
        if job == "propensity":
            options.add_argument("--top-plan", default=TOP_PLAN)
        if job == "stream":
            options.add_argument("--every", help="keep running, with a batch this often")
        if job == "offers":
            options.add_argument("--budget", type=float, required=True)
            options.add_argument("--cost", help="column with an account's cost; 1 each without it")
        if job == "retention":
            options.add_argument("--quantile", type=float, default=TOP_DECILE)
    args = parser.parse_args()
    base = BASE_TABLES.get(args.job, ())
    if base and bool(args.view) == any(getattr(args, name) for name in base):
        parser.error(f"{args.job} needs either --view or {' and '.join('--' + n for n in base)}")
    if base and not args.view and not all(getattr(args, name) for name in base):
        parser.error(f"{args.job} needs {' and '.join('--' + n for n in base)}")
    return args


def _features(args: argparse.Namespace) -> dict[str, object]:
    return {"digits": args.digits, "missing_month": args.missing_month}


def _train(spark: SparkSession, args: argparse.Namespace, tables: list[DataFrame]) -> DataFrame:
    """The metrics of one of the three jobs."""
    own: dict[str, object] = {"resume": args.resume}
    place: tuple = (args.output,)
    if args.job == "churn":
        place += (args.registry, args.version, args.run)
        own["min_auc"] = args.min_auc
    if args.job == "propensity":
        own["top_plan"] = args.top_plan
    jobs = {
        "churn": (churn_training_job, train_churn_model),
        "propensity": (propensity_training_job, train_propensity_model),
        "affinity": (affinity_job, segment_accounts),
    }
    from_tables, from_view = jobs[args.job]
    if args.view:
        return from_view(scan_view(spark, args.view), *place, **own).metrics
    return from_tables(*tables, *place, **_features(args), **own).metrics


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.appName(f"halyard-{args.job}").getOrCreate()
    schemas = {"subscribers": SUBSCRIBERS, "activity": activity_schema()}
    tables = {
        name: _read(spark, getattr(args, name), schema)
        for name, schema in schemas.items()
        if getattr(args, name, None)
    }
    if args.job in BASE_TABLES:
        _train(spark, args, list(tables.values())).show(truncate=False)
    elif args.job == "views":
        features = viewing_features(tables["activity"], **_features(args))
        viewing = materialise(features, f"{args.output}/viewing_features")
        for name, view in views_over(tables["subscribers"], viewing).items():
            if name != "viewing_features":
                materialise(view, f"{args.output}/{name}")
    elif args.job == "score":
        model = load_current_model(spark, args.registry)
        materialise(batch_score(model, spark.read.parquet(args.accounts)), args.output)
    elif args.job == "stream":
        schema = spark.read.parquet(args.like).schema
        score_stream_promoted(
            spark, args.registry, args.source, schema, args.output, args.checkpoint, every=args.every
        ).awaitTermination()
    elif args.job == "offers":
        scores = spark.read.parquet(args.scores)
        materialise(offer_list(scores, args.budget, cost=args.cost), args.output)
    else:
        segmented = spark.read.parquet(args.segmented)
        targets = retention_targets(
            spark.read.parquet(args.scores), segmented, segment_profile(segmented), args.quantile
        )
        materialise(targets, args.output)


if __name__ == "__main__":
    main()
