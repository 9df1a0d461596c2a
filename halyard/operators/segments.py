"""Content personas: clustering on genre shares, silhouettes and segment profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.contract import GENRES, SEED, affinity_columns
from halyard.functions.scalar import first_largest, round_half_away
from halyard.operators.clustering import Clusters, fit_all
from halyard.operators.splitting import hash_sample
from halyard.sources.tables import materialise
from halyard.sources.workspace import workspace_path

# --- fixed values: search range and sampling --------------------------------
K_RANGE = range(3, 9)
RESTARTS = 10
SILHOUETTE_SAMPLE = 5_000
SHARE_DIGITS = 3
SILHOUETTE_DIGITS = 4
# --- end of fixed values ----------------------------------------------------

#: Sampled rows that a task compares with as many others.
PART = 512
_VECTOR = "__scaled"


def _sample_parts(
    sample: DataFrame, dimensions: Sequence[str], names: Sequence[str], key: str, parts: int
) -> DataFrame:
    """The sample dealt by key into parts, a row per part: its number, the points one after the
    other, and the clusters that each assignment gives them."""
    row = F.struct(
        key,
        F.array(*[F.col(c) for c in dimensions]).alias("point"),
        F.array(*[F.col(a) for a in names]).alias("clusters"),
    )
    dealt = sample.select(F.pmod(F.xxhash64(key), F.lit(parts)).alias("part"), row.alias("row"))
    return (
        dealt.groupBy("part")
        .agg(F.array_sort(F.collect_list("row")).alias("rows"))
        .select("part", F.col("rows.point").alias("points"), F.col("rows.clusters").alias("clusters"))
    )


def _distance_sums(batches: Iterator) -> Iterator:
    """Per pair of parts: for every row of the first and every cluster of the second, the number
    of the cluster's rows there and the sum of the distances to them."""
    import numpy as np
    import pandas as pd

    for batch in batches:
        for pair in batch.itertuples(index=False):
            mine, theirs = np.stack(pair.points), np.stack(pair.other_points)
            squared = np.zeros((len(mine), len(theirs)))
            for d in range(mine.shape[1]):
                squared += (mine[:, d, None] - theirs[None, :, d]) ** 2
            distances = np.sqrt(squared)
            own, other = np.stack(pair.clusters), np.stack(pair.other_clusters)
            for a in range(own.shape[1]):
                groups, member, sizes = np.unique(other[:, a], return_inverse=True, return_counts=True)
                sums = distances @ np.eye(len(groups))[member]
                n = len(mine)
                yield pd.DataFrame(
                    {
                        "assignment": a,
                        "part": pair.part,
                        "row": np.repeat(np.arange(n), len(groups)),
                        "own": np.repeat(own[:, a], len(groups)),
                        "cluster": np.tile(groups, n),
                        "total": sums.ravel(),
                        "n": np.tile(sizes, n),
                    }
                )


def sampled_silhouette(
    frame: DataFrame,
    columns: Sequence[str],
    assignments: Sequence[str],
    sample_size: int = SILHOUETTE_SAMPLE,
    key: str = "account_id",
    seed: int = SEED,
) -> DataFrame:
    """Mean Euclidean silhouette of a fixed-size sample, for one or more assignments.

    The table is read once, for the sample, which is stored in parts. Every part meets every
    other in a task of its own, which sums distances per cluster; the sums are added up by row
    and cluster. No row passes the driver, and a larger sample is more tasks of the same size.
    All assignments use the same sample and the same distances. A singleton scores 0. With
    fewer than two clusters in the sample there is no silhouette (null).
    """
    needed = frame.select(
        key,
        *[F.col(c).cast("double").alias(c) for c in columns],
        *[F.col(a).cast("int").alias(a) for a in assignments],
    )
    drawn = hash_sample(needed, sample_size, key, seed)
    spark = frame.sparkSession
    sample = materialise(drawn, workspace_path(spark, "silhouette-sample"))
    count = -(-sample.count() // PART)
    parts = materialise(
        _sample_parts(sample, columns, assignments, key, max(count, 1)),
        workspace_path(spark, "silhouette-parts"),
    )
    others = parts.select(
        F.col("part").alias("other"),
        F.col("points").alias("other_points"),
        F.col("clusters").alias("other_clusters"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    met = parts.withColumn("other", every).join(others, "other")
    sums = met.repartition("part", "other").mapInPandas(
        _distance_sums,
        "assignment int, part bigint, row bigint, own int, cluster int, total double, n bigint",
    )
    to_cluster = sums.groupBy("assignment", "part", "row", "own", "cluster").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    inside = F.col("own") == F.col("cluster")
    sides = to_cluster.groupBy("assignment", "part", "row").agg(
        F.max(F.when(inside & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~inside, F.col("total") / F.col("n"))).alias("b"),
    )
    larger = F.nullif(F.greatest("a", "b"), F.lit(0.0))
    value = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / larger, F.lit(0.0))
    )
    name = F.element_at(F.array(*[F.lit(a) for a in assignments]), F.col("assignment") + 1)
    alone = F.max("b").isNull()
    return sides.groupBy(name.alias("assignment")).agg(
        F.when(~alone, F.avg(value)).alias("silhouette"), F.count(F.lit(1)).alias("n_sampled")
    )


def full_silhouette(frame: DataFrame, columns: Sequence[str], assignment: str) -> DataFrame:
    """Silhouette over all rows with squared Euclidean distance: linear cost, no sample."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol=_VECTOR).transform(
        frame.withColumn(assignment, F.col(assignment).cast("int"))
    )
    value = ClusteringEvaluator(featuresCol=_VECTOR, predictionCol=assignment).evaluate(vectors)
    return frame.sparkSession.createDataFrame(
        [(assignment, value)], "assignment string, silhouette_squared double"
    )


def scaling_stage(frame: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    """Centre and scale by the population deviation, as a stage that can be saved with the model.

    Only one row of means and deviations reaches the driver.
    """
    moments = frame.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[
            F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_sd")
            for c in columns
        ],
    ).first()
    scaled = ", ".join(
        f"(`{c}` - ({moments[f'{c}_mean']!r}D)) / {moments[f'{c}_sd']!r}D AS `{c}_scaled`"
        for c in columns
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


@dataclass(frozen=True)
class KMeansSweep:
    """Result of a search over k: the model of the best k and a row per candidate."""

    model: PipelineModel
    candidates: DataFrame
    best_k: int


def _model_of(clusters: Clusters, k: int, seed: int, spark: SparkSession) -> KMeansModel:
    """Spark ML's model with these centres: fitted on them alone, each is a cluster of its own."""
    centres = spark.range(0, 1, 1, 1).select(F.explode(F.lit(clusters.centres.tolist())).alias("at"))
    learner = KMeans(
        k=k, seed=seed, initMode="random", solver="row", featuresCol=_VECTOR, predictionCol="segment"
    )
    return learner.fit(centres.select(array_to_vector("at").alias(_VECTOR)))


def kmeans_sweep(
    affinity: DataFrame,
    columns: Sequence[str] = tuple(affinity_columns(GENRES)),
    k_range: Sequence[int] = K_RANGE,
    restarts: int = RESTARTS,
    sample_size: int = SILHOUETTE_SAMPLE,
    key: str = "account_id",
    seed: int = SEED,
) -> KMeansSweep:
    """Fit each k several times, keep the lowest cost, choose k by sampled silhouette.

    All fits go over the same stored vectors together, a pass per step, so a lost executor costs
    no recomputation of features. The winning fit is reused, not refitted.
    """
    scaling = scaling_stage(affinity, columns)
    scaled_columns = [f"{c}_scaled" for c in columns]
    assembler = VectorAssembler(inputCols=scaled_columns, outputCol=_VECTOR)
    vectors = assembler.transform(scaling.transform(affinity.select(key, *columns)))
    vectors = materialise(vectors, workspace_path(affinity.sparkSession, "kmeans-vectors"))
    seeds = [seed + i for i in range(restarts)]
    fits = fit_all(vectors, scaled_columns, key, k_range, seeds)
    models = {k: _model_of(clusters, k, seed, affinity.sparkSession) for k, clusters in fits.items()}
    assigned = vectors
    for k, fitted in models.items():
        assigned = (
            fitted.transform(assigned).withColumn(f"k{k}", F.col("segment")).drop("segment")
        )
    silhouettes = {
        row["assignment"]: row["silhouette"]
        for row in sampled_silhouette(
            assigned, scaled_columns, [f"k{k}" for k in models], sample_size, key, seed
        ).collect()
    }
    candidates = affinity.sparkSession.createDataFrame(
        [(k, clusters.cost, silhouettes[f"k{k}"]) for k, clusters in fits.items()],
        "k int, inertia double, silhouette double",
    ).withColumn("silhouette", round_half_away(F.col("silhouette"), SILHOUETTE_DIGITS))
    rounded = {row["k"]: row["silhouette"] for row in candidates.collect()}
    best_k = max(rounded, key=lambda k: (rounded[k] is not None, rounded[k] or 0.0, -k))
    return KMeansSweep(PipelineModel([scaling, assembler, models[best_k]]), candidates, best_k)


def assign_segments(
    model: PipelineModel,
    affinity: DataFrame,
    columns: Sequence[str] = tuple(affinity_columns(GENRES)),
) -> DataFrame:
    """Add ``segment`` to each account, with ids that do not depend on the fit's random start.

    Centres (k short vectors held by the model) are ordered by their strongest genre and then by
    value; a segment's id is its place in that order.
    """
    centres = [tuple(float(x) for x in c) for c in model.stages[-1].clusterCenters()]
    strongest = [c.index(max(c)) for c in centres]
    order = sorted(range(len(centres)), key=lambda i: (strongest[i], centres[i]))
    stable = [order.index(i) for i in range(len(centres))]
    lookup = F.array(*[F.lit(s) for s in stable])
    return (
        model.transform(affinity)
        .withColumn("segment", F.element_at(lookup, F.col("segment") + 1))
        .select(*affinity.columns, "segment")
    )


def dominant_genre(frame: DataFrame, genres: Sequence[str] = GENRES) -> DataFrame:
    """Add the genre with the largest share; the first in genre order wins a tie."""
    shares = {g: F.col(c) for g, c in zip(genres, affinity_columns(genres))}
    return frame.withColumn("dominant_genre", first_largest(shares))


def segment_profile(segmented: DataFrame, genres: Sequence[str] = GENRES) -> DataFrame:
    """Per segment: mean shares, number of accounts and dominant genre of the rounded means."""
    profile = segmented.groupBy("segment").agg(
        *[round_half_away(F.avg(c), SHARE_DIGITS).alias(c) for c in affinity_columns(genres)],
        F.count(F.lit(1)).alias("n_accounts"),
    )
    return dominant_genre(profile, genres)
