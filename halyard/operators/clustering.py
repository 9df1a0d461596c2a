"""Many k-means fits of the same rows at once: every pass over the rows serves all of them.

The number of Spark jobs is that of the longest fit, however many there are. Only centres and sums per
cluster reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: Spark ML's own defaults ----------------------------------
MAX_ITERATIONS = 20
TOLERANCE = 1e-4
START_DRAWS, OVERSAMPLING, START_ITERATIONS = 2, 2, 30
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Clusters:
    """The centres of a fit and the sum of the squared distances of all rows to the nearest."""

    centres: np.ndarray
    cost: float


def _points(batch: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    return np.array([batch[c].to_numpy() for c in columns]).T


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the nearest centre, the first one on ties, and the squared distance to it."""
    nearest, least = np.zeros(len(points), np.intp), np.full(len(points), np.inf)
    for i, centre in enumerate(centres):
        squared = np.zeros(len(points))
        for x, c in zip(points.T, centre):
            gap = x - c
            squared += gap * gap
        nearest[squared < least] = i
        np.minimum(least, squared, out=least)
    return nearest, least


def _draw(
    rows: DataFrame,
    columns: Sequence[str],
    key: str,
    seeds: Sequence[int],
    chosen: Sequence[np.ndarray],
    size: int,
) -> list[np.ndarray]:
    """Per seed up to ``size`` more rows, drawn with chances in proportion to their squared distance
    from the seed's rows so far; any row is as likely as another where there are none.

    Every row waits for an exponential time, taken from a hash of the row, over that distance;
    those that wait least are drawn. So one pass is enough, and partitioning does not matter."""

    def wait(seed: int, turn: int) -> F.Column:
        hashed = F.shiftrightunsigned(F.xxhash64(key, *columns, F.lit(seed), F.lit(turn)), 12)
        return -F.log((hashed + F.lit(0.5)) / F.lit(2.0**52))

    waits = [wait(s, len(c)).alias(f"wait{i}") for i, (s, c) in enumerate(zip(seeds, chosen))]

    def shortest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {i: (np.empty(0), np.empty((0, len(columns)))) for i in range(len(seeds))}
        for batch in batches:
            points = _points(batch, columns)
            for i, centres in enumerate(chosen):
                time = batch[f"wait{i}"].to_numpy()
                if len(centres):
                    with np.errstate(divide="ignore"):
                        time = time / _nearest(points, centres)[1]
                time, at = np.append(found[i][0], time), np.vstack([found[i][1], points])
                least = np.argsort(time, kind="stable")[:size]
                found[i] = time[least], at[least]
        for i, (time, at) in found.items():
            away = np.isfinite(time)
            if away.any():
                yield pd.DataFrame({"seed": i, "time": time[away], "point": at[away].tolist()})

    drawn = rows.select(*columns, *waits).mapInPandas(
        shortest, "seed int, time double, point array<double>"
    )
    place = F.row_number().over(Window.partitionBy("seed").orderBy("time", "point"))
    first = drawn.withColumn("place", place).where(F.col("place") <= size).orderBy("seed", "place")
    more: list[list[list[float]]] = [[] for _ in seeds]
    for row in first.collect():
        more[row["seed"]].append(row["point"])
    return [np.vstack([c, *m]) for c, m in zip(chosen, more)]


def _fit_weighted(points: np.ndarray, weights: np.ndarray, k: int, seed: Sequence[int]) -> np.ndarray:
    """At most ``k`` centres of few weighted points: k-means++ and some steps."""
    if len(points) <= k:
        return points
    random = np.random.default_rng(seed)
    chance, centres = weights, np.empty((0, points.shape[1]))
    while len(centres) < k:
        drawn = random.choice(len(points), p=chance / chance.sum())
        centres = np.vstack([centres, points[drawn]])
        chance = weights * _nearest(points, centres)[1]
    for _ in range(START_ITERATIONS):
        nearest, _ = _nearest(points, centres)
        shares = np.eye(k)[nearest] * weights[:, None]
        n = shares.sum(axis=0)[:, None]
        centres = np.where(n > 0, shares.T @ points / np.maximum(n, 1), centres)
    return centres


def _first_centres(
    rows: DataFrame, columns: Sequence[str], key: str, k_range: Sequence[int], seeds: Sequence[int]
) -> dict[tuple[int, int], np.ndarray]:
    """Per k and seed the centres that a fit starts from (k-means||): a row, then rows far from
    those before it, in few draws; they count for the rows nearest to them and are clustered."""
    chosen = [np.empty((0, len(columns))) for _ in seeds]
    for size in (1, *[OVERSAMPLING * max(k_range)] * START_DRAWS):
        chosen = _draw(rows, columns, key, seeds, chosen, size)
    distinct = {i: np.unique(points, axis=0) for i, points in enumerate(chosen)}
    near = _cluster_sums(rows, columns, distinct)
    return {
        (k, i): _fit_weighted(distinct[i], near[i][:, 0], k, (seed % 2**32, k))
        for k in k_range
        for i, seed in enumerate(seeds)
    }


def _cluster_sums(
    rows: DataFrame, columns: Sequence[str], fits: Mapping[int, np.ndarray]
) -> dict[int, np.ndarray]:
    """Per fit a line for each centre: the number of rows nearest to it, the sum of their squared
    distances and the sums of their columns."""
    names = ["n", "cost", *[f"sum{d}" for d in range(len(columns))]]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {f: np.zeros((len(centres), len(names))) for f, centres in fits.items()}
        for batch in batches:
            points = _points(batch, columns)
            for f, centres in fits.items():
                nearest, least = _nearest(points, centres)
                for j, v in enumerate((None, least, *points.T)):
                    totals[f][:, j] += np.bincount(nearest, v, len(centres))
        for f, total in totals.items():
            lines = pd.DataFrame(total, columns=names)
            lines.insert(0, "centre", np.arange(len(total)))
            lines.insert(0, "fit", f)
            yield lines

    declared = "fit int, centre int, " + ", ".join(f"{n} double" for n in names)
    parts = rows.select(*columns).mapInPandas(sums, declared)
    found = {f: np.zeros((len(centres), len(names))) for f, centres in fits.items()}
    for row in parts.groupBy("fit", "centre").agg(*[F.sum(n).alias(n) for n in names]).collect():
        found[row["fit"]][row["centre"]] = row[2:]
    return found


def fit_all(
    rows: DataFrame,
    columns: Sequence[str],
    key: str,
    k_range: Sequence[int],
    seeds: Sequence[int],
) -> dict[int, Clusters]:
    """Per k the fit with the lowest cost over all seeds, the first one on ties.

    All fits that still move take each step in the same pass. A fit ends when no centre moves
    further than the tolerance, or after the last step; its cost is that of the centres it
    returns. A centre without rows stays. With fewer distinct rows than k there are fewer centres.
    """
    starts = _first_centres(rows, columns, key, k_range, seeds)
    tries = list(starts)
    centres = dict(enumerate(starts.values()))
    cost: dict[int, float] = {}
    moving = set(centres)
    for step in range(MAX_ITERATIONS + 1):
        left = {at: centres[at] for at in centres if at not in cost}
        if not left:
            break
        for at, total in _cluster_sums(rows, columns, left).items():
            if at not in moving or step == MAX_ITERATIONS:
                cost[at] = float(total[:, 1].sum())
                continue
            n = total[:, :1]
            moved = np.where(n > 0, total[:, 2:] / np.maximum(n, 1), centres[at])
            if (((moved - centres[at]) ** 2).sum(axis=1) <= TOLERANCE**2).all():
                moving.remove(at)
            centres[at] = moved
    found: dict[int, Clusters] = {}
    for at, (k, _) in enumerate(tries):
        if k not in found or cost[at] < found[k].cost:
            found[k] = Clusters(centres[at], cost[at])
    return found
