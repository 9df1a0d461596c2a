"""Exact, repeatable row selection: stratified train/test split and fixed-size samples.

Rows are ordered by a hash of key and seed, so a row's place depends on nothing but its key:
not on partitioning, file order or retries. Counting rows per hash prefix finds the prefix in
which the quota runs out; only rows of that prefix are ranked. The selection itself is a
comparison with one cut-off per stratum, so wide rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.contract import SEED, TEST_PERCENT

_PREFIX_DIGITS = 3


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _place(hashed: Column, key: str) -> Column:
    return F.struct(hashed.alias("hash"), F.col(key).alias("key"))


def _with_test_quotas(cells: DataFrame, percent: int) -> DataFrame:
    """Add ``take``, the rows to take per stratum: the rounded-up total by largest remainder."""
    everything = Window.partitionBy()
    once = F.col("through") == F.col("n")
    exact = "cast(take_all as decimal(18,0)) * cast(n_stratum as decimal(18,0))"
    shared = (
        cells.withColumn("n_all", F.sum("n").over(everything))
        .withColumn("take_all", F.expr(f"({percent} * n_all + 99) div 100"))
        .withColumn("base", F.expr(f"({exact}) div n_all"))
        .withColumn("remainder", F.expr(f"({exact}) % n_all"))
    )
    place = F.dense_rank().over(Window.orderBy(F.desc("remainder"), F.asc("stratum")))
    left_over = F.col("take_all") - F.sum(F.when(once, F.col("base"))).over(everything)
    return shared.withColumn("take", F.col("base") + F.when(place <= left_over, 1).otherwise(0))


def _boundary(cells: DataFrame, wanted: str) -> DataFrame:
    """Of counted prefixes (stratum, prefix, n, ``wanted``) the one in which each stratum's quota
    runs out, and how many of its rows are ``needed``."""
    running = F.sum("n").over(Window.partitionBy("stratum").orderBy("prefix"))
    before = F.col("through") - F.col("n")
    return (
        cells.withColumn("through", running)
        .where((before < F.col(wanted)) & (F.col(wanted) <= F.col("through")))
        .select("stratum", "prefix", (F.col(wanted) - before).alias("needed"))
    )


def _at_boundary(rows: DataFrame, boundary: DataFrame) -> DataFrame:
    matched = rows.join(F.broadcast(boundary), "stratum")
    return matched.where(F.col("hash").startswith(F.col("prefix")))


def _cut_offs(rows: DataFrame, with_quotas: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Last (hash, key) to take in each stratum.

    There are 4,096 hash prefixes, so the windows see at most that many rows per stratum. The
    rows of the boundary prefix are counted by a longer prefix again, so the rows ranked at
    last are about one in 16.8 million.
    """
    in_stratum = Window.partitionBy("stratum")
    cells = (
        rows.groupBy("stratum", F.substring("hash", 1, _PREFIX_DIGITS).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("through", F.sum("n").over(in_stratum.orderBy("prefix")))
        .withColumn("n_stratum", F.sum("n").over(in_stratum))
    )
    coarse = _boundary(with_quotas(cells), "take")
    longer = F.substring("hash", 1, 2 * _PREFIX_DIGITS).alias("prefix")
    inside = _at_boundary(rows, coarse).groupBy("stratum", "needed", longer)
    fine = _boundary(inside.agg(F.count(F.lit(1)).alias("n")), "needed")
    ranked = _at_boundary(rows, fine).withColumn(
        "place", F.row_number().over(in_stratum.orderBy("hash", "key"))
    )
    return ranked.where(F.col("place") == F.col("needed")).select(
        "stratum", F.struct("hash", "key").alias("last")
    )


def stratified_split(
    frame: DataFrame,
    key: str = "account_id",
    label: str = "label",
    percent: int = TEST_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Add boolean ``is_test``: ceil(percent of n) rows, each class in proportion.

    ``key`` is unique and ``label`` is not null.
    """
    hashed = hash_order(key, seed)
    rows = frame.select(
        F.col(label).alias("stratum"), hashed.alias("hash"), F.col(key).alias("key")
    )
    cut_offs = _cut_offs(rows, lambda cells: _with_test_quotas(cells, percent))
    taken = _place(hashed, key) <= F.col("last")
    marked = frame.join(F.broadcast(cut_offs), F.col(label) == F.col("stratum"), "left")
    return marked.select(
        *[frame[c] for c in frame.columns], F.coalesce(taken, F.lit(False)).alias("is_test")
    )


def hash_sample(frame: DataFrame, size: int, key: str = "account_id", seed: int = SEED) -> DataFrame:
    """``size`` rows without replacement (all rows if there are fewer), the same on every run."""
    hashed = hash_order(key, seed)
    rows = frame.select(F.lit(0).alias("stratum"), hashed.alias("hash"), F.col(key).alias("key"))

    def quota(cells: DataFrame) -> DataFrame:
        return cells.withColumn("take", F.least(F.lit(size), F.col("n_stratum")))

    last = _cut_offs(rows, quota).select("last").scalar()
    return frame.where(_place(hashed, key) <= last)
