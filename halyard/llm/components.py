"""Connected components of a graph given as links, without collecting any part of it.

Alternating large-star and small-star steps: each node links its larger neighbours (or itself
and its smaller ones) to the smallest node that it knows. Every step is an aggregation and a
join; after O(log(n) ** 2) rounds each node is linked to the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.llm.tables import discard, stored

#: A node may hold a large share of all links (the centre of a star), so links to one node are
#: dealt over this many parts, and its minimum is sent to each part.
SALTS = 16


def _to_minimum(links: DataFrame, at: str, minima: DataFrame) -> DataFrame:
    """``links`` with ``m``, the minimum that ``minima`` (u, m) has for the node in ``at``."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int")
    return links.withColumn("salt", salt).join(
        minima.select(F.col("u").alias(at), "m", parts.alias("salt")), [at, "salt"]
    )


def _large_star(links: DataFrame) -> DataFrame:
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
    minima = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _to_minimum(links, "b", minima).select("a", F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    minima = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = _to_minimum(links, "a", minima).where(F.col("b") != F.col("m"))
    others = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(minima.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    sums = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    )
    return tuple(sums.first())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with a link to
    another one.

    ``links`` has columns ``a`` and ``b`` of one ordered type; direction and repeats do not
    matter, links of a node to itself or with a null end are ignored. No links give no rows.
    """
    larger = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stored(larger.distinct(), "links")
    state = _state(current)
    while state[0]:
        large = stored(_large_star(current), "links")
        small = stored(_small_star(large), "links")
        discard(large)
        discard(current)
        before, state, current = state, _state(small), small
        if before == state:
            break
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
