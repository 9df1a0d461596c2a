"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated Poisson(rate_s) times, where rate_s brings the source to its
target share of the output. The count is the inverse of the Poisson distribution at a number in
[0, 1) that a seeded hash of the document gives, so it depends on nothing but the document:
not on partitioning, order or retries. Copies are then dealt over the whole output by a hash.

A rate above ``MAX_STEP`` is the sum of equal smaller Poisson variables, each with a hash of its
own, which is again exactly Poisson and keeps ``exp(-rate)`` far from underflow.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.tables import partitions_for

MAX_STEP = 32.0
HASH_DIGITS = 13
#: Sources up to this number are broadcast (a few MB); more are joined by a shuffle with salt.
BROADCAST_SOURCES = 10_000
SALTS = 16


def hash_fraction(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, joined by colons; null counts as ''."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")
    return digits.cast("double") / F.lit(float(16**HASH_DIGITS))


def repetition_rates(
    docs: DataFrame, weights: Mapping[str, float] | None, total: int | None = None
) -> DataFrame:
    """One row per source: ``source``, ``rate``, ``steps`` and ``table``, the distribution
    function of Poisson(rate / steps) at 0, 1, ...

    ``total`` is the expected number of output rows (as many as come in by default).
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.lit(1.0))
    else:
        if any(not (w >= 0 and math.isfinite(w)) for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        known = F.create_map(*[F.lit(x) for item in weights.items() for x in item])
        weight = F.coalesce(F.element_at(known, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
        counts = counts.withColumn("weight", weight.cast("double"))
    sums = counts.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    rows = sums.select("rows").scalar() if total is None else F.lit(total)
    all_weights = sums.select("weights").scalar()
    share = F.try_divide(F.col("weight"), all_weights)
    rated = counts.select("source", F.coalesce(share * rows / F.col("n"), F.lit(0.0)).alias("rate"))
    stepped = rated.withColumn("steps", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_STEP)))
    step = F.col("rate") / F.col("steps")
    reach = F.ceil(step + 12 * F.sqrt(step) + 24).cast("int")
    first = F.exp(-step)
    added = F.reduce(
        F.sequence(F.lit(1), reach),
        F.struct(first.alias("p"), F.array(first).alias("cdf")),
        lambda so_far, k: F.struct(
            (so_far["p"] * step / k).alias("p"),
            F.array_append(
                so_far["cdf"], F.element_at(so_far["cdf"], -1) + so_far["p"] * step / k
            ).alias("cdf"),
        ),
        lambda done: done["cdf"],
    )
    return stepped.withColumn("table", added)


def poisson_counts(docs: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """Add ``__copies``, the number of times each document is repeated."""
    if rates.count() <= BROADCAST_SOURCES:
        rated = docs.join(F.broadcast(rates), docs["source"].eqNullSafe(rates["__source"]))
    else:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        salted = rates.withColumn("__salt", F.explode(salts))
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        rated = docs.join(
            salted, docs["source"].eqNullSafe(salted["__source"]) & (salt == salted["__salt"])
        )
    fractions = F.transform(
        F.sequence(F.lit(1), F.col("steps").cast("int")),
        lambda i: hash_fraction(F.lit(seed), F.col("doc_id"), i),
    )
    draws = F.transform(fractions, lambda u: F.size(F.filter(F.col("table"), lambda c: c <= u)))
    return rated.withColumn("__copies", F.reduce(draws, F.lit(0), lambda a, b: a + b))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    *,
    total: int | None = None,
    seed: int = 17,
    with_copy: bool = False,
) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a global random order.

    ``weights`` maps a source to its target share (normalised here); None gives every source
    that occurs the same share. With weights given, a source that they do not name is not
    wanted, so it has weight 0. A null source is a source of its own, which only ``None``
    weights reach. Copies of one row are equal; ``with_copy`` adds ``copy`` (from 1), in place of
    a column of that name in any case. Rows that share a doc_id draw the same count; null ids draw as empty text. Texts are not looked at,
    so null, empty and long ones are rows like others. An empty table, or weights that are all
    0, give no rows. Extra columns are carried along.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
        F.col("doc_id"),
        F.col("source"),
    )
    rates = repetition_rates(docs.select("source"), weights, total).withColumnRenamed(
        "source", "__source"
    )
    drawn = poisson_counts(packed, rates, seed).where("__copies > 0")
    copies = drawn.select(
        "__doc", "doc_id", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")
    )
    place = F.xxhash64(F.lit(seed), F.col("__doc"), F.col("__copy"))
    shuffled = copies.withColumn("__place", place).repartition(
        partitions_for(docs.sparkSession), "__place"
    ).sortWithinPartitions("__place")
    added = [F.col("__copy").cast("long").alias("copy")] if with_copy else []
    own = [c for c in docs.columns if not (with_copy and c.lower() == "copy")]
    return shuffled.select(*[F.col(f"__doc.`{c}`") for c in own], *added)
