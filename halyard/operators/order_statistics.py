"""Running totals, quantiles and standardisation over whole tables.

A window without a partition would send every row to one task, and ``percentile`` keeps every
distinct value in one buffer. Here a column is first cut into balanced ranges; ranges have
known totals, so a window inside each range plus the total of the ranges before it gives the
same answer with bounded work per task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halyard.functions.scalar import safe_divide

SKETCH_GROUPS = 200
#: Ranges up to which the driver merges the sketches: that many numbers per group and column.
DRIVER_RANGES = 64
_RANGE, _PART = "__range", "__part"


def _range_count(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _finite(column: str) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.when(F.abs(value) < math.inf, value)


def _weighted_cuts(sketches: list[tuple[int, Sequence[float]]], ranges: int) -> list[float]:
    """Every n-th point of several sketches, each point worth its share of the sketch's rows."""
    points = sorted((v, rows / len(values)) for rows, values in sketches for v in values)
    total, cuts, before = sum(w for _, w in points), [], 0.0
    for value, weight in points:
        before += weight
        while len(cuts) < ranges - 1 and before >= total * (len(cuts) + 1) / ranges:
            cuts.append(value)
    return cuts


def _merged_cuts(groups: DataFrame, columns: int, ranges: int) -> DataFrame:
    """What ``_weighted_cuts`` does, in the cluster: ``i`` and ``cuts`` per column that has a value.

    A column has at most ``SKETCH_GROUPS`` points per range, which one task orders."""
    sketches = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(f"rows{i}").alias("n"), F.col(f"points{i}").alias("points"))
            for i in range(columns)
        ]
    )
    each = groups.select(F.inline(sketches)).where(F.col("n") > 0)
    weight = (F.col("n") / F.size("points")).alias("weight")
    points = each.select("i", weight, F.explode("points").alias("value"))
    column = Window.partitionBy("i")
    ordered = column.orderBy("value", "weight")
    through = F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share = through * ranges / F.sum("weight").over(column)
    reached = points.withColumn("cut", F.least(F.lit(ranges - 1), F.floor(share)))
    new = F.col("cut") - F.coalesce(F.lag("cut").over(ordered), F.lit(0))
    repeated = reached.withColumn("value", F.array_repeat("value", new.cast("int")))
    return repeated.groupBy("i").agg(F.array_sort(F.flatten(F.collect_list("value"))).alias("cuts"))


def _cut_points(frame: DataFrame, columns: Sequence[str], ranges: int) -> list[list[float]]:
    """About ``ranges`` balanced cut points per column; a heavy value appears several times.

    Quantile sketches are made in up to ``SKETCH_GROUPS`` groups of input partitions, so no
    task and not the driver merges one per input partition, and count as many rows as they
    saw: a group of a few rows hardly moves a cut. The groups are merged where they are, and the
    driver gets one list per column; only few ranges, that is few numbers, it merges itself.
    Infinite values and NaN are not counted; they fall into the first or last range.
    """
    if ranges < 2:
        return [[] for _ in columns]
    probabilities = [i / ranges for i in range(1, ranges)]
    sketches = [
        expression
        for i, c in enumerate(columns)
        for expression in (
            F.count(_finite(c)).alias(f"rows{i}"),
            F.percentile_approx(_finite(c), probabilities, 4 * ranges).alias(f"points{i}"),
        )
    ]
    groups = frame.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))).agg(*sketches)
    if ranges > DRIVER_RANGES:
        merged = {r["i"]: r["cuts"] for r in _merged_cuts(groups, len(columns), ranges).collect()}
        return [merged.get(i, []) for i in range(len(columns))]
    collected = groups.collect()
    return [
        _weighted_cuts([(r[f"rows{i}"], r[f"points{i}"]) for r in collected if r[f"rows{i}"]], ranges)
        for i in range(len(columns))
    ]


def _with_ranges(frame: DataFrame, column: str, cuts: Sequence[float], output: str) -> DataFrame:
    if not cuts:
        return frame.withColumn(output, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    placed = Bucketizer(
        splits=splits, inputCol=column, outputCol=output, handleInvalid="keep"
    ).transform(frame)
    return placed.withColumn(output, F.col(output).cast("int"))


@dataclass(frozen=True)
class _Ranges:
    """Cut points of the ordering column and, inside its heavy values, of the tie-break."""

    order_by: str
    cuts: list[float]
    heavy: list[float]
    tie_break: str | None
    tie_cuts: list[float]

    def assign(self, frame: DataFrame) -> DataFrame:
        """Add the range of each row and its part of the range (0 outside heavy values)."""
        ranged = _with_ranges(frame, self.order_by, self.cuts, _RANGE)
        if not self.heavy:
            return ranged.withColumn(_PART, F.lit(0))
        parted = _with_ranges(ranged, self.tie_break, self.tie_cuts, _PART)
        is_heavy = F.col(self.order_by).cast("double").isin(self.heavy)
        return parted.withColumn(_PART, F.when(is_heavy, F.col(_PART)).otherwise(F.lit(0)))


def _find_ranges(
    frame: DataFrame, order_by: str, tie_break: str | None, ranges: int | None
) -> _Ranges:
    """Balanced ranges from approximate quantiles; any cut points give the same totals.

    A value that fills several quantiles gets a range of its own, which the tie-break splits
    into as many parts as the value fills.
    """
    ranges = ranges or _range_count(frame)
    (found,) = _cut_points(frame, [order_by], ranges)
    repeats = Counter(found)
    heavy = {value: n for value, n in repeats.items() if n > 1}
    if tie_break is None or not heavy:
        return _Ranges(order_by, sorted(repeats), [], None, [])
    own_ranges = set(repeats) | {math.nextafter(v, math.inf) for v in heavy}
    return _Ranges(
        order_by, sorted(own_ranges), list(heavy), tie_break, _tie_cuts(frame, order_by, tie_break, heavy)
    )


def _tie_cuts(frame: DataFrame, order_by: str, tie_break: str, heavy: dict[float, int]) -> list[float]:
    """Cuts of the tie-break that split the rows of each heavy value evenly.

    They come from those rows alone, each value's in turn, so a value whose keys are all
    recent, say, is still split. A value that fills n ranges adds 4 n cuts.
    """
    value = F.col(order_by).cast("double")
    most = 4 * max(heavy.values())
    probabilities = [i / most for i in range(1, most)]
    sketched = (
        frame.where(value.isin(list(heavy)))
        .groupBy(value.alias("value"))
        .agg(F.percentile_approx(F.col(tie_break).cast("double"), probabilities, 4 * most).alias("points"))
    )
    cuts: set[float] = set()
    for row in sketched.collect():
        wanted = 4 * heavy[row["value"]]
        cuts.update(row["points"][most * i // wanted - 1] for i in range(1, wanted))
    return sorted(cuts)


def _sort_keys(order_by: str, tie_break: str | None, descending: bool) -> list[Column]:
    first = F.desc(order_by) if descending else F.asc(order_by)
    return [first] if tie_break is None else [first, F.asc(tie_break)]


def _range_offsets(ranged: DataFrame, sums: Sequence[str], descending: bool) -> DataFrame:
    """Per range: the total before it and the total of everything.

    One row per range (and part), so the unpartitioned window and the broadcast that uses
    this frame handle a few rows per shuffle partition, whatever the size of the data.
    """
    order = [F.desc(_RANGE) if descending else F.asc(_RANGE), F.asc(_PART)]
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = ranged.groupBy(_RANGE, _PART).agg(*[F.sum(s).alias(s) for s in sums])
    return totals.select(
        _RANGE,
        _PART,
        *[(F.sum(s).over(running) - F.col(s)).alias(f"__{s}_before") for s in sums],
        *[F.sum(s).over(running).alias(f"__{s}_through") for s in sums],
        *[F.sum(s).over(everything).alias(f"{s}_total") for s in sums],
    )


def running_totals(
    frame: DataFrame,
    order_by: str,
    sums: Sequence[str],
    *,
    descending: bool = True,
    tie_break: str | None = None,
    up_to: tuple[str, Column] | None = None,
    rows: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``<s>_running`` (inclusive) and ``<s>_total`` for each column in ``sums``.

    ``order_by`` must be numeric and never null; without ``tie_break`` it must be unique.
    ``up_to=(s, limit)`` keeps only rows whose running total of ``s`` is within the limit (for
    non-negative ``s``); whole ranges beyond the limit are dropped before any row is shuffled.
    If ``frame`` is an aggregate, ``rows`` are the rows behind it, with the same columns: range
    totals are then counted on them directly and the aggregate is computed once.
    """
    rows = frame if rows is None else rows
    found = _find_ranges(rows, order_by, tie_break, ranges)
    offsets = _range_offsets(found.assign(rows), sums, descending)
    if up_to is not None:
        limited, limit = up_to
        offsets = offsets.where(F.col(f"__{limited}_before") <= limit)
    within = (
        Window.partitionBy(_RANGE, _PART)
        .orderBy(*_sort_keys(order_by, tie_break, descending))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = found.assign(frame).join(F.broadcast(offsets), [_RANGE, _PART])
    result = placed.select(
        *frame.columns,
        *[(F.sum(s).over(within) + F.col(f"__{s}_before")).alias(f"{s}_running") for s in sums],
        *[f"{s}_total" for s in sums],
    )
    if up_to is not None:
        result = result.where(F.col(f"{limited}_running") <= limit)
    return result


def quantile(
    frame: DataFrame, column: str, q: float, output: str = "quantile", ranges: int | None = None
) -> DataFrame:
    """Exact linearly interpolated quantile as a one-row frame; nulls are ignored.

    Rows are counted per range; only rows of the one or two ranges that hold the wanted ranks
    are then shuffled, folded to distinct values and sorted.
    """
    return quantiles(frame, [column], q, ranges).withColumnRenamed(column, output)


def quantiles(
    frame: DataFrame, columns: Sequence[str], q: float, ranges: int | None = None
) -> DataFrame:
    """The same quantile of several columns, in one row; ranges are found for all in one pass."""
    ranges = ranges or _range_count(frame)
    cut_points = _cut_points(frame, columns, ranges)
    ranged = frame.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    for i, cuts in enumerate(cut_points):
        ranged = _with_ranges(ranged, f"v{i}", sorted(set(cuts)), f"r{i}")
    values = F.array(
        *[F.struct(F.lit(i).alias("c"), F.col(f"v{i}").alias("value"), F.col(f"r{i}").alias(_RANGE)) for i in range(len(columns))]
    )
    rows = ranged.select(F.inline(values)).where(F.col("value").isNotNull())
    found = _placed_quantiles(rows, q)
    return found.agg(
        *[F.max(F.when(F.col("c") == i, F.col("quantile"))).alias(c) for i, c in enumerate(columns)]
    )


def _placed_quantiles(rows: DataFrame, q: float) -> DataFrame:
    """``c`` and ``quantile`` of rows (c, value, range): two passes for all columns, one that
    counts rows per range and one that sorts the one or two ranges that hold the ranks."""
    of_column = Window.partitionBy("c")
    running = of_column.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    position = (F.col("n_total") - 1) * F.lit(q)
    offsets = (
        rows.groupBy("c", _RANGE)
        .agg(F.count(F.lit(1)).alias("n_range"))
        .withColumn("through", F.sum("n_range").over(running))
        .withColumn("n_total", F.sum("n_range").over(of_column))
        .withColumn("before", F.col("through") - F.col("n_range"))
        .where((F.col("before") <= F.ceil(position)) & (F.col("through") > F.floor(position)))
        .select("c", _RANGE, "before", "n_total")
    )
    levels = (
        rows.join(F.broadcast(offsets), ["c", _RANGE])
        .groupBy("c", _RANGE, "value", "before", "n_total")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    within = (
        Window.partitionBy("c", _RANGE)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = levels.withColumn("through", F.sum("n").over(within) + F.col("before"))
    low, high, fraction = _interpolation_points(
        F.col("value"), F.col("through") - F.col("n"), F.col("through"), position
    )
    points = placed.groupBy("c").agg(low.alias("low"), high.alias("high"), fraction.alias("fraction"))
    return points.select(
        "c", interpolate(F.col("low"), F.col("high"), F.col("fraction")).alias("quantile")
    )


def _interpolation_points(
    value: Column, before: Column, through: Column, position: Column
) -> tuple[Column, Column, Column]:
    low_rank, high_rank = F.floor(position), F.ceil(position)
    low = F.max(F.when((before <= low_rank) & (low_rank < through), value))
    high = F.max(F.when((before <= high_rank) & (high_rank < through), value))
    return low, high, F.max(position - low_rank)


def interpolate(low: Column, high: Column, fraction: Column) -> Column:
    return F.least(low + (high - low) * fraction, high)


def zscore(
    frame: DataFrame, columns: Sequence[str], suffix: str = "_z", zero_variance: float | None = None
) -> DataFrame:
    """Add (x - mean) / population standard deviation for each column.

    Means and deviations are scalar subqueries (one shared aggregation), not a whole-table
    window. With ``zero_variance`` that divisor replaces a deviation of 0; otherwise the
    result is null.
    """
    moments = frame.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns],
    )
    scaled = []
    for c in columns:
        mean, deviation = moments.select(f"{c}_mean").scalar(), moments.select(f"{c}_sd").scalar()
        if zero_variance is not None:
            deviation = F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(float(zero_variance)))
        scaled.append(safe_divide(F.col(c) - mean, deviation).alias(f"{c}{suffix}"))
    return frame.select("*", *scaled)


def standardise(frame: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Centre and scale by the population deviation; a constant column becomes 0."""
    return zscore(frame, columns, suffix, zero_variance=1.0)
