"""Column expressions. All of them are built-in Spark expressions; none is a UDF."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, divisor: Column) -> Column:
    """Division that gives null for a zero or null divisor (plain ``/`` raises in ANSI mode)."""
    return F.try_divide(numerator, divisor)


def null_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def round_half_away(value: Column, digits: int) -> Column:
    """Round half away from zero on the double itself.

    Beyond 2**52 a double has no digits left to round at this scale, so the value
    is returned as it is; that also keeps ``floor`` inside the bigint range.
    """
    scale = float(10**digits)
    scaled = F.abs(value) * scale
    rounded = F.signum(value) * F.floor(scaled + 0.5) / scale + F.lit(0.0)
    return F.when(scaled < float(2**52), rounded).otherwise(value)


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def sigmoid(value: Column) -> Column:
    """Logistic function, written so that ``exp`` never overflows."""
    return F.when(value >= 0, 1.0 / (1.0 + F.exp(-value))).otherwise(
        F.exp(value) / (1.0 + F.exp(value))
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def strip_prefix(value: Column, prefix: str) -> Column:
    return F.when(F.startswith(value, F.lit(prefix)), F.substring(value, len(prefix) + 1, F.length(value))).otherwise(value)


def first_largest(candidates: Mapping[str, Column]) -> Column:
    """Name of the largest candidate; the earliest wins a tie, null and NaN are skipped.

    The null check is explicit: over a literal array ``element_at`` does not pass a null index on.
    """
    names = F.array(*[F.lit(name) for name in candidates])
    nothing = F.lit(None).cast("double")
    values = F.array(*[F.nanvl(c.cast("double"), nothing) for c in candidates.values()])
    largest = F.array_max(values)
    name = F.element_at(names, F.array_position(values, largest).cast("int"))
    return F.when(largest.isNotNull(), name)


def exact_sum(value: Column, digits: int) -> Column:
    """Sum of fixed-scale doubles (money, hours), the same in whatever order rows arrive.

    The running sum is a bigint of the scaled value, so it stays in generated code and a
    retried or differently partitioned job gives the same bits.
    """
    scale = float(10**digits)
    return F.sum(F.rint(value * scale).cast("bigint")).cast("double") / scale


def exact_avg(value: Column, digits: int | None) -> Column:
    """Mean over non-null values; through :func:`exact_sum` when the scale is known."""
    if digits is None:
        return F.avg(value)
    return F.try_divide(exact_sum(value, digits), F.count(value))
