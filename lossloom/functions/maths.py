"""Ratios, clamps, thresholds and in-row vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, divisor: Column) -> Column:
    """Quotient as double; null when the divisor is zero."""
    return F.try_divide(numerator.cast("double"), divisor.cast("double"))


def rounded_ratio(numerator: Column, divisor: Column, places: int = 2) -> Column:
    return F.round(ratio(numerator, divisor), places)


def clamp(column: Column, low: float, high: float, default: float | None = None) -> Column:
    value = column if default is None else F.coalesce(column, F.lit(default))
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def incurred_net(open_reserve: Column, paid: Column, recovered: Column) -> Column:
    return open_reserve + paid - recovered


def incurred_gross(open_reserve: Column, paid: Column) -> Column:
    return open_reserve + paid


def threshold_class(probability: Column, cut: float = 0.5) -> Column:
    """Class 1 strictly above the cut."""
    return F.when(probability > cut, 1).otherwise(0)


def array_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def share_of_sum(vector: Column) -> Column:
    """Components divided by their sum; an all-zero vector stays zero."""
    total = array_sum(vector)
    return F.transform(vector, lambda x: F.coalesce(F.try_divide(x.cast("double"), total), F.lit(0.0)))


def unit_length(vector: Column) -> Column:
    """Components divided by the Euclidean length; null for a zero vector."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.try_divide(x.cast("double"), norm))


def largest_components(vector: Column, k: int) -> Column:
    """The k largest components as (pos, value), largest first, lower position first on a tie."""
    pairs = F.transform(vector, lambda x, i: F.struct((-x.cast("double")).alias("neg"), i.alias("pos")))
    return F.transform(
        F.slice(F.array_sort(pairs), 1, k),
        lambda p: F.struct(p["pos"].alias("pos"), (-p["neg"]).alias("value")),
    )
