"""Ratios and clamps whose NULL behaviour matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL where the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def per_100k(value: Column, population: Column) -> Column:
    return guarded_ratio(value, population) * 100000


def floor_at_zero(value: Column) -> Column:
    """Negative values become 0; NULL stays NULL (``greatest`` would drop it)."""
    return F.when(value < 0, F.lit(0).cast("bigint")).otherwise(value)


def weighted_whole_average(
    value_total: Column, capacity_total: Column, reporting_total: Column, days: int
) -> Column:
    """Daily average scaled from reporting to full capacity, rounded half to even.

    Products are taken as doubles, so large counts cannot overflow.
    """
    scaled = guarded_ratio(
        capacity_total.cast("double") * value_total.cast("double"),
        reporting_total.cast("double"),
    )
    return F.bround(scaled / days, 0).cast("bigint")
