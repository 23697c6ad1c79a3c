"""KPI classes and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import KpiBand

# KPI ids (1 falling and good, 2 falling and bad, 3 flat,
# 4 rising and good, 5 rising and bad) and the colour each one is shown in.
GREEN = "#06C72F"
RED = "#ff3a22"
YELLOW = "#E1E500"


def change_kpi(
    ratio: Column, change: Column, up_good: Column, band: KpiBand = KpiBand()
) -> Column:
    """Five-class KPI of a change ratio.

    With no ratio (the earlier value was 0) the sign of the change decides;
    with neither, the class is NULL.
    """
    no_ratio = ratio.isNull()
    falling = (ratio <= band.low) | (no_ratio & (change < 0))
    rising = (ratio >= band.high) | (no_ratio & (change > 0))
    flat = (ratio > band.low) & (ratio < band.high)
    return (
        F.when(falling, F.when(up_good, F.lit(2)).otherwise(F.lit(1)))
        .when(flat, F.lit(3))
        .when(rising, F.when(up_good, F.lit(4)).otherwise(F.lit(5)))
    )


def kpi_color(kpi: Column) -> Column:
    return (
        F.when(kpi.isin(1, 4), F.lit(GREEN))
        .when(kpi.isin(2, 5), F.lit(RED))
        .when(kpi == 3, F.lit(YELLOW))
    )


def target_kpi(value: Column, target: Column, above_good: bool) -> Column:
    """1 on the good side of a target, 3 on the bad side, 2 on it or unknown."""
    above, below = (1, 3) if above_good else (3, 1)
    return (
        F.when(value > target, F.lit(above))
        .when(value < target, F.lit(below))
        .otherwise(F.lit(2))
    )
