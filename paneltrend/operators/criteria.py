"""Fourteen-day criteria summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, per_100k, weighted_whole_average
from ..specs import IDS
from .cutoffs import mondays_as_of
from .merge import lookup

DAYS = 14


def criteria_summary(
    df: DataFrame,
    population: DataFrame,
    lag: int = 7,
    as_of: dt.date | None = None,
    *,
    ids: Sequence[str] = IDS,
) -> DataFrame:
    """Case rate, positivity and bed shares of a 14-day summary on past Mondays."""
    mondays = lookup(mondays_as_of(df, lag, as_of), population, "GeoID", ["Population"])
    rated = mondays.withColumns(
        {
            "CasesNew14DayTotalPer100K": per_100k(
                F.col("CasesNew14DayTotal"), F.col("Population")
            ),
            "TestsPositivity14DayProportion": guarded_ratio(
                F.col("CasesNew14DayTotal"), F.col("TestsNew14DayTotal")
            ),
            **{
                f"Beds{part}14WAvg": weighted_whole_average(
                    F.col(f"{source}14DayTotal"),
                    F.col("HospitalsTotal14DayTotal"),
                    F.col("HospitalsReporting14DayTotal"),
                    DAYS,
                )
                for part, source in (
                    ("Available", "BedsAvailable"),
                    ("UsedCovid", "CovidTotal"),
                    ("UsedOther", "BedsUsedOther"),
                )
            },
        }
    )
    beds = F.col("BedsAvailable14WAvg") + F.col("BedsUsedOther14WAvg") + F.col("BedsUsedCovid14WAvg")
    shares = [
        guarded_ratio(F.col(f"Beds{part}14WAvg"), beds).alias(f"Beds{part}14WAvg_Prop")
        for part in ("Available", "UsedCovid", "UsedOther")
    ]
    return rated.select(
        *ids,
        "CasesNew14DayTotal",
        "CasesNew14DayTotalPer100K",
        "TestsPositivity14DayProportion",
        *shares,
    )
