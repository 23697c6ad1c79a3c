"""The weekly snapshot bundle: eight tables around a cutoff weekday."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bundle import Bundle
from ..functions import guarded_ratio, iso_weekday, shifted_weekday, weekday_number
from ..operators.compare import compare_wide, with_previous
from ..operators.cutoffs import (
    cut_to_lag,
    cut_to_weekday,
    on_date_or_newest,
    thin_to_weekday,
    trailing_period,
)
from ..operators.derive import override_by_key, seven_day_ratios
from ..operators.latest import latest_per_key
from ..operators.reshape import stack
from ..specs import IDS, MeasureSpec

SIX_WEEKS = 42

# Compared measures and whether a rise is good.
WEEKLY_CASES = (
    MeasureSpec("CasesNew7DayAvg", up_good=False),
    MeasureSpec("CasesNew7DayTotal", up_good=False),
    MeasureSpec("DeathsNew7DayAvg", up_good=False),
    MeasureSpec("DeathsNew7DayTotal", up_good=False),
    MeasureSpec("TestsNew7DayAvg", up_good=True),
    MeasureSpec("TestsNew7DayTotal", up_good=True),
    MeasureSpec("TestsPositive7DayRate", up_good=False),
    MeasureSpec("DeathsToCases7DayRate", up_good=False),
    MeasureSpec("HospsToCases7DayRate", up_good=False),
)
WEEKLY_HOSPITAL = (
    MeasureSpec("CovidTotal7DayAvg", up_good=False),
    MeasureSpec("CovidNew7DayAvg", up_good=False),
    MeasureSpec("CovidNew7DayTotal", up_good=False),
    MeasureSpec("Hospital7DayReportRate", up_good=True),
)
SLICED = (
    MeasureSpec("CasesNew##DayAvg", up_good=False),
    MeasureSpec("CasesNew##DayTotal", up_good=False),
    MeasureSpec("DeathsNew##DayAvg", up_good=False),
    MeasureSpec("DeathsNew##DayTotal", up_good=False),
    MeasureSpec("TestsNew##DayAvg", up_good=True),
    MeasureSpec("TestsNew##DayTotal", up_good=True),
    MeasureSpec("CovidTotal##DayAvg", up_good=False),
    MeasureSpec("CovidNew##DayAvg", up_good=False),
    MeasureSpec("CovidNew##DayTotal", up_good=False),
)

# Columns of the weekly tables, in output order.
CASE_COLUMNS = (
    "CasesNew7DayTotal",
    "CasesNew7DayAvg",
    "DeathsNew7DayTotal",
    "DeathsNew7DayAvg",
    "TestsNew7DayTotal",
    "TestsNew7DayAvg",
    "TestsPositive7DayRate",
    "DeathsToCases7DayRate",
    "HospsToCases7DayRate",
)
HOSPITAL_COLUMNS = (
    "CovidNew7DayTotal",
    "CovidNew7DayAvg",
    "CovidTotal7DayAvg",
    "Hospital7DayReportRate",
)


@dataclass(frozen=True)
class SnapshotPlaces:
    """Keys the snapshot reports on.

    ``series`` get weekly series, ``headline`` (part of them) the comparisons,
    ``focus`` is the one key of the comparison table.  ``hospital_totals``
    overrides the 7-day hospital total of keys with a known number of sites.
    """

    series: Sequence[str]
    headline: Sequence[str]
    focus: str
    hospital_totals: Mapping[str, int] = field(default_factory=dict)


def slice_comparison(
    rolled: DataFrame, days: int, cut: Column, lag_cases: int, lag_hospital: int, focus: str
) -> DataFrame:
    """Newest comparison of one key: cut to a weekday's newest date, then by each measure's lag.

    The weekday's newest date is itself the newest date of what the first cut
    leaves, and lags only look back, so both cuts can follow the lags; case
    and hospital measures then differ only in which row they take, and one
    pass serves both.
    """
    by_key = Window.partitionBy("GeoID")
    newest = {
        f"_newest_{name}": F.max(
            F.when(F.col("Date") <= F.date_sub(cut, lag), F.col("Date"))
        ).over(by_key)
        for name, lag in (("cases", lag_cases), ("hospital", lag_hospital))
    }
    on_newest = F.col("Date").isin(*[F.col(c) for c in newest])
    wide = (
        with_previous(rolled, SLICED, days)
        .where(F.col("GeoID") == focus)
        .withColumns(newest)
        .where(on_newest)
    )
    about_hospital = F.col("Measure").startswith("Covid")
    own_newest = F.when(about_hospital, F.col("_newest_hospital")).otherwise(F.col("_newest_cases"))
    long = (
        compare_wide(wide, SLICED, days, ids=(*IDS, *newest))
        .where(F.col("Date") == own_newest)
        .drop(*newest)
    )
    renamed = {c: c.replace("Week", "", 1) for c in long.columns if "Week" in c}
    return long.withColumnsRenamed(renamed).withColumns(
        {
            "Days": F.lit(days),
            "Lag": F.when(about_hospital, F.lit(lag_hospital)).otherwise(F.lit(lag_cases)),
        }
    )


def snapshot_bundle(
    base: Mapping[str, DataFrame],
    places: SnapshotPlaces,
    cutoff_day: str = "Sunday",
    lag_cases: int = 10,
    lag_hospital: int = 2,
    as_of: dt.date | None = None,
) -> Bundle:
    """Weekly snapshot tables over a base bundle."""
    weekday = weekday_number(cutoff_day)

    @cache
    def anchors() -> Column:
        """The newest date, the newest one on the cutoff weekday, and each lag's newest weekly point of ``series``.

        Rolling keeps every row's date, so the merged panel has them.  One
        scalar holds them all: a plan that uses several reads the dates once,
        with at most a calendar of them.
        """
        own = F.when(F.col("GeoID").isin(*places.series), F.col("Date"))
        dates = base["cdtHospData"].agg(
            F.max("Date").alias("newest"),
            F.max(F.when(iso_weekday(F.col("Date")) == weekday, F.col("Date"))).alias("cut"),
            F.collect_set(own).alias("days"),
        )

        def last_point(lag: int) -> Column:
            on_day = shifted_weekday(weekday, lag)
            return F.array_max(
                F.filter("days", lambda d: (d <= F.date_sub("newest", lag)) & (iso_weekday(d) == on_day))
            )

        found = [F.col("newest"), F.col("cut")]
        found += [last_point(lag).alias(f"point_{lag}") for lag in dict.fromkeys((lag_cases, lag_hospital))]
        return dates.select(F.struct(*found)).scalar()

    def weekly_points(lag: int) -> DataFrame:
        rolled = cut_to_lag(base["cdtHosp7DayRollingData"], lag, newest=anchors()["newest"])
        return thin_to_weekday(rolled, weekday, lag).where(F.col("GeoID").isin(*places.series))

    def cases() -> DataFrame:
        return bundle["WDS_7DayRollingLag"]

    def hospital() -> DataFrame:
        return bundle["WDS_7DayRollingLagHosp"]

    def weekly_cases() -> DataFrame:
        positivity = guarded_ratio(F.col("CasesNew7DayTotal"), F.col("TestsNew7DayTotal"))
        rated = seven_day_ratios(weekly_points(lag_cases), "Rate").withColumn(
            "TestsPositive7DayRate", positivity
        )
        return rated.select(*IDS, *CASE_COLUMNS)

    def weekly_hospital() -> DataFrame:
        known = override_by_key(
            weekly_points(lag_hospital), "HospitalsTotal7DayTotal", places.hospital_totals
        )
        reporting = guarded_ratio(
            F.col("HospitalsReporting7DayTotal"), F.col("HospitalsTotal7DayTotal")
        )
        return known.withColumn("Hospital7DayReportRate", reporting).select(
            *IDS, *HOSPITAL_COLUMNS
        )

    def last_weeks(points: DataFrame, measures: Sequence[MeasureSpec], lag: int) -> DataFrame:
        wide = with_previous(points, measures, 7, lag=1)
        wide = trailing_period(wide, SIX_WEEKS, newest=anchors()[f"point_{lag}"])
        return compare_wide(wide.where(F.col("GeoID").isin(*places.headline)), measures)

    @cache
    def sliced() -> DataFrame:
        seven, fourteen = (
            slice_comparison(
                base[f"cdtHosp{days}DayRollingData"],
                days,
                anchors()["cut"],
                lag_cases,
                lag_hospital,
                places.focus,
            )
            for days in (7, 14)
        )
        return seven.unionByName(fourteen)

    @cache
    def range_ends() -> DataFrame:
        """One row: the comparison date of case and of hospital measures.

        Rolling, lags and long form keep every row's date, so the dates of the
        merged panel are enough: the newest one of the focus key up to the
        newest cutoff weekday less the lag, for both lengths alike.  They are
        read in one pass, with at most a calendar of dates of the one key.
        """
        dates = base["cdtHospData"].agg(
            F.max(F.when(iso_weekday(F.col("Date")) == weekday, F.col("Date"))).alias("cut"),
            F.collect_set(F.when(F.col("GeoID") == places.focus, F.col("Date"))).alias("days"),
        )

        def newest(lag: int) -> Column:
            return F.array_max(F.filter("days", lambda d: d <= F.date_sub("cut", lag)))

        return dates.select(newest(lag_cases).alias("cases"), newest(lag_hospital).alias("hospital"))

    def report_cutoff(cases_end: Column) -> Column:
        return F.date_add(cases_end, lag_cases)

    def helper() -> DataFrame:
        today = F.current_date() if as_of is None else F.lit(as_of)
        none = F.lit(None).cast("date")
        rows = (
            ("CurrentDate", today, none),
            ("ReportCutoffDate", report_cutoff(F.col("cases")), none),
            ("CDTRange", F.date_sub("cases", 6), F.col("cases")),
            ("HospRange", F.date_sub("hospital", 6), F.col("hospital")),
        )
        return stack(
            range_ends(),
            [],
            [{"ID_Name": F.lit(n), "Date1": first, "Date2": last} for n, first, last in rows],
        )

    def regional_vaccinations() -> DataFrame:
        cutoff = report_cutoff(range_ends().select("cases").scalar())
        return on_date_or_newest(base["vaccData"], cutoff, places.series)

    recipes = {
        "WDS_7DayRollingLag": weekly_cases,
        "WDS_Last7Days": lambda: latest_per_key(cases()).where(
            F.col("GeoID").isin(*places.headline)
        ),
        "WDS_7DayRollingLagHosp": weekly_hospital,
        "WDS_WeeklyComparison": lambda: last_weeks(cases(), WEEKLY_CASES, lag_cases).unionByName(
            last_weeks(hospital(), WEEKLY_HOSPITAL, lag_hospital)
        ),
        "WDS_ComparisonTable": sliced,
        "WDS_HelperTable": helper,
        "WDS_HospitalDailyData": lambda: cut_to_weekday(base["hospData"], weekday, lag_hospital),
        "WDS_RegionVacc": regional_vaccinations,
    }
    bundle = Bundle(recipes, ("WDS_7DayRollingLag", "WDS_7DayRollingLagHosp"))
    return bundle

