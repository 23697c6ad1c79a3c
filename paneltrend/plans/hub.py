"""The dashboard bundle: 30 tables plus one name bridge per site."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..bundle import Bundle
from ..functions import guarded_ratio
from ..operators.compare import compare_wide, with_previous
from ..operators.criteria import criteria_summary
from ..operators.cutoffs import Calendar, cut_to_lag, thin_to_newest_weekday, trailing_period
from ..operators.derive import (
    against_testing_targets,
    daily_vaccinations,
    positive_and_negative_tests,
    vaccination_rates,
)
from ..operators.latest import latest_per_key
from ..operators.merge import site_bridge
from ..operators.periods import period_table
from ..operators.recency import change_since
from ..operators.rolling import rolling_summary
from ..sources.landed import Dimensions
from ..specs import (
    IDS,
    Attachment,
    ChangeSpec,
    ChangeWindow,
    MeasureSpec,
    PeriodMeasureSpec,
    RollSpec,
)

SIX_WEEKS = 42

# Compared measures and whether a rise is good.
COMPARED = (
    MeasureSpec("CasesNew##DayAvg", up_good=False),
    MeasureSpec("CasesNew##DayTotal", up_good=False),
    MeasureSpec("DeathsNew##DayAvg", up_good=False),
    MeasureSpec("DeathsNew##DayTotal", up_good=False),
    MeasureSpec("TestsNew##DayAvg", up_good=True),
    MeasureSpec("TestsNew##DayTotal", up_good=True),
    MeasureSpec("CovidTotal##DayAvg", up_good=False),
    MeasureSpec("CovidNew##DayAvg", up_good=False),
    MeasureSpec("CovidNew##DayTotal", up_good=False),
    MeasureSpec("CovidICUTotal##DayAvg", up_good=False),
    MeasureSpec("CovidVentilatorsUsed##DayAvg", up_good=False),
)
COMPARED_VACCINATIONS = tuple(
    MeasureSpec(f"{measure}_New##Day{statistic}", up_good=True)
    for measure in ("DosesAdministered", "RegimenInitiated", "RegimenCompleted")
    for statistic in ("Total", "Avg")
)

# Measures of the testing and vaccination summaries.
ROLLED_TESTS = (
    RollSpec("TestsPositiveNew", expr="CasesNew"),
    RollSpec("TestsNew"),
    RollSpec("TestsNegativeNew"),
)
ROLLED_VACCINATIONS = (
    RollSpec("DosesAdministered_New"),
    RollSpec("RegimenInitiated_New"),
    RollSpec("RegimenCompleted_New"),
)

# Measures of the period table.
PERIOD_MEASURES = (
    PeriodMeasureSpec("CasesNew", "Total", "Cases", up_good=False),
    PeriodMeasureSpec("DeathsNew", "Total", "Deaths", up_good=False),
    PeriodMeasureSpec("TestsNew", "Total", "Tests", up_good=True),
)

# Change-since measures and windows.  "PostitiveTests" is the
# established spelling of that column.
CASE_CHANGES = ChangeSpec(
    totals=(("Cases", "CasesTotal"), ("Deaths", "DeathsTotal"), ("Tests", "TestsTotal")),
    attach_to="Tests",
    attachments=(
        Attachment("PostitiveTests", plus="Cases"),
        Attachment("NegativeTests", plus="Tests", minus="Cases"),
    ),
)
VACCINATION_CHANGES = ChangeSpec(
    totals=(
        ("DosesAdministered", "DosesAdministered_Total"),
        ("RegimenInitiated", "RegimenInitiated_Total"),
        ("RegimenCompleted", "RegimenCompleted_Total"),
    ),
    attach_to="DosesAdministered",
    attachments=(
        Attachment("RegimenInitiated", plus="RegimenInitiated"),
        Attachment("RegimenCompleted", plus="RegimenCompleted"),
    ),
)
CASE_WINDOW_DAYS = (7, 14, 30, 60, 90)
VACCINATION_WINDOWS = (ChangeWindow(7), ChangeWindow(14), ChangeWindow(None))

# Columns of the 7-day tables, in output order.
CASE_COLUMNS = (
    "CasesNew7DayTotal",
    "CasesNew7DayAvg",
    "DeathsNew7DayTotal",
    "DeathsNew7DayAvg",
    "TestsNew7DayTotal",
    "TestsNew7DayAvg",
    "TestsPositiveNew7DayAvgProportion",
    "DeathsToCases7DayProportion",
    "HospsToCases7DayProportion",
    "Population",
    "PopulationTestStandard",
)
STANDARD_COLUMNS = ("PositiveTestStandardProportion", "PositiveTestStandard")
HOSPITAL_COLUMNS = (
    "CovidNew7DayTotal",
    "CovidNew7DayAvg",
    "HospitalsReporting7DayTotal",
    "HospitalsReporting7DayAvg",
    "HospitalsTotal7DayTotal",
    "HospitalsTotal7DayAvg",
    "BedsInpatientUsedCovid7DayAvg",
    "BedsInpatientTotal7DayAvg",
    "BedsInpatientUsedCovid7DayAvgProportion",
)


def case_windows(lag: int) -> tuple[ChangeWindow, ...]:
    return (*(ChangeWindow(d, lag) for d in CASE_WINDOW_DAYS), ChangeWindow(None))


def case_changes(df: DataFrame, windows: Sequence[ChangeWindow]) -> DataFrame:
    """Change-since rows of cases, deaths and tests, with display labels."""
    label = F.concat(F.lit("Total "), F.col("Measure"))
    return change_since(df, CASE_CHANGES, windows).withColumn(
        "Raw_Per100K",
        F.when(F.col("Raw_Per100K") == "Per100K", F.concat(label, F.lit(" Per 100K"))).otherwise(
            label
        ),
    )


def vaccination_changes(
    df: DataFrame, windows: Sequence[ChangeWindow] = VACCINATION_WINDOWS
) -> DataFrame:
    """Change-since rows of doses, with regimens alongside and their shares."""
    doses = change_since(df, VACCINATION_CHANGES, windows).where(
        F.col("Measure") == "DosesAdministered"
    )
    per_capita = F.col("Raw_Per100K") == "Per100K"
    people = F.when(per_capita, F.lit(100000.0)).otherwise(F.col("Population").cast("double"))
    shares = {
        f"{regimen}_PropPop": guarded_ratio(F.col(regimen), people)
        for regimen in ("RegimenInitiated", "RegimenCompleted")
    }
    labelled = doses.withColumns(shares).withColumn(
        "Raw_Per100K", F.when(per_capita, F.lit("Total Per 100K")).otherwise(F.lit("Total"))
    )
    last = ["SlicerLevels", "filterLevels"]
    return labelled.select(*[c for c in labelled.columns if c not in last], *last)


def hub_bundle(
    base: Mapping[str, DataFrame],
    dims: Dimensions,
    sites: Sequence[str],
    lag_cases: int = 10,
    lag_hospital: int = 2,
    as_of: dt.date | None = None,
) -> Bundle:
    """Dashboard tables over a base bundle.

    Comparison tables filter the wide panel with its lags and only then turn
    it long; the wide panel is shared, as ``bundle.pin()`` can use.
    """

    # rolling and lags keep every row's date, so these share the panel's anchors
    @cache
    def calendar() -> Calendar:
        return Calendar(base["cdtHospData"])

    def cut(df: DataFrame, lag: int) -> DataFrame:
        return cut_to_lag(df, lag, newest=calendar().newest())

    def six_weeks(lag: int = 0) -> DataFrame:
        return compared(trailing_period(weekly(), SIX_WEEKS, lag, newest=calendar().newest()))

    @cache
    def rated() -> DataFrame:
        return against_testing_targets(base["cdtHosp7DayRollingData"], dims.population).select(
            *IDS,
            *CASE_COLUMNS,
            "KPI_PopulationTests",
            *STANDARD_COLUMNS,
            "KPI_PositiveTests",
            *HOSPITAL_COLUMNS,
        )

    @cache
    def lagged_cases() -> DataFrame:
        kpis = ("KPI_PositiveTests", "KPI_PopulationTests")
        return cut(
            bundle["7DayRolling"].select(*IDS, *CASE_COLUMNS, *STANDARD_COLUMNS, *kpis), lag_cases
        )

    @cache
    def lagged_hospital() -> DataFrame:
        return cut(bundle["7DayRolling"].select(*IDS, *HOSPITAL_COLUMNS), lag_hospital)

    def weekly() -> DataFrame:
        return bundle["_weekly"]

    def compared(wide: DataFrame) -> DataFrame:
        return compare_wide(wide, COMPARED)

    @cache
    def tests() -> DataFrame:
        rolled = rolling_summary(positive_and_negative_tests(base["cdtData"]), 7, ROLLED_TESTS)
        positivity = guarded_ratio(
            F.col("TestsPositiveNew7DayTotal"), F.col("TestsNew7DayTotal")
        )
        return cut_to_lag(rolled.withColumn("TestsPositivity", positivity), lag_cases)

    def periods() -> DataFrame:
        seven, fourteen = (
            period_table(
                base[f"cdtHosp{days}DayRollingData"],
                days,
                lag_cases,
                PERIOD_MEASURES,
                dims.population,
            )
            for days in (7, 14)
        )
        return seven.unionByName(fourteen)

    def helper() -> DataFrame:
        spark = base["cdtData"].sparkSession
        return spark.range(1).select(
            F.lit("LastExport").alias("HelperID"), F.current_timestamp().alias("DateTime")
        )

    recipes = {
        "CDT_TimeSeries": lambda: base["cdtData"],
        "CDT_NewlyReported": lambda: latest_per_key(base["cdtNRData"]),
        "HospitalDailyData": lambda: base["hospData"],
        "HospitalMostRecent": lambda: latest_per_key(base["hospData"]),
        "7DayRolling": rated,
        "7DayRollingLag": lagged_cases,
        "7DayRollingLagHosp": lagged_hospital,
        "7DayRollingThinLag": lambda: thin_to_newest_weekday(
            lagged_cases(), newest=calendar().newest(lag_cases)
        ),
        "7DayRollingThinLagHosp": lambda: thin_to_newest_weekday(
            lagged_hospital(), newest=calendar().newest(lag_hospital)
        ),
        "7DayComparison_MostRecent": lambda: compared(latest_per_key(weekly())),
        "7DayComparison_MostRecent_Lag": lambda: compared(
            latest_per_key(cut(weekly(), lag_cases))
        ),
        "7DayComparison_MostRecent_HospLag": lambda: compared(
            latest_per_key(cut(weekly(), lag_hospital))
        ),
        "7DayComparison_Last6Weeks": six_weeks,
        "7DayComparison_Last6Weeks_Lag": lambda: six_weeks(lag_cases),
        "7DayComparison_Last6Weeks_HospLag": lambda: six_weeks(lag_hospital),
        "7DayComparison_AllTime": lambda: compared(weekly()),
        "7DayComparison_AllTime_Lag": lambda: compared(cut(weekly(), lag_cases)),
        "7DayComparison_AllTime_HospLag": lambda: compared(cut(weekly(), lag_hospital)),
        "TestingPage7DayRollingLag": tests,
        "TestingPage7DayRollingThinLag": lambda: thin_to_newest_weekday(tests()),
        "JurisdictionBarCharts": lambda: case_changes(
            base["cdtHospData"], case_windows(lag_cases)
        ),
        "COPTable": periods,
        "vacc_DailyData": lambda: daily_vaccinations(base["vaccData"]),
        "vacc_7DayRollingData": lambda: rolling_summary(
            bundle["vacc_DailyData"], 7, ROLLED_VACCINATIONS
        ),
        "vacc_baseWeeklyComparisonData": lambda: compare_wide(
            with_previous(bundle["vacc_7DayRollingData"], COMPARED_VACCINATIONS),
            COMPARED_VACCINATIONS,
        ),
        "vacc_JurisdictionBarCharts": lambda: vaccination_changes(bundle["vacc_DailyData"]),
        "vacc_DailyData_CDC": lambda: base["vaccCDCData"],
        "vacc_DailyDataRate_CDC": lambda: vaccination_rates(base["vaccCDCData"]),
        "SGC_14DaySummary": lambda: criteria_summary(
            base["cdtHosp14DayRollingData"], dims.population, as_of=as_of
        ),
        **{
            f"PrettyJurisdictions_{site}": (
                lambda site=site: site_bridge(dims.pretty, dims.population, site)
            )
            for site in sites
        },
        "HelperTable": helper,
    }
    inner = {"_weekly": lambda: with_previous(base["cdtHosp7DayRollingData"], COMPARED)}
    bundle = Bundle(recipes, ("vacc_DailyData", "_weekly"), inner)
    return bundle
