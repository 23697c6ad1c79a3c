"""Measures derived from reported ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import floor_at_zero, guarded_ratio, target_kpi
from ..specs import DATE, KEY
from .merge import lookup
from .positions import check_lag_strategy, with_earlier
from .rolling import rolling_max

# Hospital resources as (all used, used for the disease, free,
# total, used for anything else) columns.
HOSPITAL_RESOURCES = (
    ("BedsUsed", "CovidTotal", "BedsAvailable", "BedsTotal", "BedsUsedOther"),
    ("BedsICUUsed", "CovidICUTotal", "BedsICUAvailable", "BedsICUTotal", "BedsICUUsedOther"),
    (
        "VentilatorsUsed",
        "CovidVentilatorsUsed",
        "VentilatorsAvailable",
        "VentilatorsTotal",
        "VentilatorsUsedOther",
    ),
)

# Age bands as (label, lower threshold, upper threshold).
AGE_BANDS = (
    ("5to11", "GTE5", "GTE12"),
    ("12to17", "GTE12", "GTE18"),
    ("18to65", "GTE18", "GTE65"),
)
OPEN_BAND = "GTE65"

# Testing targets (tests per 100,000 people and day, and the
# share of tests that may be positive, as a proportion and in percent).
TESTS_PER_100K = 150
POSITIVE_SHARE = 0.05
POSITIVE_PERCENT = 5


def reported_sums(df: DataFrame) -> DataFrame:
    """Admissions and inpatient use as sums of their parts (NULL if one is)."""
    return df.withColumns(
        {
            "CovidNew": F.col("CovidNew24HConfirmed") + F.col("CovidNew24HSuspected"),
            "BedsInpatientUsedCovid": F.col("CovidConfirmedAdult")
            + F.col("CovidConfirmedPediatric"),
        }
    )


def hospital_measures(df: DataFrame, strategy: str = "window") -> DataFrame:
    """Residual use floored at zero, totals rebuilt from parts, shares of use.

    ``HospitalsTotal`` becomes the most hospitals reporting within ten days
    either side, so it follows changes in who reports.
    """
    df = reported_sums(df)
    df = df.withColumns(
        {
            other: floor_at_zero(F.col(used) - F.col(disease))
            for used, disease, _, _, other in HOSPITAL_RESOURCES
        }
    )
    df = df.withColumns(
        {
            total: F.col(free) + F.col(other) + F.col(disease)
            for _, disease, free, total, other in HOSPITAL_RESOURCES
        }
    )
    shares = {
        f"{part}Proportion": guarded_ratio(F.col(part), F.col(total))
        for _, disease, free, total, other in HOSPITAL_RESOURCES
        for part in (free, other, disease)
    }
    shares["BedsInpatientUsedCovidProportion"] = guarded_ratio(
        F.col("BedsInpatientUsedCovid"), F.col("BedsInpatientTotal")
    )
    return rolling_max(
        df.withColumns(shares), "HospitalsReporting", "HospitalsTotal", strategy=strategy
    )


def age_bands(df: DataFrame) -> DataFrame:
    """Counts and shares per age band from counts at or above age thresholds.

    The open band's ``Initiated_NotCompleted`` is its population less the
    completed, the same number as its ``NotFullyVaccinated``; the closed bands
    take initiated less completed.
    """
    over = OPEN_BAND
    counts: dict[str, Column] = {}
    for band, low, high in AGE_BANDS:
        for measure in ("RegimenCompleted_Total", "RegimenInitiated_Total"):
            counts[f"{measure}{band}"] = F.col(f"{measure}{low}") - F.col(f"{measure}{high}")
        counts[f"Population_{band}"] = F.col(f"Population{low}") - F.col(f"Population{high}")
    for band, low, high in AGE_BANDS[1:]:
        counts[f"Boosted_Total{band}"] = F.col(f"Boosted_Total{low}") - F.col(
            f"Boosted_Total{high}"
        )

    rest: dict[str, Column] = {}
    population = {over: f"Population{over}"}
    shared: list[tuple[str, str, str]] = []
    for band, _, _ in AGE_BANDS:
        people = population[band] = f"Population_{band}"
        completed = F.col(f"RegimenCompleted_Total{band}")
        initiated = F.col(f"RegimenInitiated_Total{band}")
        neither = "Unvaccinated" if band == "18to65" else "Neither_Initiated_Nor_Completed"
        rest[f"NotFullyVaccinated_{band}"] = F.col(people) - completed
        rest[f"Initiated_NotCompleted_Total{band}"] = initiated - completed
        rest[f"{neither}_Total{band}"] = F.col(people) - initiated
        shared += [
            (f"RegimenCompleted_Total{band}", band, ""),
            (f"RegimenInitiated_Total{band}", band, ""),
        ]
    people = F.col(population[over])
    rest[f"Initiated_NotCompleted_Total{over}"] = people - F.col(f"RegimenCompleted_Total{over}")
    rest[f"Unvaccinated_Total{over}"] = people - F.col(f"RegimenInitiated_Total{over}")
    rest[f"NotFullyVaccinated_{over}"] = people - F.col(f"RegimenCompleted_Total{over}")

    measured = [name for name, _, _ in shared] + list(rest)
    measured += [f"Boosted_Total{band}" for band, _, _ in AGE_BANDS[1:]] + [f"Boosted_Total{over}"]
    bands = [band for band, _, _ in AGE_BANDS] + [over]

    def band_of(name: str) -> str:
        return next(b for b in bands if name.endswith(b))

    shares = {
        f"{name}Prop": guarded_ratio(F.col(name), F.col(population[band_of(name)]))
        for name in measured
    }
    return df.withColumns(counts).withColumns(rest).withColumns(shares)


def first_difference(
    df: DataFrame,
    columns: Mapping[str, str],
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Set each new column to the change of its source since the key's last report.

    With ``strategy="blocks"`` no task holds a key (see :mod:`.positions`);
    ``ties`` orders the rows that a key has on one day.
    """
    check_lag_strategy(strategy)
    if strategy == "blocks":
        earlier = {f"_last_{new}": source for new, source in columns.items()}
        found = with_earlier(df, earlier, 1, ties=ties, key=key, date=date)
        changes = {new: F.col(source) - F.col(f"_last_{new}") for new, source in columns.items()}
        return found.withColumns(changes).drop(*earlier)
    reports = Window.partitionBy(key).orderBy(date)
    return df.withColumns(
        {
            new: F.col(source) - F.lag(source, 1).over(reports)
            for new, source in columns.items()
        }
    )


def daily_vaccinations(df: DataFrame, strategy: str = "window") -> DataFrame:
    """New doses and regimens per report, running totals renamed, shares of people."""
    daily = first_difference(
        df,
        {
            "DosesAdministered_New": "DosesAdministered_Total",
            "RegimenInitiated_New": "RegimenInitiated_Count",
            "RegimenCompleted_New": "RegimenCompleted_Count",
        },
        strategy=strategy,
    ).withColumnsRenamed(
        {
            "RegimenInitiated_Count": "RegimenInitiated_Total",
            "RegimenCompleted_Count": "RegimenCompleted_Total",
        }
    )
    return daily.withColumns(
        {
            f"{regimen}_PropPop": guarded_ratio(F.col(f"{regimen}_Total"), F.col("Population"))
            for regimen in ("RegimenInitiated", "RegimenCompleted")
        }
    )


def vaccination_rates(df: DataFrame) -> DataFrame:
    """Newly completed and initiated regimens, overall and by age group."""
    groups = ("", "GTE18", "GTE65", "12to17", "18to65")
    differences = {
        f"{regimen}_Total{group}_Rate": f"{regimen}_Total{group}"
        for group in groups
        for regimen in ("RegimenCompleted", "RegimenInitiated")
    }
    rated = first_difference(df, differences)
    rates = [c for c in rated.columns if c.endswith("_Rate")]
    return rated.select("Jurisdiction", "GeoID", "Region", "State", "Date", *rates)


def positive_and_negative_tests(df: DataFrame) -> DataFrame:
    return df.withColumn("TestsNegativeNew", F.col("TestsNew") - F.col("CasesNew"))


def seven_day_ratios(df: DataFrame, suffix: str) -> DataFrame:
    """Positivity, deaths per case and admissions per case of a 7-day summary."""
    cases = F.col("CasesNew7DayTotal")
    return df.withColumns(
        {
            f"DeathsToCases7Day{suffix}": guarded_ratio(F.col("DeathsNew7DayTotal"), cases),
            f"HospsToCases7Day{suffix}": guarded_ratio(F.col("CovidNew7DayTotal"), cases),
        }
    )


def against_testing_targets(df: DataFrame, population: DataFrame) -> DataFrame:
    """7-day summary with ratios, testing targets and the KPIs against them."""
    rated = seven_day_ratios(df, "Proportion").withColumns(
        {
            "TestsPositiveNew7DayAvgProportion": guarded_ratio(
                F.col("CasesNew7DayTotal"), F.col("TestsNew7DayTotal")
            ),
            "BedsInpatientUsedCovid7DayAvgProportion": guarded_ratio(
                F.col("BedsInpatientUsedCovid7DayAvg"), F.col("BedsInpatientTotal7DayAvg")
            ),
        }
    )
    # Only places of the population table have targets; elsewhere they are NULL.
    standards = population.select("GeoID", "Population").withColumns(
        {
            "PopulationTestStandard": F.ceil(F.col("Population") / 100000) * TESTS_PER_100K,
            "PositiveTestStandardProportion": F.lit(POSITIVE_SHARE),
            "PositiveTestStandard": F.lit(POSITIVE_PERCENT),
        }
    )
    return lookup(rated, standards).withColumns(
        {
            "KPI_PositiveTests": target_kpi(
                F.col("TestsPositiveNew7DayAvgProportion"),
                F.col("PositiveTestStandardProportion"),
                above_good=False,
            ),
            "KPI_PopulationTests": target_kpi(
                F.col("TestsNew7DayAvg"), F.col("PopulationTestStandard"), above_good=True
            ),
        }
    )


def override_by_key(
    df: DataFrame, column: str, values: Mapping[str, int], key: str = KEY
) -> DataFrame:
    """Replace ``column`` for the keys of a small configured mapping."""
    value = F.col(column)
    for name, fixed in values.items():
        value = F.when(F.col(key) == name, F.lit(fixed).cast("bigint")).otherwise(value)
    return df.withColumn(column, value)


def drop_unkeyed(df: DataFrame, keys: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """Rows that have all of ``keys`` (a row without them belongs to no panel)."""
    return df.dropna(subset=list(keys))
