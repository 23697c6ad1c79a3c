from __future__ import annotations

import datetime as dt

import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from paneltrend.functions import derive, kpi_color, target_kpi, weighted_whole_average
from paneltrend.operators import (
    age_bands,
    criteria_summary,
    daily_vaccinations,
    hospital_measures,
    override_by_key,
    rolling_summary,
    against_testing_targets,
    vaccination_rates,
)
from paneltrend.plans.base import ROLLED, merge_case_and_hospital
from paneltrend.sources.schemas import AGE_MEASURES, CASE_MEASURES, HOSPITAL_MEASURES


def hospital(make_panel, **values):
    defaults = dict.fromkeys(HOSPITAL_MEASURES, 1) | values
    return make_panel([("a", 0, *defaults.values())], list(defaults))


def test_derived_columns_see_earlier_ones(spark):
    got = derive(spark.range(1), [("x", "id + 1"), ("y", "x * 10")]).first()
    assert (got["x"], got["y"]) == (1, 10)


def test_residual_is_floored_but_null_stays(make_panel):
    got = hospital_measures(
        hospital(make_panel, BedsUsed=3, CovidTotal=5, BedsICUUsed=None, VentilatorsUsed=7, CovidVentilatorsUsed=2)
    ).first()
    assert got["BedsUsedOther"] == 0
    assert got["BedsICUUsedOther"] is None and got["BedsICUTotal"] is None
    assert got["VentilatorsUsedOther"] == 5


def test_totals_are_rebuilt_from_parts(make_panel):
    got = hospital_measures(
        hospital(make_panel, BedsTotal=999, BedsUsed=8, CovidTotal=3, BedsAvailable=2)
    ).first()
    assert got["BedsTotal"] == 2 + 5 + 3
    assert (got["BedsAvailableProportion"], got["BedsUsedOtherProportion"]) == (0.2, 0.5)
    assert got["CovidTotalProportion"] == 0.3


def test_share_of_nothing_is_null(make_panel):
    got = hospital_measures(
        hospital(make_panel, BedsUsed=0, CovidTotal=0, BedsAvailable=0, BedsInpatientTotal=0)
    ).first()
    assert got["BedsAvailableProportion"] is None
    assert got["BedsInpatientUsedCovidProportion"] is None


def test_reported_parts_are_null_if_one_is(make_panel):
    got = hospital_measures(hospital(make_panel, CovidNew24HSuspected=None)).first()
    assert got["CovidNew"] is None and got["BedsInpatientUsedCovid"] == 2


def test_merged_panel_is_built_from_reported_hospital_data(make_panel):
    cases = make_panel([("a", 0, *([4] * len(CASE_MEASURES)))], list(CASE_MEASURES))
    merged = merge_case_and_hospital(
        cases, hospital(make_panel, BedsTotal=999, BedsUsed=3, CovidTotal=5, HospitalsTotal=7)
    )
    row = merged.first()
    assert (row["BedsTotal"], row["HospitalsTotal"], row["CovidNew"]) == (999, 7, 2)
    rolled = rolling_summary(merged, 7, ROLLED).first()
    assert rolled["BedsUsedOther7DayTotal"] == -2


@pytest.fixture
def ages(make_panel):
    values = {name: 1000 - 7 * i * i for i, name in enumerate(AGE_MEASURES)}
    return make_panel([("a", 0, *values.values())], list(values)), values


def test_age_bands(ages):
    df, v = ages
    got = age_bands(df)
    row = got.first()
    assert len(got.columns) - len(df.columns) == 44
    people = v["PopulationGTE18"] - v["PopulationGTE65"]
    done = v["RegimenCompleted_TotalGTE18"] - v["RegimenCompleted_TotalGTE65"]
    begun = v["RegimenInitiated_TotalGTE18"] - v["RegimenInitiated_TotalGTE65"]
    assert row["Population_18to65"] == people
    assert row["RegimenCompleted_Total18to65"] == done
    assert row["NotFullyVaccinated_18to65"] == people - done
    assert row["Initiated_NotCompleted_Total18to65"] == begun - done
    assert row["Unvaccinated_Total18to65"] == people - begun
    assert row["Unvaccinated_Total18to65Prop"] == (people - begun) / people
    old = v["PopulationGTE65"]
    assert row["Unvaccinated_TotalGTE65Prop"] == (old - v["RegimenInitiated_TotalGTE65"]) / old
    assert row["Initiated_NotCompleted_TotalGTE65"] == row["NotFullyVaccinated_GTE65"]
    assert row["Boosted_Total12to17"] == v["Boosted_TotalGTE12"] - v["Boosted_TotalGTE18"]
    assert row["Boosted_TotalGTE65Prop"] == v["Boosted_TotalGTE65"] / old


def test_band_without_people_has_no_shares(ages):
    df, _ = ages
    row = age_bands(df.withColumn("PopulationGTE12", F.col("PopulationGTE5"))).first()
    assert row["Population_5to11"] == 0 and row["RegimenCompleted_Total5to11Prop"] is None


def test_daily_vaccinations(make_panel):
    columns = ["DosesAdministered_Total", "RegimenInitiated_Count", "RegimenCompleted_Count", "Population"]
    df = make_panel([("a", 0, 5, 3, 1, 10), ("a", 4, 9, 4, 1, 0), ("b", 0, 1, 1, 1, 10)], columns)
    got = daily_vaccinations(df)
    assert rows_of(got, "GeoID", "DosesAdministered_New", "RegimenCompleted_New", "RegimenInitiated_PropPop") == [
        ("a", None, None, 0.3),
        ("a", 4, 0, None),
        ("b", None, None, 0.1),
    ]
    assert "RegimenInitiated_Total" in got.columns and "RegimenInitiated_Count" not in got.columns


def test_vaccination_rates(ages, make_panel):
    df, _ = ages
    got = vaccination_rates(age_bands(df))
    assert len(got.columns) == 15 and all(c.endswith("_Rate") for c in got.columns[5:])


def rolled_week(make_panel, cases, tests):
    names = [n for spec in ROLLED for n in spec.names(7)]
    values = dict.fromkeys(names, 1) | {"CasesNew7DayTotal": cases, "TestsNew7DayTotal": tests}
    return make_panel([("a", 0, *values.values())], list(values))


@pytest.mark.parametrize(
    "cases,tests,kpi", [(4, 100, 1), (5, 100, 2), (6, 100, 3), (1, 0, 2), (1, None, 2)]
)
def test_positive_tests_against_target(spark, make_panel, cases, tests, kpi):
    people = spark.createDataFrame([("a", 100001)], "GeoID string, Population int")
    got = against_testing_targets(rolled_week(make_panel, cases, tests), people).first()
    assert got["KPI_PositiveTests"] == kpi
    assert (got["PopulationTestStandard"], got["KPI_PopulationTests"]) == (300, 3)


def test_no_target_without_population(spark, make_panel):
    people = spark.createDataFrame([("z", 5)], "GeoID string, Population int")
    got = against_testing_targets(rolled_week(make_panel, 1, 2), people).first()
    assert got["PositiveTestStandard"] is None
    assert (got["KPI_PositiveTests"], got["KPI_PopulationTests"]) == (2, 2)


def test_target_direction(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    up = df.select(target_kpi(F.col("v"), F.lit(2.0), True).alias("k"))
    assert [r["k"] for r in up.collect()] == [3, 2, 1, 2]


def test_colours(spark):
    df = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, None)], "k int")
    got = [r[0] for r in df.select(kpi_color(F.col("k"))).collect()]
    assert got == ["#06C72F", "#ff3a22", "#E1E500", "#06C72F", "#ff3a22", None]


def test_weighted_average_rounds_half_to_even_and_is_wide(spark):
    rows = [(5, 7, 1), (7, 5, 1), (3, 7, 1), (2**40, 2**20, 2**20), (1, 1, 0)]
    df = spark.createDataFrame(rows, "v bigint, c bigint, r bigint")
    got = df.select(weighted_whole_average(F.col("v"), F.col("c"), F.col("r"), 14)).collect()
    # 2.5 -> 2, 2.5 -> 2, 1.5 -> 2
    assert [r[0] for r in got] == [2, 2, 2, round(2**40 / 14), None]


def test_override_only_touches_its_keys(make_panel):
    df = make_panel([("a", 0, 5), ("b", 0, 6)], ["x"])
    assert rows_of(override_by_key(df, "x", {"a": 189}), "GeoID", "x") == [("a", 189), ("b", 6)]


def test_criteria(spark, make_panel):
    names = [n for spec in ROLLED for n in spec.names(14)]
    values = dict.fromkeys(names, 1) | {
        "CasesNew14DayTotal": 50,
        "TestsNew14DayTotal": 200,
        "HospitalsTotal14DayTotal": 28,
        "HospitalsReporting14DayTotal": 14,
        "BedsAvailable14DayTotal": 14,
        "CovidTotal14DayTotal": 28,
        "BedsUsedOther14DayTotal": 35,
    }
    df = make_panel([("a", d, *values.values()) for d in range(30)], list(values))
    people = spark.createDataFrame([("a", 1000)], "GeoID string, Population int")
    got = criteria_summary(df, people, as_of=day(23))
    assert [d for (d,) in rows_of(got, "Date")] == [day(0), day(7), day(14)]
    row = got.first()
    assert row["CasesNew14DayTotalPer100K"] == 5000.0
    assert row["TestsPositivity14DayProportion"] == 0.25
    # beds 2, 4 and 5 of 11
    assert row["BedsUsedCovid14WAvg_Prop"] == 4 / 11
    assert dt.date.today() >= day(0) and criteria_summary(df, people).count() == 5
