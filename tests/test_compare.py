from __future__ import annotations

import pytest
from conftest import day, rows_of

from paneltrend.operators import (
    compare_periods,
    compare_wide,
    latest_per_key,
    period_table,
    with_previous,
)
from paneltrend.specs import MeasureSpec, PeriodMeasureSpec

UP = MeasureSpec("up##DayTotal", up_good=True)
DOWN = MeasureSpec("down##DayTotal", up_good=False)
COLUMNS = ["up1DayTotal", "down1DayTotal"]


def compared(make_panel, before, now):
    df = make_panel([("a", 0, before, before), ("a", 1, now, now)], COLUMNS, kind="double")
    long = compare_periods(df, (UP, DOWN), days=1).where("Date = date'2021-03-02'")
    return {r["Measure"][0]: r for r in long.collect()}


@pytest.mark.parametrize(
    "before,now,ratio,kpi_up,kpi_down",
    [
        (0.0, 0.0, 1.0, 3, 3),
        (0.0, 5.0, None, 4, 5),
        (0.0, -5.0, None, 2, 1),
        (5.0, 0.0, 0.0, 2, 1),
        (5.0, 5.0, 1.0, 3, 3),
        (None, 5.0, None, None, None),
        (5.0, None, None, None, None),
        (100.0, 95.0, 0.95, 2, 1),
        (10000.0, 9501.0, 0.9501, 3, 3),
        (10000.0, 10499.0, 1.0499, 3, 3),
        (100.0, 105.0, 1.05, 4, 5),
    ],
)
def test_ratio_and_kpi(make_panel, before, now, ratio, kpi_up, kpi_down):
    rows = compared(make_panel, before, now)
    assert rows["u"]["WeekChangeRatio"] == ratio
    assert rows["u"]["WeekChangeProp"] == (None if ratio is None else ratio - 1)
    assert (rows["u"]["KPI_ID"], rows["d"]["KPI_ID"]) == (kpi_up, kpi_down)


def test_lag_counts_rows_while_dateprev_counts_days(make_panel):
    measure = MeasureSpec("x##DayTotal", up_good=False)
    df = make_panel([("a", 0, 1), ("a", 1, 2), ("a", 9, 3)], ["x2DayTotal"])
    long = compare_periods(df, (measure,), days=2)
    assert rows_of(long, "Date", "DatePrev", "PreviousWeekValue") == [
        (day(0), day(-2), None),
        (day(1), day(-1), None),
        (day(9), day(7), 1),
    ]


def test_lag_may_differ_from_days(make_panel):
    measure = MeasureSpec("x7DayTotal", up_good=False)
    df = make_panel([("a", 0, 1), ("a", 7, 2), ("a", 14, 3)], ["x7DayTotal"])
    long = compare_periods(df, (measure,), days=7, lag=1)
    assert [r[1] for r in rows_of(long, "Date", "PreviousWeekValue")] == [None, 1, 2]


def test_whole_measures_stay_whole_and_mixed_become_double(make_panel):
    df = make_panel([("a", 0, 1)], ["x7DayTotal"]).selectExpr("*", "1.5D as x7DayAvg")
    total = MeasureSpec("x##DayTotal", up_good=False)
    mean = MeasureSpec("x##DayAvg", up_good=False)
    assert dict(compare_periods(df, (total,)).dtypes)["CurrentWeekValue"] == "bigint"
    assert dict(compare_periods(df, (total, mean)).dtypes)["CurrentWeekValue"] == "double"


def test_rows_are_input_rows_times_measures(make_panel):
    df = make_panel([("a", d, d, d) for d in range(5)], COLUMNS)
    assert compare_periods(df, (UP, DOWN), days=1).count() == 10


def test_filter_before_stacking_equals_filter_after(make_panel):
    df = make_panel(
        [(k, d, d * 3 % 7, d % 4) for k in "abc" for d in range(0, 30, 2)], COLUMNS
    )
    early = compare_wide(latest_per_key(with_previous(df, (UP, DOWN), 1)), (UP, DOWN), 1)
    late = latest_per_key(compare_periods(df, (UP, DOWN), 1), ("GeoID", "Measure"))
    assert sorted(early.collect()) == sorted(late.collect())


PERIODS = (
    PeriodMeasureSpec("cases", "Total", "Cases", up_good=False),
    PeriodMeasureSpec("beds", "Total", "Beds", up_good=True, per_capita=False),
)


@pytest.fixture
def population(spark):
    return spark.createDataFrame([("a", 1000), ("b", 0)], "GeoID string, Population int")


def periods(make_panel, population, rows, days=2, lag=0, **options):
    df = make_panel(rows, ["cases2DayTotal", "beds2DayTotal"])
    return period_table(df, days, lag, PERIODS, population, **options)


def test_period_table_picks_by_rank(make_panel, population):
    rows = [("a", 0, 1, 9), ("a", 1, 2, 9), ("a", 2, 3, 9), ("a", 30, 6, 9), ("a", 31, 12, 18)]
    got = periods(make_panel, population, rows).where("Measure = 'Cases'").first()
    assert (got["CurrentDate"], got["PreviousDate"]) == (day(31), day(2))
    assert (got["CurrentNew"], got["PreviousNew"], got["Change"]) == (12, 3, 9)
    assert (got["CurrentNewPer100K"], got["PreviousNewPer100K"]) == (1200.0, 300.0)
    assert (got["ChangePer100K"], got["ChangeRatio"], got["KPI_ID"]) == (900.0, 4.0, 5)
    assert (got["KPI_Color"], got["DayPeriod"], got["LagDays"]) == ("#ff3a22", 2, 0)


def test_measure_without_per_capita(make_panel, population):
    rows = [("a", d, 1, 9 + d) for d in range(5)]
    got = periods(make_panel, population, rows).where("Measure = 'Beds'").first()
    assert got["CurrentNewPer100K"] is got["PreviousNewPer100K"] is got["ChangePer100K"] is None
    assert (got["Change"], got["KPI_ID"], got["KPI_Color"]) == (2, 4, "#06C72F")


def test_short_key_has_no_previous(make_panel, population):
    got = periods(make_panel, population, [("a", 0, 1, 1), ("a", 1, 2, 2)]).first()
    assert got["PreviousDate"] is got["PreviousNew"] is got["ChangeRatio"] is got["KPI_ID"] is None


def test_zero_against_zero_is_a_fall_here(make_panel, population):
    rows = [("a", d, 0, 0) for d in range(5)]
    got = {r["Measure"]: r for r in periods(make_panel, population, rows).collect()}
    assert got["Cases"]["ChangeProp"] == -1.0 and got["Cases"]["ChangeRatio"] == 0.0
    assert (got["Cases"]["KPI_ID"], got["Beds"]["KPI_ID"]) == (1, 2)


def test_rise_from_zero_goes_by_sign(make_panel, population):
    rows = [("a", 0, 0, 0), ("a", 1, 0, 0), ("a", 2, 5, 5)]
    got = {r["Measure"]: r for r in periods(make_panel, population, rows).collect()}
    assert got["Cases"]["ChangeRatio"] is None
    assert (got["Cases"]["KPI_ID"], got["Beds"]["KPI_ID"]) == (5, 4)


def test_empty_population_gives_null_rates(make_panel, population):
    got = periods(make_panel, population, [("b", d, 1, 1) for d in range(3)]).first()
    assert got["CurrentNewPer100K"] is None


def test_kpi_band_follows_the_percentage(make_panel, population):
    rows = [("a", 0, 100, 100), ("a", 1, 0, 0), ("a", 2, 108, 108)]
    wide = periods(make_panel, population, rows, percent=10).where("Measure = 'Cases'").first()
    assert wide["KPI_ID"] == 3 and wide["KPI_Color"] == "#E1E500"


def test_period_table_cut_is_global(make_panel, population):
    rows = [("a", d, d, d) for d in range(6)] + [("b", 20, 1, 1)]
    got = periods(make_panel, population, rows, lag=15).where("GeoID = 'a'").first()
    assert got["CurrentDate"] == day(5)
