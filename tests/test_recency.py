from __future__ import annotations

import pytest
from conftest import day, rows_of
from pyspark.errors import PySparkException

from paneltrend.operators import change_since
from paneltrend.plans.hub import CASE_CHANGES, case_changes, case_windows, vaccination_changes
from paneltrend.specs import ChangeWindow

MEASURES = ["CasesTotal", "DeathsTotal", "TestsTotal", "Population"]


def test_change_between_two_days(make_panel):
    df = make_panel([("a", 0, 10, 1, 100, 1000), ("a", 7, 30, 2, 180, 2000)], MEASURES)
    got = change_since(df, CASE_CHANGES, (ChangeWindow(7, 0),))
    assert rows_of(got, "Measure", "Raw_Per100K", "NewValue", "PostitiveTests", "NegativeTests") == [
        ("Cases", "Per100K", 1000.0, None, None),
        ("Cases", "Raw", 20.0, None, None),
        ("Deaths", "Per100K", 50.0, None, None),
        ("Deaths", "Raw", 1.0, None, None),
        ("Tests", "Per100K", 4000.0, 1000.0, 3000.0),
        ("Tests", "Raw", 80.0, 20.0, 60.0),
    ]
    assert set(rows_of(got, "Date", "Population", "days", "lagDays", "SlicerLevels", "filterLevels")) == {
        (day(7), 2000, 7, 0, "Last 7 days", "07_00")
    }


def test_missing_earlier_day_gives_null(make_panel):
    df = make_panel([("a", 1, 10, 1, 100, 1000), ("a", 7, 30, 2, 180, 2000)], MEASURES)
    got = change_since(df, CASE_CHANGES, (ChangeWindow(7, 0),))
    assert got.count() == 6
    assert got.where("NewValue is not null").count() == 0


def test_anchor_is_the_keys_last_row_after_its_own_cut(make_panel):
    rows = [("a", d, d, 0, d, 1000) for d in (0, 3, 10, 25)] + [("b", d, 2 * d, 0, d, 1000) for d in (0, 7, 8)]
    df = make_panel(rows, MEASURES)
    got = change_since(df, CASE_CHANGES, (ChangeWindow(7, 10),)).where("Measure = 'Cases' and Raw_Per100K = 'Raw'")
    # a: newest 25, cut 15, anchor 10, earlier day 3; b: cut before all rows but none.
    assert rows_of(got, "GeoID", "Date", "NewValue") == [("a", day(10), 7.0)]
    assert set(rows_of(got, "SlicerLevels", "filterLevels")) == {("Last 7 days*", "07_10")}


def test_all_time(make_panel):
    df = make_panel([("a", 0, 1, 1, 1, 1000), ("a", 5, 10, 2, 50, 1000)], MEASURES)
    got = change_since(df, CASE_CHANGES, (ChangeWindow(None),))
    assert rows_of(got.where("Raw_Per100K = 'Raw'"), "Measure", "NewValue", "NegativeTests") == [
        ("Cases", 10.0, None),
        ("Deaths", 2.0, None),
        ("Tests", 50.0, 40.0),
    ]
    assert set(rows_of(got, "days", "lagDays", "SlicerLevels", "filterLevels")) == {
        (None, None, "All Time", "9999")
    }


def test_keep_filters_kinds_per_window(make_panel):
    df = make_panel([("a", 0, 1, 1, 1, 1000), ("a", 7, 10, 2, 50, 1000)], MEASURES)
    windows = (ChangeWindow(7, 0, "Raw"), ChangeWindow(None, None, "Per100K"))
    got = change_since(df, CASE_CHANGES, windows)
    assert set(rows_of(got, "filterLevels", "Raw_Per100K")) == {("07_00", "Raw"), ("9999", "Per100K")}


def test_bad_keep_is_an_error():
    with pytest.raises(ValueError):
        ChangeWindow(7, 0, "Neither")


def test_long_windows_keep_their_digits():
    assert ChangeWindow(100, 5).filter_key == "100_05"


def test_null_dates_and_empty_population(make_panel):
    df = make_panel([("a", 0, 1, 1, 1, 0), ("a", 7, 10, 2, 50, 0), ("a", None, 99, 9, 9, 0)], MEASURES)
    got = change_since(df, CASE_CHANGES, (ChangeWindow(7, 0),)).where("Measure = 'Cases'")
    assert rows_of(got, "Raw_Per100K", "NewValue") == [("Per100K", None), ("Raw", 9.0)]


def test_case_labels(make_panel):
    df = make_panel([("a", d, d, d, d, 1000) for d in range(120)], MEASURES)
    got = case_changes(df, case_windows(10))
    assert got.count() == 36
    assert set(rows_of(got.where("Measure = 'Tests'"), "Raw_Per100K")) == {
        ("Total Tests",),
        ("Total Tests Per 100K",),
    }


def test_vaccination_shares(make_panel):
    columns = ["DosesAdministered_Total", "RegimenInitiated_Total", "RegimenCompleted_Total", "Population"]
    df = make_panel([("a", 0, 10, 4, 2, 1000), ("a", 7, 30, 14, 7, 1000)], columns)
    got = vaccination_changes(df, (ChangeWindow(7),))
    assert rows_of(got, "Raw_Per100K", "NewValue", "RegimenInitiated", "RegimenInitiated_PropPop", "RegimenCompleted_PropPop") == [
        ("Total", 20.0, 10.0, 0.01, 0.005),
        ("Total Per 100K", 2000.0, 1000.0, 0.01, 0.005),
    ]
    assert got.columns[-2:] == ["SlicerLevels", "filterLevels"]


def test_two_rows_on_an_anchor_day_fail_instead_of_merging(make_panel):
    rows = [("a", 0, 10, 1, 100, 1000), ("a", 7, 30, 2, 180, 2000), ("b", 7, 1, 1, 1, 1)]
    twice = make_panel([*rows, ("a", 7, 31, 0, 190, 2000)], MEASURES)
    for window in (ChangeWindow(7, 0), ChangeWindow(None)):
        with pytest.raises(PySparkException, match="several rows on an anchor day of a"):
            change_since(twice, CASE_CHANGES, (window,)).collect()
    elsewhere = make_panel([*rows, ("a", 3, 1, 1, 1, 1), ("a", 3, 2, 2, 2, 2)], MEASURES)
    assert change_since(elsewhere, CASE_CHANGES, (ChangeWindow(7, 0),)).count() > 0
