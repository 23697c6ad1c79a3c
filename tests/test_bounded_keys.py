"""Strategies that hold no key's rows in one task equal the windows."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.errors import PySparkException

from paneltrend.operators import change_since, period_table
from paneltrend.specs import Attachment, ChangeSpec, ChangeWindow, PeriodMeasureSpec

MEASURES = (PeriodMeasureSpec("x", "Total", "X", True), PeriodMeasureSpec("y", "Avg", "Y", False, per_capita=False))
SPEC = ChangeSpec((("X", "x"), ("Y", "y")), "X", (Attachment("Other", "Y"),))
GRID = (ChangeWindow(7, 3), ChangeWindow(3, 0, "Raw"), ChangeWindow(40, 3), ChangeWindow(None))


def panel(make_panel, spark, names, seed=3):
    rng = random.Random(seed)
    rows = [(k, d, 1000, rng.randrange(9), rng.randrange(9)) for k in "abcde" for d in range(60) if rng.random() < 0.7]
    rows += [("few", 1, 10, 1, 2), (None, 3, 10, 1, 1), ("none", None, 10, 1, 1)]
    return make_panel(rows, ["Population", *names]).repartition(4)


def same(got, want):
    assert got.columns == want.columns
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("lag", [0, 10])
def test_period_tables_by_days(make_panel, spark, lag):
    df = panel(make_panel, spark, ["x7DayTotal", "y7DayAvg"]).drop("Population")
    people = spark.createDataFrame([(k, 500) for k in "abcd"], "GeoID string, Population int")
    same(
        period_table(df, 7, lag, MEASURES, people, strategy="days"),
        period_table(df, 7, lag, MEASURES, people),
    )
    with pytest.raises(ValueError, match="strategy"):
        period_table(df, 7, lag, MEASURES, people, strategy="join")


def test_no_window_of_a_period_table_by_days_runs_over_rows(make_panel, spark):
    df = panel(make_panel, spark, ["x7DayTotal", "y7DayAvg"]).drop("Population")
    people = spark.createDataFrame([("a", 500)], "GeoID string, Population int")
    plan = period_table(df, 7, 0, MEASURES, people, strategy="days")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_n#" in line for line in windows) and not any("rank(" in line for line in windows)


def test_changes_by_an_index_of_days(make_panel, spark):
    df = panel(make_panel, spark, ["x", "y"])
    same(change_since(df, SPEC, GRID, strategy="index"), change_since(df, SPEC, GRID))
    plan = change_since(df, SPEC, GRID, strategy="index")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan
    with pytest.raises(ValueError, match="strategy"):
        change_since(df, SPEC, GRID, strategy="join")


def test_several_rows_on_an_anchor_day_fail_by_index_too(make_panel, spark):
    df = make_panel([("a", 0, 5, 1, 1), ("a", 0, 5, 2, 2)], ["Population", "x", "y"])
    with pytest.raises(PySparkException, match="several rows on an anchor day of a"):
        change_since(df, SPEC, GRID, strategy="index").collect()

