from __future__ import annotations

import datetime as dt

import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from paneltrend.functions import WEEKDAYS, shifted_weekday, weekday_number
from paneltrend.operators import (
    Calendar,
    anchor_pair,
    cut_to_lag,
    cut_to_lag_by_key,
    cut_to_weekday,
    latest_per_key,
    mondays_as_of,
    newest_date,
    on_date_or_newest,
    thin_to_newest_weekday,
    thin_to_weekday,
    trailing_period,
)


def dates(df):
    return [d for (d,) in rows_of(df, "Date")]


@pytest.fixture
def fortnight(make_panel):
    return make_panel([("a", d, d) for d in range(14)], ["x"])


def test_global_cut_and_null_dates(make_panel):
    df = make_panel([("a", 0, 1), ("a", 5, 1), ("b", 2, 1), ("b", None, 1)], ["x"])
    assert dates(cut_to_lag(df, 3)) == [day(0), day(2)]


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_cut_by_key(make_panel, strategy):
    df = make_panel([("a", 0, 1), ("a", 5, 1), ("b", 0, 1), ("b", 2, 1), (None, 0, 1), (None, 9, 1)], ["x"])
    got = cut_to_lag_by_key(df, 2, strategy=strategy)
    assert rows_of(got, "GeoID", "Date") == [(None, day(0)), ("a", day(0)), ("b", day(0))]


def test_trailing_period_includes_both_ends(make_panel):
    df = make_panel([("a", d, d) for d in range(100)], ["x"])
    assert dates(trailing_period(df, 42)) == [day(d) for d in range(57, 100)]
    assert dates(trailing_period(df, 42, 10)) == [day(d) for d in range(47, 90)]


def test_thinning_to_the_newest_weekday(fortnight):
    assert dates(thin_to_newest_weekday(fortnight)) == [day(6), day(13)]
    assert dates(thin_to_newest_weekday(cut_to_lag(fortnight, 3))) == [day(3), day(10)]


@pytest.mark.parametrize("name", WEEKDAYS)
@pytest.mark.parametrize("lag", [0, 2, 10])
def test_shifted_weekday_is_the_weekday_that_many_days_before(name, lag):
    sunday_like = next(day(d) for d in range(7) if day(d).isoweekday() == weekday_number(name))
    expected = (sunday_like - dt.timedelta(days=lag)).isoweekday()
    assert shifted_weekday(weekday_number(name), lag) == expected


def test_thinning_to_a_weekday(fortnight):
    # Sunday less ten days is a Thursday.
    assert dates(thin_to_weekday(fortnight, 7, 10)) == [day(3), day(10)]


def test_unknown_weekday():
    with pytest.raises(ValueError):
        weekday_number("Caturday")


@pytest.mark.parametrize("weekday,last", [(1, 7), (3, 9), (7, 6)])
def test_cut_at_the_last_weekday(make_panel, weekday, last):
    df = make_panel([("a", d, d) for d in range(12)], ["x"])
    assert dates(cut_to_weekday(df, weekday))[-1] == day(last)
    assert dates(cut_to_weekday(df, weekday, 2))[-1] == day(last - 2)


def test_mondays_up_to_a_lag(make_panel):
    df = make_panel([("a", d, d) for d in range(30)], ["x"])
    # Wednesday of the fourth week; its Monday is day 21, less 7 is day 14.
    assert dates(mondays_as_of(df, 7, day(23))) == [day(0), day(7), day(14)]
    assert dates(mondays_as_of(df, 7, day(21))) == [day(0), day(7), day(14)]


def test_two_dates_take_the_newest_of_the_whole_table(make_panel):
    df = make_panel([("a", 0, 1), ("a", 4, 1), ("a", 5, 1), ("b", 9, 1)], ["x"])
    cutoff = F.lit(day(4))
    assert rows_of(on_date_or_newest(df, cutoff, ["a"]), "Date") == [(day(4),)]
    assert rows_of(on_date_or_newest(df, cutoff, ["a", "b"]), "Date") == [(day(4),), (day(9),)]


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_anchor_pair(make_panel, strategy):
    df = make_panel([("a", d, d) for d in (0, 3, 10, 25)] + [("b", 0, 1), ("b", 8, 1)], ["x"])
    got = anchor_pair(df, 7, 10, strategy=strategy)
    assert rows_of(got, "GeoID", "Date") == [("a", day(3)), ("a", day(10))]


@pytest.mark.parametrize("strategy", ["window", "join"])
def test_latest_keeps_ties(make_panel, strategy):
    df = make_panel([("a", 0, 1), ("a", 5, 2), ("a", 5, 3), ("b", 1, 4), (None, 2, 5), (None, 1, 6)], ["x"])
    got = latest_per_key(df, strategy=strategy)
    assert got.columns == df.columns
    assert rows_of(got, "GeoID", "x") == [(None, 5), ("a", 2), ("a", 3), ("b", 4)]


def test_newest_date_is_a_scalar(spark, fortnight):
    got = spark.range(1).select(newest_date(fortnight).alias("d")).first()
    assert got["d"] == day(13)


def test_shared_anchors_equal_own_ones(make_panel):
    gappy = make_panel([("a", d, d) for d in (0, 1, 5, 9, 16, 17, 30)] + [("b", None, 1)], ["n"])
    days = Calendar(gappy)
    for lag in (0, 2, 14, 40):
        cut = cut_to_lag(gappy, lag)
        assert dates(cut_to_lag(gappy, lag, newest=days.newest())) == dates(cut)
        assert dates(trailing_period(gappy, 9, lag, newest=days.newest())) == dates(trailing_period(gappy, 9, lag))
        thin = thin_to_newest_weekday(cut, newest=days.newest(lag))
        assert dates(thin) == dates(thin_to_newest_weekday(cut))
    assert cut_to_lag(gappy.limit(0), 2, newest=Calendar(gappy.limit(0)).newest()).count() == 0
