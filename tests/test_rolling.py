from __future__ import annotations

import random

import pytest
from conftest import day, rows_of

from paneltrend.operators import rolling_max, rolling_summary
from paneltrend.specs import RollSpec

BOTH = (RollSpec("x"),)
STRATEGIES = ("window", "explode", "blocks")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_window_is_by_calendar_not_by_row(make_panel, strategy):
    df = make_panel([("a", 0, 1), ("a", 1, 2), ("a", 8, 4)], ["x"])
    got = rolling_summary(df, 7, BOTH, strategy=strategy)
    assert rows_of(got, "Date", "x7DayTotal", "x7DayAvg") == [
        (day(0), 1, 1.0),
        (day(1), 3, 1.5),
        (day(8), 4, 4.0),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_average_divides_by_values_present(make_panel, strategy):
    df = make_panel([("a", 0, 3), ("a", 1, None), ("a", 2, 6)], ["x"])
    got = rolling_summary(df, 7, BOTH, strategy=strategy)
    assert rows_of(got, "Date", "x7DayTotal", "x7DayAvg")[-1] == (day(2), 9, 4.5)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_range_without_values_is_null(make_panel, strategy):
    df = make_panel([("a", 0, None), ("a", 1, None), ("b", 0, 5)], ["x"])
    got = rolling_summary(df, 7, BOTH, strategy=strategy)
    assert rows_of(got, "GeoID", "x7DayTotal", "x7DayAvg") == [
        ("a", None, None),
        ("a", None, None),
        ("b", 5, 5.0),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rows_without_key_or_date_get_nulls_and_feed_nothing(make_panel, strategy):
    df = make_panel([("a", 0, 1), ("a", None, 50), ("a", None, 60), (None, 0, 70), (None, 1, 80)], ["x"])
    got = rolling_summary(df, 7, BOTH, strategy=strategy)
    assert got.count() == 5
    assert rows_of(got.where("x7DayTotal is not null"), "GeoID", "Date", "x7DayTotal") == [
        ("a", day(0), 1)
    ]


def test_columns_follow_the_spec(make_panel):
    df = make_panel([("a", 0, 1, 2)], ["x", "y"])
    specs = (RollSpec("y", avg=False), RollSpec("z", expr="x + y"), RollSpec("x", total=False))
    got = rolling_summary(df, 14, specs)
    assert got.columns[5:] == ["y14DayTotal", "z14DayTotal", "z14DayAvg", "x14DayAvg"]
    assert got.first()["z14DayTotal"] == 3


def test_a_spec_must_ask_for_something():
    with pytest.raises(ValueError):
        RollSpec("x", avg=False, total=False)


def test_unknown_strategy(make_panel):
    with pytest.raises(ValueError):
        rolling_summary(make_panel([("a", 0, 1)], ["x"]), 7, BOTH, strategy="magic")


@pytest.mark.parametrize("seed,days", [(1, 7), (2, 14), (3, 1)])
def test_both_strategies_equal_brute_force(make_panel, seed, days):
    """Random gappy panel with NULLs and repeated days against a quadratic scan."""
    rng = random.Random(seed)
    rows = [
        (rng.choice("abc"), rng.randrange(60), rng.choice([None, *range(-3, 9)]))
        for _ in range(120)
    ]
    df = make_panel(rows, ["x"])
    expected = []
    for key, d, _ in rows:
        seen = [v for k, e, v in rows if k == key and d - days < e <= d and v is not None]
        expected.append(
            (key, day(d), sum(seen) if seen else None, sum(seen) / len(seen) if seen else None)
        )
    expected.sort(key=lambda row: [(v is not None, v) for v in row])
    for strategy in STRATEGIES:
        got = rolling_summary(df, days, BOTH, strategy=strategy)
        assert rows_of(got, "GeoID", "Date", f"x{days}DayTotal", f"x{days}DayAvg") == expected


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_centred_max_reaches_ten_days_both_ways(make_panel, strategy):
    df = make_panel(
        [("a", 0, 5), ("a", 10, 3), ("a", 11, 4), ("a", 40, None), ("a", None, 99)], ["n"]
    )
    got = rolling_max(df, "n", "peak", strategy=strategy)
    assert got.columns == [*df.columns, "peak"]
    assert rows_of(got, "Date", "peak") == [
        (None, None),
        (day(0), 5),
        (day(10), 5),
        (day(11), 4),
        (day(40), None),
    ]


def test_large_counts_do_not_overflow(spark, make_panel):
    df = make_panel([("a", 0, 2**31 - 1), ("a", 1, 2**31 - 1)], ["x"], kind="int")
    got = rolling_summary(df, 7, BOTH)
    assert rows_of(got, "x7DayTotal")[-1] == (2**32 - 2,)
