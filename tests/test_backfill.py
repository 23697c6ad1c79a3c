"""Back-updates: partial rebuilds equal full ones and touch few rows."""

from __future__ import annotations

import random

import pytest
from conftest import day, rows_of

from paneltrend.operators import (
    changed_days,
    compare_again,
    first_difference,
    key_month_digests,
    rolling_max,
    rolling_summary,
    roll_again,
    with_previous,
)
from paneltrend.specs import MeasureSpec, RollSpec

ROLLED = (RollSpec("x"), RollSpec("y", total=False))
COMPARED = (MeasureSpec("x##DayTotal", True), MeasureSpec("y##DayAvg", False))


def states(seed):
    """A panel with gaps before and after corrections, late reports and withdrawn ones."""
    rng = random.Random(seed)
    was = {
        (k, d): (rng.choice([None, rng.randrange(9)]), rng.randrange(9))
        for k in "abcdefgh"
        for d in range(150)
        if rng.random() < 0.8
    }
    now = dict(was)
    for _ in range(rng.randrange(1, 9)):
        at = (rng.choice("ab"), rng.randrange(150))
        kind = rng.randrange(3)
        if kind == 0 or at not in now:
            now[at] = (rng.choice([None, 100]), 50)
        elif kind == 1:
            del now[at]
        else:
            now[at] = (now[at][0], now[at][1] + 1)
    return was, now


def frame(make_panel, rows):
    return make_panel([(k, d, *v) for (k, d), v in rows.items()], ["x", "y"])


def same(got, want):
    assert got.columns == want.columns
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("seed", [1, 2])
def test_partial_rebuilds_equal_full_ones(make_panel, seed):
    a, b = states(seed)
    was, now = frame(make_panel, a).repartition(3), frame(make_panel, b)
    changed = changed_days(was, now).cache()
    want = {k for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    assert rows_of(changed, "GeoID", "Date") == sorted((k, day(d)) for k, d in want)

    full = rolling_summary(now, 7, ROLLED)
    rolled = roll_again(rolling_summary(was, 7, ROLLED), now, changed, 7, ROLLED)
    same(rolled.table, full)
    assert 0 < rolled.fresh.count() <= 7 * len(want)

    for lag in (None, 1, 30):
        before = with_previous(rolling_summary(was, 7, ROLLED), COMPARED, lag=lag)
        again = compare_again(before, rolled.table, rolled.touched, COMPARED, lag=lag)
        same(again.table, with_previous(full, COMPARED, lag=lag))
        assert again.fresh.count() <= (7 + (lag or 7)) * len(want)


def test_equal_states_touch_nothing(make_panel):
    a, _ = states(5)
    was, now = frame(make_panel, a), frame(make_panel, dict(reversed(a.items()))).repartition(4)
    changed = changed_days(was, now)
    assert changed.count() == 0
    assert rows_of(key_month_digests(was), "GeoID", "_month", "_high") == rows_of(key_month_digests(now), "GeoID", "_month", "_high")
    full = rolling_summary(now, 7, ROLLED)
    rolled = roll_again(rolling_summary(was, 7, ROLLED), now, changed, 7, ROLLED)
    assert rolled.fresh.count() == 0 and rolled.touched.count() == 0
    same(rolled.table, full)


def test_rows_without_key_or_day_do_not_count(make_panel):
    was = make_panel([("a", 0, 1, 1), (None, 0, 1, 1), ("a", None, 1, 1)], ["x", "y"])
    now = make_panel([("a", 0, 1, 1), (None, 0, 2, 1)], ["x", "y"])
    assert changed_days(was, now).count() == 0
    assert changed_days(was, now.limit(0)).count() == 1


# -- positions without whole keys


@pytest.mark.parametrize("step", [1, 3, 40])
def test_lags_by_blocks_equal_windows(make_panel, step):
    a, _ = states(7)
    df = frame(make_panel, a).repartition(5)
    rolled = rolling_summary(df, 7, ROLLED)
    same(
        with_previous(rolled, COMPARED, lag=step, strategy="blocks"),
        with_previous(rolled, COMPARED, lag=step),
    )
    same(first_difference(df, {"z": "y"}, strategy="blocks"), first_difference(df, {"z": "y"}))


def test_lags_by_blocks_order_the_rows_of_a_day(make_panel):
    rows = [("a", 1, 3, 7), ("a", 1, 1, 5), ("a", 1, 2, 6), ("a", 0, 9, 1), ("b", 1, 0, 2), (None, 1, 1, 1), (None, 2, 1, 4), ("b", None, 8, 3)]
    df = make_panel(rows, ["x", "y"])
    got = first_difference(df, {"z": "y"}, strategy="blocks", ties=("x",))
    assert sorted((r["GeoID"] or "", r["y"], r["z"]) for r in got.collect() if r["z"] is not None) == [
        ("", 4, 3), ("a", 5, 4), ("a", 6, 1), ("a", 7, 1), ("b", 2, -1),
    ]
    with pytest.raises(ValueError, match="strategy"):
        first_difference(df, {"z": "y"}, strategy="join")


def test_no_window_of_a_block_lag_holds_a_key(make_panel):
    a, _ = states(7)
    df = first_difference(frame(make_panel, a), {"z": "y"}, strategy="blocks")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert len(rows) == 2 and all(line.count("GeoID#") >= 1 and "Date#" in line.rsplit("], [", 2)[1] for line in rows)
    # windows by key alone run over counts by day
    assert all("_reports" in line for line in plan.splitlines() if "Window [" in line and "row_number" not in line)


@pytest.mark.parametrize("days", [1, 7, 40])
def test_blocks_cost_the_same_for_any_range(make_panel, days):
    a, _ = states(9)
    df = frame(make_panel, a)
    same(rolling_summary(df, days, ROLLED, strategy="blocks"), rolling_summary(df, days, ROLLED))
    same(
        rolling_max(df, "x", "m", before=days, after=days // 2, strategy="blocks"),
        rolling_max(df, "x", "m", before=days, after=days // 2),
    )
