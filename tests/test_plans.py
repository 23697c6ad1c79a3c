"""Shape of the physical plans: what must and must not be in them."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import re

import pytest
from conftest import SF_DIR, rows_of

from checks.queries import PLACES, registered
from paneltrend.operators import (
    compare_wide,
    cut_to_lag,
    latest_per_key,
    rolling_summary,
    with_previous,
)
from paneltrend.plans.base import ROLLED
from paneltrend.plans.hub import COMPARED
from paneltrend.sources import TpchPanels

SAMPLE = [
    "rolling_7",
    "rolling_explode",
    "rolling_raw_events",
    "lag_cutoff_global",
    "lag_cutoff_raw_events",
    "trailing_6w_lag",
    "two_date_pick",
    "hospital_derive",
    "dense_panel",
    "compare_latest",
    "period_table_7",
    "change_since_grid",
    "vacc_change_grid",
    "criteria_14",
    "hub_7day_rolling_thin_lag",
    "snapshot_helper",
    "snapshot_region_vacc",
]


def plan(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", SAMPLE)
def test_no_python_no_pairs_no_single_task(spark, name):
    text = plan(registered()[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|ArrowEval", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # One partition only ever receives the partial results of a global aggregate.
    lines = text.splitlines()
    for above, line in zip(lines, lines[1:]):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[]" in above


def test_a_rolling_chain_shuffles_and_sorts_once(spark, make_panel):
    names = sorted({n for s in ROLLED for n in (s.variable,)} | {"BedsUsed", "BedsICUUsed", "VentilatorsUsed"})
    df = make_panel([("a", 0, *([1] * len(names)))], names)
    wide = with_previous(rolling_summary(df, 7, ROLLED), COMPARED)
    text = plan(wide)
    assert text.count("Exchange hashpartitioning(GeoID") == 1
    assert text.count("Sort [") == 1
    # The newest row needs another order but no other shuffle.
    text = plan(compare_wide(latest_per_key(wide), COMPARED))
    assert text.count("Exchange hashpartitioning(GeoID") == 1
    assert "WindowGroupLimit" in text


def test_both_window_lengths_share_one_window(spark, make_panel):
    df = make_panel([("a", 0, 1)], ["CasesNew"])
    specs = [s for s in ROLLED if s.variable == "CasesNew"]
    seven = rolling_summary(df, 7, specs)
    both = rolling_summary(
        seven.withColumnRenamed("CasesNew7DayTotal", "CasesNew"), 14, specs
    )
    assert plan(both).count("Exchange") == 1


def test_latest_rows_are_limited_before_the_shuffle(make_panel):
    text = plan(latest_per_key(make_panel([("a", 0, 1)], ["x"])))
    exchange = text.index("Exchange hashpartitioning")
    assert "Partial" in text[exchange:] and "Final" in text[:exchange]


def test_key_filter_reaches_the_scan_below_the_windows(spark):
    rolled = registered()["rolling_null_days"](spark, SF_DIR)
    text = plan(rolled.where(f"GeoID = '{PLACES.focus}'"), "formatted")
    assert f"EqualTo(n_name,{PLACES.focus})" in text


def test_scans_read_only_the_columns_used(spark):
    text = plan(registered()["rolling_expr"](spark, SF_DIR), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    orders = [s for s in schemas if "o_orderdate" in s]
    assert orders and all("o_totalprice" not in s and "o_orderkey" not in s for s in orders)


def test_an_anchor_reads_dates_and_keys_only(spark):
    hospital = TpchPanels(spark, SF_DIR).hosp
    text = plan(cut_to_lag(hospital, 10), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "l_suppkey:bigint,l_shipdate:timestamp_ntz" in schemas


def fact_scans(df) -> int:
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(df, "formatted"))
    return sum("l_shipdate" in s for s in schemas)


@pytest.mark.parametrize("name", ["snapshot_helper", "snapshot_region_vacc"])
def test_range_ends_come_from_dates_alone(spark, name):
    text = plan(registered()[name](spark, SF_DIR))
    assert "RangeFrame" not in text and "lag(" not in text


@pytest.mark.parametrize(
    ("name", "most"),
    [("hospital_derive", 1), ("snapshot_helper", 1), ("snapshot_region_vacc", 3), ("hub_7day_rolling_thin_lag", 3), ("lag_cutoff_global", 2)],
)
def test_facts_are_scanned_no_more_than_needed(spark, name, most):
    assert fact_scans(registered()[name](spark, SF_DIR)) <= most


@pytest.mark.parametrize("name", ["snapshot_weekly_comparison", "snapshot_comparison"])
def test_snapshot_comparisons_read_the_facts_once_when_run(spark, name):
    """Anchors are one scalar, so its uses and the two sides share their scans."""
    df = registered()[name](spark, SF_DIR)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"ReadSchema: struct<[^>]*l_shipdate", text)) == 1
    assert len(set(re.findall(r"Subquery subquery#(\d+)", text))) == 1


def test_suppliers_of_a_day_are_counted_without_sums_by_supplier(spark, tmp_path):
    """Marked lines are summed by nation and day alone; repeated and unknown suppliers count as joined."""
    tables = {
        "nation": ([(1, "N1", 7), (2, "N2", 7)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(7, "R")], "r_regionkey int, r_name string"),
        "supplier": ([(10, 1), (11, 1), (12, 2), (12, 2), (None, 2)], "s_suppkey bigint, s_nationkey int"),
        "lineitem": (
            [
                (10, "2021-03-01", 5.0, "R", "F"),
                (10, "2021-03-01", 7.0, "R", None),
                (11, "2021-03-01", None, "A", "O"),
                (11, None, 2.0, "N", "O"),
                (11, None, 3.0, None, "F"),
                (12, "2021-03-01", 4.0, "N", "F"),
                (None, "2021-03-01", 9.0, "R", "F"),
                (99, "2021-03-01", 9.0, "R", "F"),
            ],
            "l_suppkey bigint, l_shipdate string, l_quantity double, l_returnflag string, l_linestatus string",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    hospitals = TpchPanels(spark, str(tmp_path)).hosp
    columns = ["GeoID", "Date", "HospitalsReporting", "HospitalsTotal", "BedsTotal", "BedsUsed", "CovidTotal"]
    columns += ["CovidNew24HConfirmed", "CovidNew24HSuspected", "CovidICUTotal", "VentilatorsUsed", "VentilatorsAvailable"]
    first = dt.date(2021, 3, 1)
    assert rows_of(hospitals, *columns) == [
        ("N1", None, 1, 2, 100, 5, 0, None, None, None, None, 5),
        ("N1", first, 2, 2, 150, 12, 12, 5, None, None, None, 0),
        ("N2", first, 2, 3, 100, 8, 0, None, None, None, 8, 10),
    ]
    text = hospitals._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in text.splitlines() if "Aggregate [supplier#" in line]


@pytest.mark.parametrize(("name", "most"), [("rolling_back_update", 5), ("compare_back_update", 12)])
def test_rebuilds_scan_kept_tables(spark, name, most):
    """A plan that held its inputs' plans wherever it uses them would be too large for a driver."""
    plan = registered()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() <= most
