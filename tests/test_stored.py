"""Panels stored by month and bucket: days from the manifest, pruned files, no shuffles."""

from __future__ import annotations

import random

import pytest
from conftest import day, rows_of

from paneltrend.operators import (
    cut_to_lag,
    cut_to_weekday,
    merge_panels,
    rolling_summary,
    thin_to_newest_weekday,
    thin_to_weekday,
    trailing_period,
    with_previous,
)
from paneltrend.sources import open_store, store_panels
from paneltrend.specs import MeasureSpec, RollSpec


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def panels(spark):
    rng = random.Random(1)
    schema = "Jurisdiction string, State string, Region string, GeoID string, Date date, Population bigint, "

    def rows(share):
        found = [
            (f"J{k}", "S", "R", k, day(d), rng.choice([None, 10]), rng.randrange(50))
            for k in ("a", "b", "c", "d", "e")
            for d in range(200)
            if rng.random() < share
        ]
        return [*found, ("Jz", "S", "R", None, day(1), 1, 1), ("Ja", "S", "R", "a", None, 1, 1)]

    left = spark.createDataFrame(rows(0.8), schema + "x bigint")
    right = spark.createDataFrame(rows(0.6), schema + "y bigint")
    return {"cases": left.cache(), "beds": right.cache()}


@pytest.fixture(scope="module")
def store(spark, panels, tmp_path_factory):
    return store_panels(spark, panels, "stored_test", str(tmp_path_factory.mktemp("store") / "s"), buckets=4)


def same(got, want):
    columns = want.columns
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got, *columns) == rows_of(want, *columns)


def test_cutoffs_equal_those_of_the_whole_panel(store, panels):
    cases = panels["cases"].where("GeoID is not null and Date is not null")
    assert store.newest("cases") == cases.agg({"Date": "max"}).first()[0]
    same(store.frame("cases"), cases)
    same(store.cut_to_lag("cases", 10), cut_to_lag(cases, 10))
    same(store.trailing_period("cases", 42), trailing_period(cases, 42))
    same(store.trailing_period("cases", 42, 10), trailing_period(cases, 42, 10))
    same(store.thin_to_newest_weekday("cases"), thin_to_newest_weekday(cases))
    same(store.thin_to_weekday("cases", 7, 10), thin_to_weekday(cases, 7, 10))
    same(store.cut_to_weekday("cases", 7, 2), cut_to_weekday(cases, 7, 2))


def test_a_trailing_period_opens_its_months_only(store, panels):
    from pyspark.sql import functions as F

    df = store.trailing_period("cases", 42)
    read = {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    months = {f.split("month=")[1][:6] for f in read}
    assert len(months) == 2 or len(months) == 3
    every = store.files("cases", store.days("cases")[0], store.days("cases")[-1])
    assert len({f.split("month=")[1][:6] for f in every}) == 7
    ends = store.days("cases")[-1]
    assert read == set(store.files("cases", ends - (day(42) - day(0)), ends))
    assert "PartitionFilters: [isnotnull(month" in plan_of(df)


def test_merge_roll_and_lag_without_a_shuffle(spark, store, panels):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = store.merged("cases", "beds")
        rolled = rolling_summary(merged, 7, (RollSpec("x"), RollSpec("y", total=False)))
        wide = with_previous(rolled, (MeasureSpec("x##DayTotal", True),), 7)
        assert "Exchange" not in plan_of(wide) and "Window" in plan_of(wide)
        whole = merge_panels(*(df.where("GeoID is not null and Date is not null") for df in panels.values()))
        same(merged, whole)
        same(wide, with_previous(rolling_summary(whole, 7, (RollSpec("x"), RollSpec("y", total=False))), (MeasureSpec("x##DayTotal", True),), 7))
        part = store.merged("cases", "beds", day(20), day(40))
        same(part, whole.where(f"Date between '{day(20)}' and '{day(40)}'"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_another_session_opens_a_store(spark, store):
    for table in ("cases", "beds", "spine"):
        spark.sql(f"drop table stored_test_{table}")
    again = open_store(spark, "stored_test", store.path)
    assert again.days("beds") == store.days("beds")
    assert again.frame("cases").count() == store.manifest.where("panel = 'cases'").agg({"rows": "sum"}).first()[0]


def test_empty_panels_and_reserved_names(spark, panels, tmp_path):
    nothing = {"cases": panels["cases"].limit(0), "beds": panels["beds"].limit(0)}
    store = store_panels(spark, nothing, "stored_empty", str(tmp_path / "s"))
    assert store.days() == [] and store.newest("cases") is None
    assert store.trailing_period("cases", 42).count() == 0 and store.cut_to_weekday("cases", 7).count() == 0
    assert store.merged("cases", "beds").count() == 0
    with pytest.raises(ValueError, match="own table"):
        store_panels(spark, {"spine": panels["cases"]}, "x", str(tmp_path / "t"))
