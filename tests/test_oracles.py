"""Registered queries against DuckDB on the smallest tables.

Operators and one table per recipe kind run as they are registered; all bundle
tables run over bundles with pinned tables.
"""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_points
from checks.harness import connect, differences
from checks.oracles import statements
from checks.queries import (
    BASE_TABLES,
    HUB_TABLES,
    OPERATORS,
    SNAPSHOT_TABLES,
    base,
    hub,
    registered,
    snapshot,
)
from paneltrend.sources import TpchPanels

TABLES = [
    "base_hospital",
    "base_rolling_7",
    "hub_7day_rolling_thin_lag",
    "hub_comparison_6w_lag",
    "hub_testing_thin_lag",
    "hub_bar_charts",
    "hub_period_table",
    "hub_vacc_bar_charts",
    "hub_age_rates",
    "snapshot_7day_rolling_lag_hosp",
    "snapshot_weekly_comparison",
    "snapshot_comparison",
    "snapshot_region_vacc",
]
# The training-data queries have tests of their own.
QUERIES = registered()
ORACLES = statements()
CHOSEN = [*OPERATORS, *TABLES]
BUNDLED = {**BASE_TABLES, **HUB_TABLES, **SNAPSHOT_TABLES}


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def pinned(spark):
    """Every bundle table by its registered name, over one set of pinned tables."""
    panels = TpchPanels(spark, SF_DIR)
    tables, bundles = {}, []
    for build, names in ((base, BASE_TABLES), (hub, HUB_TABLES), (snapshot, SNAPSHOT_TABLES)):
        bundle = build(panels).pin()
        bundles.append(bundle)
        tables |= {name: bundle[table] for name, table in names.items()}
    yield tables
    for bundle in bundles:
        bundle.release()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == {*OPERATORS, *BUNDLED}
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_flagship_query(spark):
    assert entry_points.entry(spark).columns[5:7] == ["CasesNew7DayTotal", "CasesNew7DayAvg"]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == []


@pytest.mark.parametrize("name", BUNDLED)
def test_bundle_table_equals_its_sql(pinned, db, name):
    assert differences(pinned[name], db, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["latest_raw_events", "hub_bar_charts", "period_table_7"])
def test_results_do_not_depend_on_broadcasts(spark, db, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        result = QUERIES[name](spark, SF_DIR)
        assert differences(result, db, ORACLES[name]) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
