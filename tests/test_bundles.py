from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_DIR, rows_of

from paneltrend import Bundle, base_bundle, export_bundle, hub_bundle, snapshot_bundle
from paneltrend.bundle import use_checkpoint_folder
from paneltrend.sources import TpchPanels
from checks.queries import BASE_TABLES, HUB_TABLES, PLACES, SITES, SNAPSHOT_TABLES

AS_OF = dt.date(2001, 6, 15)


@pytest.fixture(scope="module")
def panels(spark):
    return TpchPanels(spark, SF_DIR)


@pytest.fixture
def base(panels):
    return base_bundle(panels.inputs)


@pytest.fixture
def hub(panels, base):
    return hub_bundle(base, panels.dimensions, SITES, as_of=AS_OF)


@pytest.fixture(scope="module")
def checkpoint_folder(spark, tmp_path_factory):
    """The session's own folder, or one for this run where none is set."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return use_checkpoint_folder(spark)


def test_every_table_is_there_and_registered(base, hub):
    snapshot = snapshot_bundle(base, PLACES, as_of=AS_OF)
    assert (len(base), len(hub), len(snapshot)) == (8, 32, 8)
    assert set(BASE_TABLES.values()) == set(base)
    # The helper table holds only the run's own time stamp, so it has no query.
    assert set(HUB_TABLES.values()) == set(hub) - {"HelperTable"}
    assert set(SNAPSHOT_TABLES.values()) == set(snapshot)


def test_helper_table_is_one_time_stamp(hub):
    (row,) = hub["HelperTable"].collect()
    assert row["HelperID"] == "LastExport" and row["DateTime"] is not None


def test_tables_are_built_once(base):
    assert base["cdtHospData"] is base["cdtHospData"]
    with pytest.raises(KeyError):
        base["nothing"]


def test_union_of_bundles_rejects_repeated_names(base, hub):
    both = base.renamed("bi_base_") | hub
    assert len(both) == 40 and "bi_base_cdtData" in both
    with pytest.raises(ValueError, match="cdtData"):
        base | base


@pytest.mark.parametrize("how", ["persist", "checkpoint"])
def test_pinned_tables_give_the_same_rows(panels, base, checkpoint_folder, how):
    loose = hub_bundle(base, panels.dimensions, SITES)["7DayComparison_MostRecent"]
    pinned_base = base_bundle(panels.inputs).pin(how=how)
    pinned = hub_bundle(pinned_base, panels.dimensions, SITES)["7DayComparison_MostRecent"]
    try:
        assert rows_of(pinned, *pinned.columns) == rows_of(loose, *loose.columns)
    finally:
        pinned_base.release()


def test_pinning_knows_two_ways(base):
    with pytest.raises(ValueError):
        base.pin("cdtData", how="hope")


def test_snapshot_cutoff_day_must_be_a_weekday(base):
    with pytest.raises(ValueError):
        snapshot_bundle(base, PLACES, cutoff_day="Someday")


@pytest.mark.parametrize("day", ["Tuesday", "Saturday"])
def test_snapshot_follows_the_cutoff_day(base, day):
    tables = snapshot_bundle(base, PLACES, cutoff_day=day, as_of=AS_OF)
    number = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"].index(day)
    got = {d.weekday() for (d,) in rows_of(tables["WDS_7DayRollingLag"], "Date")}
    assert got == {(number - 10) % 7}
    helper = {r["ID_Name"]: r for r in tables["WDS_HelperTable"].collect()}
    assert helper["CurrentDate"]["Date1"] == AS_OF
    cases = helper["CDTRange"]
    assert helper["ReportCutoffDate"]["Date1"] == cases["Date2"] + dt.timedelta(days=10)
    assert cases["Date2"] - cases["Date1"] == dt.timedelta(days=6)


def test_export_of_a_bundle(spark, hub, tmp_path):
    tables = Bundle({n: (lambda n=n: hub[n]) for n in ("COPTable", "PrettyJurisdictions_A")})
    written = export_bundle(tables, str(tmp_path))
    assert written == [f"{tmp_path}/COPTable", f"{tmp_path}/PrettyJurisdictions_A"]
    back = spark.read.csv(f"{tmp_path}/COPTable", header=True)
    assert back.columns == hub["COPTable"].columns
    assert back.count() == hub["COPTable"].count()
