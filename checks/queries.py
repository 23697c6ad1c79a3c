"""Every registered query: a callable of a session and a table folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend import operators as ops
from paneltrend.plans import SnapshotPlaces, base_bundle, hub_bundle, snapshot_bundle
from paneltrend.plans.base import MERGED_COLUMNS, ROLLED, merge_case_and_hospital
from paneltrend.plans.hub import (
    CASE_CHANGES,
    COMPARED,
    PERIOD_MEASURES,
    ROLLED_TESTS,
    VACCINATION_CHANGES,
)
from paneltrend.plans.snapshot import SLICED
from paneltrend.functions import local_time
from paneltrend.sources import PanelStore, TpchPanels, conform, dimension_tables, store_panels
from paneltrend.specs import IDS, ChangeWindow, MeasureSpec, RollSpec

AS_OF = dt.date(2001, 6, 15)
SITES = ("A", "B")
SERIES = ("NATION_0", "NATION_1", "NATION_2", "NATION_3")
PLACES = SnapshotPlaces(SERIES, ("NATION_0", "NATION_1"), "NATION_0", {"NATION_0": 27 * 7})
WEEKDAY = 7  # Sunday, the default cutoff

SPARSE = (
    RollSpec("CovidNew24HConfirmed"),
    RollSpec("CovidICUTotal", total=False),
    RollSpec("CovidVentilatorsUsed", avg=False),
)
CLICKS = (RollSpec("Clicks"), RollSpec("Doubled", expr="Clicks * 2", total=False))
DENSE = (RollSpec("CasesNew"), RollSpec("TestsNew"))
DENSE_COMPARED = (
    MeasureSpec("CasesNew##DayTotal", up_good=False),
    MeasureSpec("TestsNew##DayAvg", up_good=True),
)
CASE_GRID = (*(ChangeWindow(d, 10) for d in (7, 14, 30, 60, 90)), ChangeWindow(None))
MIXED_GRID = (ChangeWindow(7, 0, "Per100K"), ChangeWindow(14, 10, "Raw"), ChangeWindow(100, 2))

Query = Callable[[TpchPanels], DataFrame]


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one; a temporary one in a session within one process that has none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='checks-')}/{uuid.uuid4().hex}"


STORES: dict[tuple[str, str], PanelStore] = {}


def panel_store(p: TpchPanels) -> PanelStore:
    """Case and hospital panels, stored by month and bucket once a session and table folder."""
    spark = p.cdt.sparkSession
    at = spark.sparkContext.applicationId, p.folder
    if at not in STORES:
        panels = {"cdt": p.cdt, "hosp": p.hosp}
        STORES[at] = store_panels(spark, panels, f"panels_{uuid.uuid4().hex}", scratch(spark), buckets=2)
    return STORES[at]


def stored_panel(store: PanelStore, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return ops.reported_sums(store.merged("cdt", "hosp", first, last)).select(*MERGED_COLUMNS)


def stored_trailing(p: TpchPanels, days: int, lag: int) -> DataFrame:
    store = panel_store(p)
    end = store.newest() - dt.timedelta(lag)
    return stored_panel(store, end - dt.timedelta(days), end)


def earlier_state(df: DataFrame) -> DataFrame:
    """A panel before a back-update: some reports lack, some have other values, some are there that are withdrawn."""
    told = F.pmod(F.xxhash64("GeoID", "Date"), F.lit(41))
    other = df.withColumn("CasesNew", F.when(told == 1, F.col("CasesNew") + 3).otherwise(F.col("CasesNew")))
    withdrawn = df.where(told == 2).withColumn("Date", F.date_add("Date", 4000))
    return other.where(told != 0).unionByName(withdrawn)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written and read again: each use of it is a scan, not a copy of its plan."""
    at = scratch(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def roll_after_update(p: TpchPanels) -> tuple[DataFrame, ops.Rebuilt]:
    """The summary of the state before, and what the back-update makes of it; inputs are kept tables."""
    now = kept(panel(p))
    was = kept(earlier_state(now))
    rolled = kept(ops.rolling_summary(was, 7, ROLLED))
    return rolled, ops.roll_again(rolled, now, kept(ops.changed_days(was, now)), 7, ROLLED)


def comparison_after_update(p: TpchPanels) -> DataFrame:
    before, rolled = roll_after_update(p)
    wide = ops.with_previous(before, COMPARED)
    again = ops.compare_again(wide, kept(rolled.table), rolled.touched, COMPARED)
    return ops.compare_wide(again.table, COMPARED)


def panel(p: TpchPanels) -> DataFrame:
    """Merged case and hospital panel over all nations."""
    return merge_case_and_hospital(p.cdt, p.hosp)


def panel_roll(p: TpchPanels, days: int) -> DataFrame:
    return ops.rolling_summary(panel(p), days, ROLLED)


def weekly_points(p: TpchPanels) -> DataFrame:
    return ops.thin_to_weekday(panel_roll(p, 7), WEEKDAY)


def upstream_places(p: TpchPanels) -> DataFrame:
    """The place table with the region of some places respelled."""
    changed = F.col("GeoID").endswith("3")
    places = p.jurisdictions.select("Jurisdiction", "Region", "State", "GeoID")
    return places.withColumn(
        "Region", F.when(changed, F.lower("Region")).otherwise(F.col("Region"))
    )


def landed_instants(p: TpchPanels) -> DataFrame:
    """Event times as landed text, some of them dates alone, conformed and shown in a zone."""
    stamp = F.when(F.col("event_id") % 7 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    )
    landed = p.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("GeoID"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("Date"),
        stamp.alias("LastUpdated"),
    )
    return conform(landed).select(
        "event_id",
        "GeoID",
        "Date",
        F.unix_timestamp("LastUpdated").alias("instant"),
        F.date_format(local_time(F.col("LastUpdated")), "yyyy-MM-dd HH:mm:ss").alias("local"),
    )


OPERATORS: Mapping[str, Query] = {
    # rolling summaries
    "rolling_7": lambda p: panel_roll(p, 7),
    "rolling_14": lambda p: panel_roll(p, 14),
    "rolling_expr": lambda p: ops.rolling_summary(
        ops.positive_and_negative_tests(p.cdt), 7, ROLLED_TESTS
    ),
    "rolling_null_days": lambda p: ops.rolling_summary(p.hosp, 7, SPARSE),
    "rolling_explode": lambda p: ops.rolling_summary(panel(p), 7, ROLLED, strategy="explode"),
    "rolling_raw_events": lambda p: ops.rolling_summary(
        p.events, 7, CLICKS, ids=("GeoID", "Date", "event_id"), strategy="explode"
    ),
    "rolling_blocks": lambda p: ops.rolling_summary(panel(p), 7, ROLLED, strategy="blocks"),
    "rolling_raw_events_blocks": lambda p: ops.rolling_summary(
        p.events, 7, CLICKS, ids=("GeoID", "Date", "event_id"), strategy="blocks"
    ),
    "rolling_back_update": lambda p: roll_after_update(p)[1].table,
    "centred_max_blocks": lambda p: ops.rolling_max(
        p.hosp, "HospitalsReporting", "HospitalsTotal", strategy="blocks"
    ),
    "centred_max": lambda p: ops.rolling_max(p.hosp, "HospitalsReporting", "HospitalsTotal"),
    "centred_max_explode": lambda p: ops.rolling_max(
        p.hosp, "HospitalsReporting", "HospitalsTotal", strategy="explode"
    ),
    # cutoffs
    "lag_cutoff_global": lambda p: ops.cut_to_lag(panel(p), 10),
    "lag_cutoff_key": lambda p: ops.cut_to_lag_by_key(panel(p), 10),
    "trailing_6w": lambda p: ops.trailing_period(panel(p), 42),
    "trailing_6w_lag": lambda p: ops.trailing_period(panel(p), 42, 10),
    "thin_latest_weekday": lambda p: ops.thin_to_newest_weekday(ops.cut_to_lag(panel(p), 10)),
    "thin_cutoff_weekday": lambda p: ops.thin_to_weekday(panel(p), WEEKDAY, 10),
    "last_weekday_cut": lambda p: ops.cut_to_weekday(panel(p), WEEKDAY, 2),
    "monday_cutoff": lambda p: ops.mondays_as_of(panel(p), 7, AS_OF),
    "two_date_pick": lambda p: ops.on_date_or_newest(
        p.vacc, F.date_sub(ops.newest_date_on(p.cdt, WEEKDAY), 10), SERIES
    ),
    "anchor_pair": lambda p: ops.anchor_pair(p.region_dense, 14, 10),
    "lag_cutoff_raw_events": lambda p: ops.cut_to_lag_by_key(p.events, 2, strategy="join"),
    "anchor_pair_raw_events": lambda p: ops.anchor_pair(p.events, 7, 2, strategy="join"),
    "latest_raw_events": lambda p: ops.latest_per_key(p.events, strategy="join"),
    "latest_per_key": lambda p: ops.latest_per_key(panel(p)),
    "latest_per_measure": lambda p: ops.latest_per_key(
        ops.compare_periods(panel_roll(p, 7), COMPARED), ("GeoID", "Measure")
    ),
    # stored panels
    "stored_merge": lambda p: panel_store(p).merged("cdt", "hosp"),
    "stored_rolling_7": lambda p: ops.rolling_summary(stored_panel(panel_store(p)), 7, ROLLED),
    "stored_trailing_6w": lambda p: stored_trailing(p, 42, 0),
    "stored_trailing_6w_lag": lambda p: stored_trailing(p, 42, 10),
    "stored_last_weekday_cut": lambda p: panel_store(p).cut_to_weekday("hosp", WEEKDAY, 2),
    "stored_weekday": lambda p: panel_store(p).thin_to_weekday("cdt", WEEKDAY, 10),
    # derived measures
    "hospital_derive": lambda p: ops.hospital_measures(p.hosp),
    "age_bands": lambda p: ops.age_bands(p.vacc_cdc),
    "first_difference_blocks": lambda p: ops.daily_vaccinations(p.vacc, strategy="blocks"),
    "first_difference": lambda p: ops.daily_vaccinations(p.vacc),
    "cdc_rates": lambda p: ops.vaccination_rates(ops.age_bands(p.vacc_cdc)),
    "guarded_ratio_kpi": lambda p: ops.against_testing_targets(panel_roll(p, 7), p.population).select(
        *IDS,
        "TestsPositiveNew7DayAvgProportion",
        "DeathsToCases7DayProportion",
        "HospsToCases7DayProportion",
        "PopulationTestStandard",
        "KPI_PositiveTests",
        "KPI_PopulationTests",
    ),
    "key_override": lambda p: ops.override_by_key(
        p.hosp, "HospitalsTotal", PLACES.hospital_totals
    ),
    # merges and dimensions
    "full_merge": lambda p: p.merged,
    "dim_lookup": lambda p: ops.lookup(p.hosp, p.population),
    "dim_drift": lambda p: ops.dimension_drift(
        p.jurisdictions.select("Jurisdiction", "Region", "State", "GeoID"), upstream_places(p)
    ),
    "dim_drift_located": lambda p: ops.located_drift(
        p.jurisdictions.select("Jurisdiction", "Region", "State", "GeoID"), upstream_places(p)
    ),
    "dim_drift_verdict": lambda p: ops.drift_counts(
        p.jurisdictions.select("Jurisdiction", "Region", "State", "GeoID"), upstream_places(p)
    ),
    "bridge_table": lambda p: ops.site_bridge(p.pretty, p.population, "A"),
    "key_set_semi": lambda p: ops.in_key_set(p.hosp, p.key_sets, "rollup"),
    "repeated_keys": lambda p: ops.repeated_keys(p.events),
    "dense_panel": lambda p: p.region_dense,
    # comparisons
    "compare_7": lambda p: ops.compare_periods(panel_roll(p, 7), COMPARED),
    "compare_14": lambda p: ops.compare_periods(panel_roll(p, 14), SLICED, 14),
    "compare_weekly_lag1": lambda p: ops.compare_periods(
        weekly_points(p), COMPARED, 7, lag=1
    ),
    "compare_7_blocks": lambda p: ops.compare_periods(panel_roll(p, 7), COMPARED, strategy="blocks"),
    "compare_back_update": comparison_after_update,
    "compare_latest": lambda p: ops.compare_wide(
        ops.latest_per_key(ops.cut_to_lag(ops.with_previous(panel_roll(p, 7), COMPARED), 10)),
        COMPARED,
    ),
    "compare_dense": lambda p: ops.compare_periods(
        ops.rolling_summary(p.region_dense, 7, DENSE), DENSE_COMPARED
    ),
    "period_table_7": lambda p: ops.period_table(
        panel_roll(p, 7), 7, 10, PERIOD_MEASURES, p.population
    ),
    "period_table_7_days": lambda p: ops.period_table(
        panel_roll(p, 7), 7, 10, PERIOD_MEASURES, p.population, strategy="days"
    ),
    "period_table_14": lambda p: ops.period_table(
        panel_roll(p, 14), 14, 100, PERIOD_MEASURES, p.population
    ),
    # change since
    "change_since_grid": lambda p: ops.change_since(p.region_dense, CASE_CHANGES, CASE_GRID),
    "change_since_index": lambda p: ops.change_since(
        p.region_dense, CASE_CHANGES, CASE_GRID, strategy="index"
    ),
    "change_mixed_index": lambda p: ops.change_since(
        p.cdt, CASE_CHANGES, MIXED_GRID, strategy="index"
    ),
    "change_all_time": lambda p: ops.change_since(p.cdt, CASE_CHANGES, (ChangeWindow(None),)),
    "change_mixed_grid": lambda p: ops.change_since(p.cdt, CASE_CHANGES, MIXED_GRID),
    "vacc_change_grid": lambda p: ops.change_since(
        ops.daily_vaccinations(p.vacc),
        VACCINATION_CHANGES,
        (ChangeWindow(7), ChangeWindow(14), ChangeWindow(None)),
    ),
    "criteria_14": lambda p: ops.criteria_summary(panel_roll(p, 14), p.population, as_of=AS_OF),
    # refreshed dimension tables
    "refresh_places": lambda p: dimension_tables(p.jurisdictions)["juris"],
    "refresh_population": lambda p: dimension_tables(p.jurisdictions)["pop"],
    "dim_drift_report": lambda p: ops.drift_report(
        {
            "juris": (dimension_tables(p.jurisdictions)["juris"], upstream_places(p)),
            "pop": (p.population, p.population.withColumn("Population", F.col("Population") + F.lit(0))),
            "key_sets": (p.key_sets, p.key_sets.where("set_name <> 'rollup'")),
            "pretty": (p.pretty, p.pretty.withColumn("NiceName", F.upper("NiceName"))),
        }
    ),
    # landed reports
    "landed_instants": landed_instants,
}

# Registered name of each bundle table.
BASE_TABLES = {
    "base_cases": "cdtData",
    "base_newly_reported": "cdtNRData",
    "base_hospital": "hospData",
    "base_vaccinations": "vaccData",
    "base_age_bands": "vaccCDCData",
    "base_merged": "cdtHospData",
    "base_rolling_7": "cdtHosp7DayRollingData",
    "base_rolling_14": "cdtHosp14DayRollingData",
}
HUB_TABLES = {
    "hub_cases": "CDT_TimeSeries",
    "hub_newly_reported": "CDT_NewlyReported",
    "hub_hospital_daily": "HospitalDailyData",
    "hub_hospital_latest": "HospitalMostRecent",
    "hub_7day_rolling": "7DayRolling",
    "hub_7day_rolling_lag": "7DayRollingLag",
    "hub_7day_rolling_lag_hosp": "7DayRollingLagHosp",
    "hub_7day_rolling_thin_lag": "7DayRollingThinLag",
    "hub_7day_rolling_thin_lag_hosp": "7DayRollingThinLagHosp",
    "hub_comparison_latest": "7DayComparison_MostRecent",
    "hub_comparison_latest_lag": "7DayComparison_MostRecent_Lag",
    "hub_comparison_latest_hosp_lag": "7DayComparison_MostRecent_HospLag",
    "hub_comparison_6w": "7DayComparison_Last6Weeks",
    "hub_comparison_6w_lag": "7DayComparison_Last6Weeks_Lag",
    "hub_comparison_6w_hosp_lag": "7DayComparison_Last6Weeks_HospLag",
    "hub_comparison_all": "7DayComparison_AllTime",
    "hub_comparison_all_lag": "7DayComparison_AllTime_Lag",
    "hub_comparison_all_hosp_lag": "7DayComparison_AllTime_HospLag",
    "hub_testing_lag": "TestingPage7DayRollingLag",
    "hub_testing_thin_lag": "TestingPage7DayRollingThinLag",
    "hub_bar_charts": "JurisdictionBarCharts",
    "hub_period_table": "COPTable",
    "hub_vacc_daily": "vacc_DailyData",
    "hub_vacc_7day_rolling": "vacc_7DayRollingData",
    "hub_vacc_comparison": "vacc_baseWeeklyComparisonData",
    "hub_vacc_bar_charts": "vacc_JurisdictionBarCharts",
    "hub_age_bands": "vacc_DailyData_CDC",
    "hub_age_rates": "vacc_DailyDataRate_CDC",
    "hub_criteria": "SGC_14DaySummary",
    "hub_bridge_a": "PrettyJurisdictions_A",
    "hub_bridge_b": "PrettyJurisdictions_B",
}
SNAPSHOT_TABLES = {
    "snapshot_7day_rolling_lag": "WDS_7DayRollingLag",
    "snapshot_last_7_days": "WDS_Last7Days",
    "snapshot_7day_rolling_lag_hosp": "WDS_7DayRollingLagHosp",
    "snapshot_weekly_comparison": "WDS_WeeklyComparison",
    "snapshot_comparison": "WDS_ComparisonTable",
    "snapshot_helper": "WDS_HelperTable",
    "snapshot_hospital_daily": "WDS_HospitalDailyData",
    "snapshot_region_vacc": "WDS_RegionVacc",
}


def base(p: TpchPanels) -> Mapping[str, DataFrame]:
    return base_bundle(p.inputs)


def hub(p: TpchPanels) -> Mapping[str, DataFrame]:
    return hub_bundle(base(p), p.dimensions, SITES, as_of=AS_OF)


def snapshot(p: TpchPanels) -> Mapping[str, DataFrame]:
    return snapshot_bundle(base(p), PLACES, as_of=AS_OF)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on_folder(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(TpchPanels(spark, folder))

    queries = dict(OPERATORS)
    for bundle, tables in ((base, BASE_TABLES), (hub, HUB_TABLES), (snapshot, SNAPSHOT_TABLES)):
        for name, table in tables.items():
            queries[name] = lambda p, bundle=bundle, table=table: bundle(p)[table]
    return {name: on_folder(query) for name, query in queries.items()}
