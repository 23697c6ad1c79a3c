"""The SQL each registered query is checked against."""

from __future__ import annotations

from paneltrend.plans.hub import (
    CASE_CHANGES,
    COMPARED,
    PERIOD_MEASURES,
    ROLLED_TESTS,
    VACCINATION_CHANGES,
    VACCINATION_WINDOWS,
)
from paneltrend.plans.snapshot import SLICED, WEEKLY_CASES, WEEKLY_HOSPITAL
from paneltrend.specs import ChangeWindow

from . import sql as s
from .queries import (
    AS_OF,
    CASE_GRID,
    CLICKS,
    DENSE,
    DENSE_COMPARED,
    MIXED_GRID,
    PLACES,
    SERIES,
    SPARSE,
)

IDS = s.ID_LIST
KEYS = ", ".join(f"'{k}'" for k in SERIES)
HEADLINE = ", ".join(f"'{k}'" for k in PLACES.headline)
(FOCUS_TOTAL,) = PLACES.hospital_totals.values()

CASES = (CASE_CHANGES.totals, CASE_CHANGES.attach_to, CASE_CHANGES.attachments)
DOSES = (VACCINATION_CHANGES.totals, VACCINATION_CHANGES.attach_to, VACCINATION_CHANGES.attachments)
ALL_TIME = ChangeWindow(None)


def changes(source: str, spec: tuple, windows) -> str:
    totals, attach_to, attachments = spec
    return s.change(source, totals, windows, attach_to, attachments)


def up_to_weekday(source: str, weekday: int, lag: int = 0) -> str:
    return (
        f"select * from {source} where Date <= "
        f"(select max(Date) filter (where isodow(Date) = {weekday}) from {source}) - {lag}"
    )


def weekly_points(lag: int) -> str:
    # Sunday less the lag, as an ISO weekday.
    day = (7 - lag) % 7 or 7
    return (
        f"select * from ({s.lag_cut('roll_seven', lag)}) "
        f"where isodow(Date) = {day} and GeoID in ({KEYS})"
    )


WEEKLY = f"""
    select {IDS}, CasesNew7DayTotal, CasesNew7DayAvg, DeathsNew7DayTotal, DeathsNew7DayAvg,
      TestsNew7DayTotal, TestsNew7DayAvg,
      CasesNew7DayTotal / nullif(TestsNew7DayTotal, 0) as TestsPositive7DayRate,
      DeathsNew7DayTotal / nullif(CasesNew7DayTotal, 0) as DeathsToCases7DayRate,
      CovidNew7DayTotal / nullif(CasesNew7DayTotal, 0) as HospsToCases7DayRate
    from ({weekly_points(10)})"""
WEEKLY_HOSP = f"""
    select {IDS}, CovidNew7DayTotal, CovidNew7DayAvg, CovidTotal7DayAvg,
      HospitalsReporting7DayTotal / nullif(
        case when GeoID = '{PLACES.focus}' then {FOCUS_TOTAL} else HospitalsTotal7DayTotal end, 0)
        as Hospital7DayReportRate
    from ({weekly_points(2)})"""


def last_weeks(points: str, measures) -> str:
    compared = s.compare(f"({points})", measures, 7, 1)
    return (
        f"select * from ({s.trailing(f'({compared})', 42)}) where GeoID in ({HEADLINE})"
    )


def sliced() -> str:
    parts = []
    for days, source in ((7, "roll_seven"), (14, "roll_fourteen")):
        for hospital, lag in ((False, 10), (True, 2)):
            measures = [m for m in SLICED if m.template.startswith("Covid") == hospital]
            compared = s.compare(f"({up_to_weekday(source, 7)})", measures, days)
            newest = s.latest(f"({s.lag_cut(f'({compared})', lag)})", "GeoID, Measure")
            parts.append(
                f"""select {IDS}, Measure, CurrentWeekValue as CurrentValue, DatePrev,
                  PreviousWeekValue as PreviousValue, WeekChange as Change,
                  WeekChangeRatio as ChangeRatio, WeekChangeProp as ChangeProp, KPI_ID,
                  {days} as Days, {lag} as Lag
                  from ({newest}) where GeoID = '{PLACES.focus}'"""
            )
    return " union all ".join(parts)


RANGE_ENDS = f"""
    select min(Date) filter (where Measure not like 'Covid%') as c,
      min(Date) filter (where Measure like 'Covid%') as h
    from ({sliced()})"""
NONE = "cast(null as date)"

PLACES_SQL = "select Jurisdiction, Region, State, GeoID from juris"
UPSTREAM_SQL = (
    "select Jurisdiction, case when GeoID like '%3' then lower(Region) else Region end as Region, "
    "State, GeoID from juris"
)

BAR_LABEL = (
    "select * replace ('Total ' || Measure || case when Raw_Per100K = 'Per100K' "
    "then ' Per 100K' else '' end as Raw_Per100K) from "
)

OPERATORS = {
    "rolling_7": "select * from panel_seven",
    "rolling_14": "select * from panel_fourteen",
    "rolling_expr": s.rolling(
        "(select *, TestsNew - CasesNew as TestsNegativeNew from cdt)", 7, ROLLED_TESTS
    ),
    "rolling_null_days": s.rolling("hosp", 7, SPARSE),
    "rolling_explode": "select * from panel_seven",
    "rolling_raw_events": s.rolling("clicks", 7, CLICKS, "GeoID, Date, event_id"),
    "centred_max": """
        select * replace (max(HospitalsReporting) over (partition by GeoID order by Date range between
          interval 10 days preceding and interval 10 days following) as HospitalsTotal) from hosp""",
    "lag_cutoff_global": s.lag_cut("panel", 10),
    "lag_cutoff_key": """
        select p.* from panel p join (select GeoID, max(Date) - 10 as cut from panel group by 1)
        using (GeoID) where Date <= cut""",
    "trailing_6w": s.trailing("panel", 42),
    "trailing_6w_lag": s.trailing("panel", 42, 10),
    "thin_latest_weekday": s.newest_weekday(f"({s.lag_cut('panel', 10)})"),
    "thin_cutoff_weekday": "select * from panel where isodow(Date) = 4",
    "last_weekday_cut": up_to_weekday("panel", 7, 2),
    "monday_cutoff": f"""
        select * from panel where isodow(Date) = 1
          and Date <= cast(date_trunc('week', date '{AS_OF}') as date) - 7""",
    "two_date_pick": f"""
        select * from vacc where GeoID in ({KEYS}) and (
          Date = (select max(Date) filter (where isodow(Date) = 7) from cdt) - 10
          or Date = (select max(Date) from vacc))""",
    "anchor_pair": """
        select d.* from region_dense d join (
          select GeoID, max(Date) as mx from (
            select GeoID, Date, max(Date) over (partition by GeoID) as newest from region_dense)
          where Date <= newest - 10 group by 1) using (GeoID)
        where Date = mx or Date = mx - 14""",
    "lag_cutoff_raw_events": """
        select c.* from clicks c join (select GeoID, max(Date) - 2 as cut from clicks group by 1)
        using (GeoID) where Date <= cut""",
    "anchor_pair_raw_events": """
        select c.* from clicks c join (
          select GeoID, max(Date) as mx from (
            select GeoID, Date, max(Date) over (partition by GeoID) as newest from clicks)
          where Date <= newest - 2 group by 1) using (GeoID)
        where Date = mx or Date = mx - 7""",
    "latest_raw_events": s.latest("clicks"),
    "latest_per_key": s.latest("panel"),
    "latest_per_measure": s.latest(f"({s.compare('panel_seven', COMPARED)})", "GeoID, Measure"),
    "hospital_derive": s.hospital("hosp"),
    "age_bands": s.bands("vacc_cdc"),
    "first_difference": "select * from vacc_daily",
    "cdc_rates": s.rates("base_vacc_cdc"),
    "guarded_ratio_kpi": s.targets(
        "panel_seven",
        (
            IDS,
            "TestsPositiveNew7DayAvgProportion",
            "DeathsToCases7DayProportion",
            "HospsToCases7DayProportion",
            "PopulationTestStandard",
            "KPI_PositiveTests",
            "KPI_PopulationTests",
        ),
    ),
    "key_override": f"""
        select * replace (cast(case when GeoID = '{PLACES.focus}' then {FOCUS_TOTAL}
          else HospitalsTotal end as bigint) as HospitalsTotal) from hosp""",
    "full_merge": "select * from merged",
    "dim_lookup": "select h.*, p.Population from hosp h left join pop p using (GeoID)",
    "dim_drift": f"""
        select *, 1::bigint as n_current, 0::bigint as n_upstream
          from ({PLACES_SQL} except {UPSTREAM_SQL})
        union all select *, 0::bigint, 1::bigint from ({UPSTREAM_SQL} except {PLACES_SQL})""",
    "dim_drift_verdict": f"""
        select n_current, n_distinct, n_current <> n_distinct as drifted
        from (select count(*) as n_current from juris),
          (select count(*) as n_distinct from ({PLACES_SQL} union {UPSTREAM_SQL}))""",
    "bridge_table": """
        select t.* exclude (Site), p.Population from pretty t left join pop p using (GeoID)
        where Site = 'A'""",
    "key_set_semi": """
        select * from hosp where GeoID in (select GeoID from key_sets where set_name = 'rollup')""",
    "repeated_keys": """
        select GeoID, Date, count(*) as rows from clicks group by 1, 2 having count(*) > 1""",
    "dense_panel": "select * from region_dense",
    "compare_7": s.compare("panel_seven", COMPARED),
    "compare_14": s.compare("panel_fourteen", SLICED, 14),
    "compare_weekly_lag1": s.compare(
        "(select * from panel_seven where isodow(Date) = 7)", COMPARED, 7, 1
    ),
    "compare_latest": s.latest(
        f"({s.lag_cut(f'({s.compare('panel_seven', COMPARED)})', 10)})", "GeoID, Measure"
    ),
    "compare_dense": s.compare(f"({s.rolling('region_dense', 7, DENSE)})", DENSE_COMPARED),
    "period_table_7": s.period("panel_seven", 7, 10, PERIOD_MEASURES),
    "period_table_14": s.period("panel_fourteen", 14, 100, PERIOD_MEASURES),
    "change_since_grid": changes("region_dense", CASES, CASE_GRID),
    "change_all_time": changes("cdt", CASES, (ALL_TIME,)),
    "change_mixed_grid": changes("cdt", CASES, MIXED_GRID),
    "vacc_change_grid": changes("vacc_daily", DOSES, VACCINATION_WINDOWS),
    "criteria_14": s.criteria("panel_fourteen", str(AS_OF)),
    "refresh_places": PLACES_SQL,
    "refresh_population": "select * from pop",
    "dim_drift_report": f"""
        select *, bool_or(drifted) over () as any_drifted
        from (select *, n_current <> n_distinct as drifted
              from (select 'juris' as dimension, (select count(*) from juris) as n_current,
                      (select count(*) from ({PLACES_SQL} union {UPSTREAM_SQL})) as n_distinct
                    union all
                    select 'pop', count(*), (select count(*) from (select distinct * from pop)) from pop
                    union all
                    select 'key_sets', count(*), (select count(*) from (select distinct * from key_sets))
                    from key_sets
                    union all
                    select 'pretty', count(*),
                      (select count(*) from (select * from pretty
                       union select * replace (upper(NiceName) as NiceName) from pretty)) from pretty))""",
    "landed_instants": """
        select event_id, event_type as GeoID, ts::date as Date, epoch(stamp)::bigint as instant,
          strftime(stamp at time zone 'UTC' at time zone 'America/Chicago', '%Y-%m-%d %H:%M:%S') as local
        from (select *, case when event_id % 7 = 0 then ts::date::timestamp
                             else date_trunc('second', ts) end as stamp from events)
        where event_id % 11 <> 0""",
}
OPERATORS["centred_max_explode"] = OPERATORS["centred_max"]

# the same results by other means
OPERATORS |= {
    "rolling_blocks": OPERATORS["rolling_7"],
    "rolling_raw_events_blocks": OPERATORS["rolling_raw_events"],
    "rolling_back_update": OPERATORS["rolling_7"],
    "centred_max_blocks": OPERATORS["centred_max"],
    "first_difference_blocks": OPERATORS["first_difference"],
    "compare_7_blocks": OPERATORS["compare_7"],
    "compare_back_update": OPERATORS["compare_7"],
    "dim_drift_located": OPERATORS["dim_drift"],
    "period_table_7_days": OPERATORS["period_table_7"],
    "change_since_index": OPERATORS["change_since_grid"],
    "change_mixed_index": OPERATORS["change_mixed_grid"],
    "stored_merge": OPERATORS["full_merge"],
    "stored_rolling_7": OPERATORS["rolling_7"],
    "stored_trailing_6w": OPERATORS["trailing_6w"],
    "stored_trailing_6w_lag": OPERATORS["trailing_6w_lag"],
    "stored_last_weekday_cut": up_to_weekday("hosp", 7, 2),
    "stored_weekday": "select * from cdt where isodow(Date) = 4",
}

BASE = {
    "base_cases": "select * from base_cdt",
    "base_newly_reported": "select * from base_nr",
    "base_hospital": "select * from base_hospital",
    "base_vaccinations": "select * from vacc",
    "base_age_bands": "select * from base_vacc_cdc",
    "base_merged": "select * from cdt_hosp",
    "base_rolling_7": "select * from roll_seven",
    "base_rolling_14": "select * from roll_fourteen",
}

HUB = {
    "hub_cases": "select * from base_cdt",
    "hub_newly_reported": s.latest("base_nr"),
    "hub_hospital_daily": "select * from base_hospital",
    "hub_hospital_latest": s.latest("base_hospital"),
    "hub_7day_rolling": "select * from rated",
    "hub_7day_rolling_lag": "select * from rated_cases",
    "hub_7day_rolling_lag_hosp": "select * from rated_hospital",
    "hub_7day_rolling_thin_lag": s.newest_weekday("rated_cases"),
    "hub_7day_rolling_thin_lag_hosp": s.newest_weekday("rated_hospital"),
    "hub_comparison_latest": s.latest("compared", "GeoID, Measure"),
    "hub_comparison_latest_lag": s.latest(f"({s.lag_cut('compared', 10)})", "GeoID, Measure"),
    "hub_comparison_latest_hosp_lag": s.latest(f"({s.lag_cut('compared', 2)})", "GeoID, Measure"),
    "hub_comparison_6w": s.trailing("compared", 42),
    "hub_comparison_6w_lag": s.trailing("compared", 42, 10),
    "hub_comparison_6w_hosp_lag": s.trailing("compared", 42, 2),
    "hub_comparison_all": "select * from compared",
    "hub_comparison_all_lag": s.lag_cut("compared", 10),
    "hub_comparison_all_hosp_lag": s.lag_cut("compared", 2),
    "hub_testing_lag": "select * from tests",
    "hub_testing_thin_lag": s.newest_weekday("tests"),
    "hub_bar_charts": f"{BAR_LABEL} ({changes('cdt_hosp', CASES, CASE_GRID)})",
    "hub_period_table": (
        f"select * from ({s.period('roll_seven', 7, 10, PERIOD_MEASURES)}) union all "
        f"select * from ({s.period('roll_fourteen', 14, 10, PERIOD_MEASURES)})"
    ),
    "hub_vacc_daily": "select * from vacc_daily",
    "hub_vacc_7day_rolling": "select * from vacc_seven",
    "hub_vacc_comparison": "select * from vacc_compared",
    "hub_vacc_bar_charts": f"""
        select * replace (case when Raw_Per100K = 'Raw' then 'Total' else 'Total Per 100K' end as Raw_Per100K),
          RegimenInitiated / case when Raw_Per100K = 'Raw' then nullif(Population, 0) else 100000 end
            as RegimenInitiated_PropPop,
          RegimenCompleted / case when Raw_Per100K = 'Raw' then nullif(Population, 0) else 100000 end
            as RegimenCompleted_PropPop
        from ({changes('vacc_daily', DOSES, VACCINATION_WINDOWS)}) where Measure = 'DosesAdministered'""",
    "hub_age_bands": "select * from base_vacc_cdc",
    "hub_age_rates": s.rates("base_vacc_cdc"),
    "hub_criteria": s.criteria("roll_fourteen", str(AS_OF)),
    "hub_bridge_a": OPERATORS["bridge_table"],
    "hub_bridge_b": OPERATORS["bridge_table"].replace("'A'", "'B'"),
}

SNAPSHOT = {
    "snapshot_7day_rolling_lag": WEEKLY,
    "snapshot_last_7_days": f"select * from ({s.latest(f'({WEEKLY})')}) where GeoID in ({HEADLINE})",
    "snapshot_7day_rolling_lag_hosp": WEEKLY_HOSP,
    "snapshot_weekly_comparison": (
        f"{last_weeks(WEEKLY, WEEKLY_CASES)} union all {last_weeks(WEEKLY_HOSP, WEEKLY_HOSPITAL)}"
    ),
    "snapshot_comparison": sliced(),
    "snapshot_helper": f"""
        select 'CurrentDate' as ID_Name, date '{AS_OF}' as Date1, {NONE} as Date2
        union all select 'ReportCutoffDate', c + 10, {NONE} from ({RANGE_ENDS})
        union all select 'CDTRange', c - 6, c from ({RANGE_ENDS})
        union all select 'HospRange', h - 6, h from ({RANGE_ENDS})""",
    "snapshot_hospital_daily": up_to_weekday("base_hospital", 7, 2),
    "snapshot_region_vacc": f"""
        select * from vacc where GeoID in ({KEYS}) and (
          Date = (select c + 10 from ({RANGE_ENDS})) or Date = (select max(Date) from vacc))""",
}


def statements() -> dict[str, str]:
    return {
        name: s.compose(text)
        for part in (OPERATORS, BASE, HUB, SNAPSHOT)
        for name, text in part.items()
    }
