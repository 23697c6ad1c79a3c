"""SQL fragments the oracles are put together from.

Each fragment is a named common table expression; :func:`compose` adds, in
order, the fragments a statement needs.  The SQL states the semantics
literally (long-form lags, union per measure) and shares no logic with the
Spark code beyond configuration.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from paneltrend.plans.base import MERGED_COLUMNS, ROLLED
from paneltrend.plans.hub import (
    CASE_COLUMNS,
    COMPARED,
    COMPARED_VACCINATIONS,
    HOSPITAL_COLUMNS,
    ROLLED_TESTS,
    ROLLED_VACCINATIONS,
    STANDARD_COLUMNS,
)
from paneltrend.specs import IDS

ID_LIST = ", ".join(IDS)
WORD = re.compile(r"\b[a-z_][a-z0-9_]*\b")


# -- builders -------------------------------------------------------------------


def rolling(source: str, days: int, specs: Sequence, ids: str = ID_LIST) -> str:
    columns = []
    for s in specs:
        if s.total:
            columns.append(f'cast(sum({s.expr or s.variable}) over w as bigint) as "{s.total_name(days)}"')
        if s.avg:
            columns.append(f'avg({s.expr or s.variable}) over w as "{s.avg_name(days)}"')
    return (
        f"select {ids}, {', '.join(columns)} from {source} window w as (partition by GeoID "
        f"order by Date range between interval {days - 1} days preceding and current row)"
    )


def kpi(ratio: str, change: str, up: str, low: float = 0.95, high: float = 1.05) -> str:
    down = f"({ratio} <= {low} or ({ratio} is null and {change} < 0))"
    rise = f"({ratio} >= {high} or ({ratio} is null and {change} > 0))"
    return (
        f"case when {down} and not {up} then 1 when {down} and {up} then 2 "
        f"when {ratio} > {low} and {ratio} < {high} then 3 "
        f"when {rise} and {up} then 4 when {rise} and not {up} then 5 end"
    )


def compare(source: str, measures: Sequence, days: int = 7, lag: int | None = None) -> str:
    """Long-form comparison: lag by (number of measures x lag) rows in the key."""
    step = len(measures) * (days if lag is None else lag)
    long = " union all ".join(
        f"select {ID_LIST}, {i} as pos, '{m.name(days)}' as Measure, "
        f'cast("{m.name(days)}" as double) as CurrentWeekValue, {m.up_good} as up from {source}'
        for i, m in enumerate(measures)
    )
    return f"""
        select * exclude (pos, up), {kpi('WeekChangeRatio', 'WeekChange', 'up')} as KPI_ID
        from (
          select *, WeekChangeRatio - 1 as WeekChangeProp from (
            select *, CurrentWeekValue - PreviousWeekValue as WeekChange,
              case when CurrentWeekValue = 0 and PreviousWeekValue = 0 then 1.0::double
                   else CurrentWeekValue / nullif(PreviousWeekValue, 0) end as WeekChangeRatio
            from (
              select *, Date - {days} as DatePrev,
                lag(CurrentWeekValue, {step}) over (partition by GeoID order by Date, pos) as PreviousWeekValue
              from ({long}))))"""


def period(source: str, days: int, lag: int, measures: Sequence, pop: str = "pop") -> str:
    """Period table, stated as picks at ranks 1, d+1 and 2d+1 and a lag over them."""
    cols = ", ".join(f'"{m.column(days)}"' for m in measures)
    low, high = 0.95, 1.05
    picks = f"""
        select *, lag(Date) over k as PreviousDate from (
          select r.* from (
            select {', '.join('s.' + c for c in IDS)}, {cols}, p.Population,
              rank() over (partition by s.GeoID order by s.Date desc) as rk
            from {source} s left join {pop} p using (GeoID)
            where s.Date <= (select max(Date) from {source}) - {lag}) r
          where rk in (1, {days + 1}, {2 * days + 1}))
        window k as (partition by GeoID order by Date)"""
    parts = []
    for m in measures:
        c = f'"{m.column(days)}"'
        per = f"{c} / nullif(Population, 0) * 100000" if m.per_capita else "cast(null as double)"
        parts.append(
            f"""select {ID_LIST}, Population, PreviousDate, rk, '{m.label}' as Measure, {m.up_good} as up,
              {c} as CurrentNew, lag({c}) over k as PreviousNew,
              {per} as CurrentNewPer100K, lag({per}) over k as PreviousNewPer100K
              from ({picks}) window k as (partition by GeoID order by Date)"""
        )
    return f"""
        select Jurisdiction, State, Region, GeoID, Date as CurrentDate, Population, PreviousDate,
          Measure, CurrentNew, PreviousNew, Change, ChangeProp, CurrentNewPer100K,
          PreviousNewPer100K, ChangePer100K, DayPeriod, LagDays, ChangeRatio, KPI_ID,
          case when KPI_ID in (1, 4) then '#06C72F' when KPI_ID in (2, 5) then '#ff3a22'
               when KPI_ID = 3 then '#E1E500' end as KPI_Color
        from (
          select *, {kpi('ChangeRatio', 'Change', 'up', low, high)} as KPI_ID from (
            select *, ChangeProp + 1 as ChangeRatio from (
              select *, CurrentNew - PreviousNew as Change,
                CurrentNewPer100K - PreviousNewPer100K as ChangePer100K,
                {days} as DayPeriod, {lag} as LagDays,
                CurrentNew / case when PreviousNew = 0 then case when CurrentNew = 0 then 1.0::double end
                                  else cast(PreviousNew as double) end - 1 as ChangeProp
              from ({' union all '.join(parts)}) where rk = 1)))"""


def change(
    source: str, totals: Sequence, windows: Sequence, attach_to: str, attachments: Sequence
) -> str:
    """Change-since rows, one union branch per window, measure and kind."""
    columns = [c for _, c in totals]
    labels = [label for label, _ in totals]
    parts = []
    for w in windows:
        if w.days is None:
            rows = (
                f"select {ID_LIST}, Population, {', '.join(f'{c} as new{i}' for i, c in enumerate(columns))} "
                f"from {source} qualify rank() over (partition by GeoID order by Date desc) = 1"
            )
            days = lag = "cast(null as integer)"
        else:
            rows = f"""
              select c.*, {', '.join(f'c.{m} - e.{m} as new{i}' for i, m in enumerate(columns))} from (
                select * from (
                  select *, max(Date) over (partition by GeoID) as mx from (
                    select *, max(Date) over (partition by GeoID) as mx0 from {source})
                  where Date <= mx0 - {w.lag})
                where Date = mx) c
              left join {source} e on e.GeoID = c.GeoID and e.Date = c.Date - {w.days}"""
            days, lag = str(w.days), str(w.lag)
        for kind in w.kinds:
            value = (lambda i: f"cast(new{i} as double)") if kind == "Raw" else (
                lambda i: f"cast(new{i} as double) / nullif(Population, 0) * 100000"
            )
            for i, label in enumerate(labels):
                extra = []
                for a in attachments:
                    v = "cast(null as double)"
                    if label == attach_to:
                        v = value(labels.index(a.plus))
                        if a.minus:
                            v += f" - {value(labels.index(a.minus))}"
                    extra.append(f"{v} as {a.name}")
                parts.append(
                    f"""select {ID_LIST}, Population, {days} as days, {lag} as lagDays,
                      '{label}' as Measure, '{kind}' as Raw_Per100K, {value(i)} as NewValue,
                      {', '.join(extra)}, '{w.slicer}' as SlicerLevels, '{w.filter_key}' as filterLevels
                      from ({rows})"""
                )
    return " union all ".join(parts)


def lag_cut(source: str, lag: int) -> str:
    return f"select * from {source} where Date <= (select max(Date) from {source}) - {lag}"


def latest(source: str, keys: str = "GeoID") -> str:
    return f"select * from {source} qualify rank() over (partition by {keys} order by Date desc) = 1"


def newest_weekday(source: str) -> str:
    return (
        f"select * from {source} where isodow(Date) = "
        f"(select isodow(max(Date)) from {source})"
    )


def trailing(source: str, days: int, lag: int = 0) -> str:
    end = f"(select max(Date) from {source}) - {lag}"
    return f"select * from {source} where Date <= {end} and Date >= {end} - {days}"


def hospital(source: str) -> str:
    """Enriched hospital rows."""
    parts = (
        ("BedsUsed", "CovidTotal", "BedsAvailable", "BedsTotal", "BedsUsedOther"),
        ("BedsICUUsed", "CovidICUTotal", "BedsICUAvailable", "BedsICUTotal", "BedsICUUsedOther"),
        (
            "VentilatorsUsed",
            "CovidVentilatorsUsed",
            "VentilatorsAvailable",
            "VentilatorsTotal",
            "VentilatorsUsedOther",
        ),
    )
    other = ", ".join(
        f"case when {u} - {c} < 0 then 0 else {u} - {c} end as {o}" for u, c, _, _, o in parts
    )
    totals = ", ".join(f"{a} + {o} + {c} as {t}" for _, c, a, t, o in parts)
    shares = ", ".join(
        f"{p} / nullif({t}, 0) as {p}Proportion" for _, c, a, t, o in parts for p in (a, o, c)
    )
    return f"""
        select * replace (max(HospitalsReporting) over (partition by GeoID order by Date
            range between interval 10 days preceding and interval 10 days following) as HospitalsTotal),
          {shares}, BedsInpatientUsedCovid / nullif(BedsInpatientTotal, 0) as BedsInpatientUsedCovidProportion
        from (
          select * replace ({totals}) from (
            select *, CovidNew24HConfirmed + CovidNew24HSuspected as CovidNew,
              CovidConfirmedAdult + CovidConfirmedPediatric as BedsInpatientUsedCovid, {other}
            from {source}))"""


def bands(source: str) -> str:
    """Age bands, written out per band."""
    out = []
    for band, lo, hi, neither in (
        ("5to11", "GTE5", "GTE12", "Neither_Initiated_Nor_Completed"),
        ("12to17", "GTE12", "GTE18", "Neither_Initiated_Nor_Completed"),
        ("18to65", "GTE18", "GTE65", "Unvaccinated"),
    ):
        done = f"(RegimenCompleted_Total{lo} - RegimenCompleted_Total{hi})"
        begun = f"(RegimenInitiated_Total{lo} - RegimenInitiated_Total{hi})"
        people = f"(Population{lo} - Population{hi})"
        named = [
            (f"RegimenCompleted_Total{band}", done),
            (f"NotFullyVaccinated_{band}", f"({people} - {done})"),
            (f"RegimenInitiated_Total{band}", begun),
            (f"Initiated_NotCompleted_Total{band}", f"({begun} - {done})"),
            (f"{neither}_Total{band}", f"({people} - {begun})"),
        ]
        if band != "5to11":
            named.append((f"Boosted_Total{band}", f"(Boosted_Total{lo} - Boosted_Total{hi})"))
        out.append(f"{people} as Population_{band}")
        for name, text in named:
            out += [f"{text} as {name}", f"{text} / nullif({people}, 0) as {name}Prop"]
    for name, text in (
        ("Initiated_NotCompleted_TotalGTE65", "(PopulationGTE65 - RegimenCompleted_TotalGTE65)"),
        ("Unvaccinated_TotalGTE65", "(PopulationGTE65 - RegimenInitiated_TotalGTE65)"),
        ("NotFullyVaccinated_GTE65", "(PopulationGTE65 - RegimenCompleted_TotalGTE65)"),
    ):
        out += [f"{text} as {name}", f"{text} / nullif(PopulationGTE65, 0) as {name}Prop"]
    out.append("Boosted_TotalGTE65 / nullif(PopulationGTE65, 0) as Boosted_TotalGTE65Prop")
    return f"select *, {', '.join(out)} from {source}"


def rates(source: str) -> str:
    columns = [
        f"{r}_Total{g}"
        for g in ("", "GTE18", "GTE65", "12to17", "18to65")
        for r in ("RegimenCompleted", "RegimenInitiated")
    ]
    listed = ", ".join(f"{c} - lag({c}) over k as {c}_Rate" for c in columns)
    return (
        f"select Jurisdiction, GeoID, Region, State, Date, {listed} from {source} "
        "window k as (partition by GeoID order by Date)"
    )


def targets(source: str, kept: Sequence[str]) -> str:
    return f"""
        select {', '.join(kept)} from (
          select *,
            case when TestsPositiveNew7DayAvgProportion < PositiveTestStandardProportion then 1
                 when TestsPositiveNew7DayAvgProportion > PositiveTestStandardProportion then 3
                 else 2 end as KPI_PositiveTests,
            case when TestsNew7DayAvg < PopulationTestStandard then 3
                 when TestsNew7DayAvg > PopulationTestStandard then 1 else 2 end as KPI_PopulationTests
          from (
            select s.*, p.Population,
              cast(ceil(p.Population / 100000) as bigint) * 150 as PopulationTestStandard,
              case when p.GeoID is not null then 0.05::double end as PositiveTestStandardProportion,
              case when p.GeoID is not null then 5 end as PositiveTestStandard,
              CasesNew7DayTotal / nullif(TestsNew7DayTotal, 0) as TestsPositiveNew7DayAvgProportion,
              DeathsNew7DayTotal / nullif(CasesNew7DayTotal, 0) as DeathsToCases7DayProportion,
              CovidNew7DayTotal / nullif(CasesNew7DayTotal, 0) as HospsToCases7DayProportion,
              BedsInpatientUsedCovid7DayAvg / nullif(BedsInpatientTotal7DayAvg, 0)
                as BedsInpatientUsedCovid7DayAvgProportion
            from {source} s left join pop p on p.GeoID = s.GeoID))"""


def criteria(source: str, as_of: str, lag: int = 7) -> str:
    def weighted(column: str) -> str:
        return (
            "cast(round_even(cast(HospitalsTotal14DayTotal as double) * "
            f"cast({column} as double) / nullif(cast(HospitalsReporting14DayTotal as double), 0) / 14, 0) as bigint)"
        )

    return f"""
        select {ID_LIST}, CasesNew14DayTotal, CasesNew14DayTotalPer100K, TestsPositivity14DayProportion,
          a / nullif(a + c + o, 0) as BedsAvailable14WAvg_Prop,
          c / nullif(a + c + o, 0) as BedsUsedCovid14WAvg_Prop,
          o / nullif(a + c + o, 0) as BedsUsedOther14WAvg_Prop
        from (
          select s.*, CasesNew14DayTotal / nullif(p.Population, 0) * 100000 as CasesNew14DayTotalPer100K,
            CasesNew14DayTotal / nullif(TestsNew14DayTotal, 0) as TestsPositivity14DayProportion,
            {weighted('BedsAvailable14DayTotal')} as a, {weighted('CovidTotal14DayTotal')} as c,
            {weighted('BedsUsedOther14DayTotal')} as o
          from {source} s left join pop p on p.GeoID = s.GeoID
          where isodow(s.Date) = 1
            and s.Date <= date '{as_of}' - (isodow(date '{as_of}')::integer - 1) - {lag})"""


def running(source: str, columns: Sequence[str], first: str) -> str:
    listed = ", ".join(f"cast(sum({c}) over k as bigint) as {c}" for c in columns)
    return (
        f"select {first}, {listed} from {source} window k as "
        "(partition by GeoID order by Date rows unbounded preceding)"
    )


# -- fragments ------------------------------------------------------------------

_HOSP = """
    count(*) * 50 as BedsTotal, sum(q) as BedsUsed, count(*) * 25 as BedsAvailable,
    count(*) * 20 as BedsICUTotal, sum(q) filter (where a and f) as BedsICUUsed,
    count(*) filter (where a) * 10 as BedsICUAvailable, count(*) * 40 as BedsInpatientTotal,
    coalesce(sum(q) filter (where r), 0) as CovidTotal,
    sum(q) filter (where r and f) as CovidNew24HConfirmed,
    sum(q) filter (where r and not f) as CovidNew24HSuspected,
    sum(q) filter (where a and not f) as CovidICUTotal,
    count(*) filter (where r and f) as CovidICUConfirmed,
    count(*) filter (where r and not f) as CovidICUSuspected,
    count(*) filter (where r) as CovidConfirmedAdult,
    count(*) filter (where n and f) as CovidConfirmedPediatric,
    count(*) * 9 as VentilatorsTotal, sum(q) filter (where n and f) as VentilatorsUsed,
    count(*) filter (where n) * 5 as VentilatorsAvailable,
    sum(q) filter (where n and not f) as CovidVentilatorsUsed"""
_HOSP_NAMES = re.findall(r"as (\w+)", _HOSP)

_AGES = {"": 0, "GTE5": 5, "GTE12": 12, "GTE18": 18, "GTE65": 40}
_AGE_COUNTS = {
    **{f"RegimenCompleted_Total{a}": f"count(*) filter (where f and r and q >= {n})" for a, n in _AGES.items()},
    **{f"RegimenInitiated_Total{a}": f"count(*) filter (where f and q >= {n})" for a, n in _AGES.items()},
    **{
        f"Boosted_Total{a}": f"count(*) filter (where r and not f and q >= {n})"
        for a, n in _AGES.items()
        if n > 5
    },
}
_AGE_PEOPLE = {
    f"Population{a}": f"count(*) filter (where q >= {n})" for a, n in _AGES.items() if n
}


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} as {name}" for name, text in columns.items())


FRAGMENTS: dict[str, str] = {
    "nations": """
        select n_nationkey as nation, n_name as Jurisdiction, 'S' || n_regionkey as State,
          r_name as Region, n_name as GeoID
        from nation join region on n_regionkey = r_regionkey""",
    "juris": """
        select n.* exclude (nation), c.Population from nations n left join (
          select c_nationkey as nation, count(*) * 1000 as Population from customer group by 1) c
        using (nation)""",
    "pop": "select GeoID, Population from juris",
    "key_sets": """
        select 'base' as set_name, GeoID from nations where Region <> 'MIDDLE EAST'
        union all select 'rollup', GeoID from nations where nation < 4""",
    "pretty": """
        select case when nation % 2 = 0 then 'A' else 'B' end as Site, GeoID,
          'Nation ' || nation as NiceName, nation as DisplayOrder, Region as NiceUpperLevel,
          case when nation % 2 = 0 then 'Not Reported' end as ICUBedsDisclaimer,
          cast(null as varchar) as SourceLocation
        from nations""",
    "ordered": """
        select n.*, cast(o_orderdate as date) as Date, o_orderstatus as status, o_orderpriority as priority
        from orders join customer on o_custkey = c_custkey join nations n on n.nation = c_nationkey""",
    "shipped": """
        select n.*, cast(l_shipdate as date) as Date, l_quantity as q, l_linestatus = 'F' as f,
          l_returnflag = 'R' as r
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        join nations n on n.nation = c_nationkey""",
    "cdt": f"""
        select d.*, p.Population from (
          select {ID_LIST}, CasesNew, cast(sum(CasesNew) over k as bigint) as CasesTotal,
            DeathsNew, cast(sum(DeathsNew) over k as bigint) as DeathsTotal,
            TestsNew, cast(sum(TestsNew) over k as bigint) as TestsTotal
          from (
            select {ID_LIST}, count(*) filter (where status = 'F') as CasesNew,
              count(*) filter (where priority = '1-URGENT') as DeathsNew, count(*) as TestsNew
            from ordered group by all)
          window k as (partition by GeoID order by Date rows unbounded preceding)) d
        left join pop p using (GeoID)""",
    "cdt_nr": f"""
        select {ID_LIST}, count(*) as TestsNew, count(*) filter (where priority = '1-URGENT') as DeathsNew,
          count(*) filter (where priority = '2-HIGH') as CasesNew
        from ordered where status = 'P' group by all""",
    "hosp": f"""
        select {ID_LIST}, HospitalsReporting, HospitalsTotal,
          {', '.join(f'cast({c} as bigint) as {c}' for c in _HOSP_NAMES)}
        from (
          select nation, Date, count(distinct l_suppkey) as HospitalsReporting, {_HOSP}
          from (
            select s_nationkey as nation, cast(l_shipdate as date) as Date, l_suppkey,
              cast(l_quantity as bigint) as q, l_returnflag = 'A' as a, l_returnflag = 'N' as n,
              l_returnflag = 'R' as r, l_linestatus = 'F' as f
            from lineitem join supplier on l_suppkey = s_suppkey)
          group by all)
        join (select s_nationkey as nation, count(*) as HospitalsTotal from supplier group by 1) using (nation)
        join nations using (nation)""",
    "vacc": f"""
        select v.*, p.Population from (
          {running(
              f'''(select {ID_LIST}, count(*) as DosesAdministered_Total,
                  count(*) filter (where f) as RegimenInitiated_Count,
                  count(*) filter (where f and r) as RegimenCompleted_Count
                from shipped group by all)''',
              ("DosesAdministered_Total", "RegimenInitiated_Count", "RegimenCompleted_Count"),
              ID_LIST)}) v
        left join pop p using (GeoID)""",
    "vacc_cdc": f"""
        select * from (
          {running(f'(select {ID_LIST}, {_listed(_AGE_COUNTS)} from shipped group by all)',
                   tuple(_AGE_COUNTS), ID_LIST)})
        join (select GeoID, {_listed(_AGE_PEOPLE)} from shipped group by GeoID) using (GeoID)""",
    "base_keys": "select GeoID from key_sets where set_name = 'base'",
    "base_cdt": "select * from cdt where GeoID in (select GeoID from base_keys)",
    "base_nr": "select * from cdt_nr where GeoID in (select GeoID from base_keys)",
    "base_hosp": "select * from hosp where GeoID in (select GeoID from base_keys)",
    "base_hospital": hospital("base_hosp"),
    "base_vacc_cdc": bands("vacc_cdc"),
}


def _merge(cases: str, hospitals: str) -> str:
    shared = ("Jurisdiction", "State", "Region")
    ids = ", ".join(f"coalesce(a.{c}, b.{c}) as {c}" for c in shared)
    return f"""
        select {ids}, GeoID, Date, a.* exclude (Jurisdiction, State, Region, GeoID, Date),
          b.* exclude (Jurisdiction, State, Region, GeoID, Date)
        from {cases} a full join {hospitals} b using (GeoID, Date)"""


def _case_hospital(source: str) -> str:
    return f"""
        select {', '.join(MERGED_COLUMNS)} from (
          select *, CovidNew24HConfirmed + CovidNew24HSuspected as CovidNew,
            CovidConfirmedAdult + CovidConfirmedPediatric as BedsInpatientUsedCovid
          from {source})"""


_KPIS = ("KPI_PopulationTests", "KPI_PositiveTests")
_TESTS = (
    f"select *, TestsPositiveNew7DayTotal / nullif(TestsNew7DayTotal, 0) as TestsPositivity from ("
    f"{rolling('(select *, TestsNew - CasesNew as TestsNegativeNew from base_cdt)', 7, ROLLED_TESTS)})"
)

FRAGMENTS |= {
    "merged": _merge("cdt", "hosp"),
    "panel": _case_hospital("merged"),
    "base_merged": _merge("base_cdt", "base_hosp"),
    "cdt_hosp": _case_hospital("base_merged"),
    "roll_seven": rolling("cdt_hosp", 7, ROLLED),
    "roll_fourteen": rolling("cdt_hosp", 14, ROLLED),
    "panel_seven": rolling("panel", 7, ROLLED),
    "panel_fourteen": rolling("panel", 14, ROLLED),
    "region_dense": f"""
        select *, cast(sum(CasesNew) over k as bigint) as CasesTotal,
          cast(sum(DeathsNew) over k as bigint) as DeathsTotal,
          cast(sum(TestsNew) over k as bigint) as TestsTotal
        from (
          select r.Region as Jurisdiction, cast(null as varchar) as State, r.Region, r.Region as GeoID,
            cast(day as date) as Date, r.Population, coalesce(CasesNew, 0) as CasesNew,
            coalesce(DeathsNew, 0) as DeathsNew, coalesce(TestsNew, 0) as TestsNew
          from (select Region, cast(sum(Population) as bigint) as Population from juris group by 1) r
          cross join (
            select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)),
              interval 1 day)) as day from orders)
          left join (
            select Region, Date, cast(sum(CasesNew) as bigint) as CasesNew,
              cast(sum(DeathsNew) as bigint) as DeathsNew, cast(sum(TestsNew) as bigint) as TestsNew
            from cdt group by all) d on d.Region = r.Region and d.Date = cast(day as date))
        window k as (partition by GeoID order by Date rows unbounded preceding)""",
    "clicks": """
        select event_type as GeoID, cast(ts as date) as Date, event_id,
          cast(json_extract(props, '$.k') as bigint) as Clicks
        from events""",
    "rated": targets(
        "roll_seven",
        (*IDS, *CASE_COLUMNS, *_KPIS, *STANDARD_COLUMNS, *HOSPITAL_COLUMNS),
    ),
    "rated_cases": lag_cut(
        f"(select {', '.join((*IDS, *CASE_COLUMNS, *STANDARD_COLUMNS, *_KPIS))} from rated)", 10
    ),
    "rated_hospital": lag_cut(f"(select {', '.join((*IDS, *HOSPITAL_COLUMNS))} from rated)", 2),
    "compared": compare("roll_seven", COMPARED),
    "tests": lag_cut(f"({_TESTS})", 10),
    "vacc_daily": """
        select * exclude (RegimenInitiated_Count, RegimenCompleted_Count),
          RegimenInitiated_Count as RegimenInitiated_Total, RegimenCompleted_Count as RegimenCompleted_Total,
          DosesAdministered_Total - lag(DosesAdministered_Total) over k as DosesAdministered_New,
          RegimenInitiated_Count - lag(RegimenInitiated_Count) over k as RegimenInitiated_New,
          RegimenCompleted_Count - lag(RegimenCompleted_Count) over k as RegimenCompleted_New,
          RegimenInitiated_Count / nullif(Population, 0) as RegimenInitiated_PropPop,
          RegimenCompleted_Count / nullif(Population, 0) as RegimenCompleted_PropPop
        from vacc window k as (partition by GeoID order by Date)""",
    "vacc_seven": rolling("vacc_daily", 7, ROLLED_VACCINATIONS),
    "vacc_compared": compare("vacc_seven", COMPARED_VACCINATIONS),
}


def compose(final: str) -> str:
    """``final`` with every fragment it needs, directly or not, in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in WORD.findall(text):
            if word in FRAGMENTS and word not in needed:
                visit(FRAGMENTS[word])
                if word not in needed:
                    needed.append(word)

    visit(final)
    if not needed:
        return final
    parts = ", ".join(f"{name} as materialized ({FRAGMENTS[name]})" for name in needed)
    return f"with {parts} {final}"
