"""Configuration that oracles share with the engine, pinned by literal values."""

from __future__ import annotations

import pytest

from paneltrend.plans.base import MERGED_COLUMNS, ROLLED
from paneltrend.plans.hub import (
    COMPARED,
    COMPARED_VACCINATIONS,
    PERIOD_MEASURES,
    ROLLED_TESTS,
    ROLLED_VACCINATIONS,
    case_windows,
)
from paneltrend.plans.snapshot import SLICED, WEEKLY_CASES, WEEKLY_HOSPITAL
from paneltrend.specs import ChangeWindow, KpiBand


def flags(measures):
    """Names for seven days, those where a rise is good with a plus."""
    return " ".join(("+" if m.up_good else "-") + m.name(7) for m in measures)


CASES = (
    "-CasesNew7DayAvg -CasesNew7DayTotal -DeathsNew7DayAvg -DeathsNew7DayTotal +TestsNew7DayAvg +TestsNew7DayTotal"
)
SLICE = f"{CASES} -CovidTotal7DayAvg -CovidNew7DayAvg -CovidNew7DayTotal"


@pytest.mark.parametrize(
    ("measures", "text"),
    [
        (SLICED, SLICE),
        (COMPARED[:9], SLICE),
        (COMPARED[9:11], "-CovidICUTotal7DayAvg -CovidVentilatorsUsed7DayAvg"),
        (WEEKLY_CASES, f"{CASES} -TestsPositive7DayRate -DeathsToCases7DayRate -HospsToCases7DayRate"),
        (
            WEEKLY_HOSPITAL,
            "-CovidTotal7DayAvg -CovidNew7DayAvg -CovidNew7DayTotal +Hospital7DayReportRate",
        ),
    ],
)
def test_compared_measures_and_good_directions(measures, text):
    assert flags(measures) == text


def test_all_vaccination_rises_are_good():
    assert all(m.up_good for m in COMPARED_VACCINATIONS)
    assert [r.names(7) for r in ROLLED_VACCINATIONS] == [
        [f"{v}_New7DayTotal", f"{v}_New7DayAvg"]
        for v in ("DosesAdministered", "RegimenInitiated", "RegimenCompleted")
    ]


def test_rolled_statistics():
    assert [r.variable for r in ROLLED if r.total] == [
        "CasesNew", "DeathsNew", "TestsNew", "CovidNew", "CovidTotal", "BedsUsedOther", "BedsAvailable",
        "HospitalsReporting", "HospitalsTotal",
    ]
    assert all(r.avg for r in ROLLED) and len(ROLLED) == 17 and len(MERGED_COLUMNS) == 31
    assert [(r.variable, r.expr) for r in ROLLED_TESTS] == [
        ("TestsPositiveNew", "CasesNew"),
        ("TestsNew", None),
        ("TestsNegativeNew", None),
    ]


def test_period_measures():
    assert [(m.variable, m.statistic, m.label, m.up_good) for m in PERIOD_MEASURES[:3]] == [
        ("CasesNew", "Total", "Cases", False),
        ("DeathsNew", "Total", "Deaths", False),
        ("TestsNew", "Total", "Tests", True),
    ]


def test_window_labels_and_filters():
    assert [(w.slicer, w.filter_key) for w in (ChangeWindow(7), ChangeWindow(14, 10), ChangeWindow(None))] == [
        ("Last 7 days", "07_00"),
        ("Last 14 days*", "14_10"),
        ("All Time", "9999"),
    ]
    assert case_windows(10)[-1].slicer == "All Time"
    assert (KpiBand().low, KpiBand().high) == (0.95, 1.05)
