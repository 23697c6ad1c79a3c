"""Schemas of the landed inputs.

Reports arrive as text formats, so dates and instants are declared as strings
and conformed by :mod:`.landed`; parquet inputs already carry them typed.
"""

from __future__ import annotations

# Column names of the five daily inputs and four dimensions.
CASE_MEASURES = (
    "CasesNew",
    "CasesTotal",
    "DeathsNew",
    "DeathsTotal",
    "TestsNew",
    "TestsTotal",
    "Population",
)
HOSPITAL_MEASURES = (
    "HospitalsReporting",
    "HospitalsTotal",
    "BedsTotal",
    "BedsUsed",
    "BedsAvailable",
    "BedsICUTotal",
    "BedsICUUsed",
    "BedsICUAvailable",
    "BedsInpatientTotal",
    "CovidTotal",
    "CovidNew24HConfirmed",
    "CovidNew24HSuspected",
    "CovidICUTotal",
    "CovidICUConfirmed",
    "CovidICUSuspected",
    "CovidConfirmedAdult",
    "CovidConfirmedPediatric",
    "VentilatorsTotal",
    "VentilatorsUsed",
    "VentilatorsAvailable",
    "CovidVentilatorsUsed",
)
VACCINATION_MEASURES = (
    "Population",
    "DosesAdministered_Total",
    "RegimenInitiated_Count",
    "RegimenCompleted_Count",
)
AGE_MEASURES = (
    *(
        f"Regimen{step}_Total{age}"
        for step in ("Completed", "Initiated")
        for age in ("", "GTE5", "GTE12", "GTE18", "GTE65")
    ),
    *(f"Boosted_Total{age}" for age in ("GTE12", "GTE18", "GTE65")),
    *(f"Population{age}" for age in ("GTE5", "GTE12", "GTE18", "GTE65")),
)


def _panel(measures: tuple[str, ...], updated: bool) -> str:
    ids = ["Jurisdiction string", "State string", "Region string", "GeoID string", "Date string"]
    stamp = ["LastUpdated string"] if updated else []
    return ", ".join([*ids, *(f"{m} bigint" for m in measures), *stamp])


PANELS = {
    "CDT": _panel(CASE_MEASURES, True),
    "CDT_NewlyReported": _panel(CASE_MEASURES, True),
    "Hospital": _panel(HOSPITAL_MEASURES, False),
    "Vaccination": _panel(VACCINATION_MEASURES, True),
    "VaccinationCDC": _panel(AGE_MEASURES, True),
}

DIMENSIONS = {
    "juris": "Jurisdiction string, Region string, State string, GeoID string",
    "pop": "GeoID string, Population int",
    "key_sets": "set_name string, GeoID string",
    "pretty": (
        "Site string, GeoID string, NiceName string, DisplayOrder int, "
        "NiceUpperLevel string, ICUBedsDisclaimer string, SourceLocation string"
    ),
}
