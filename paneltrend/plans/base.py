"""The base bundle: inputs, enriched inputs and the rolling summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..bundle import Bundle
from ..operators.derive import age_bands, hospital_measures, reported_sums
from ..operators.merge import merge_panels
from ..operators.rolling import rolling_summary
from ..specs import RollSpec

# Columns of the merged case and hospital panel, in output order.
MERGED_COLUMNS = (
    "Jurisdiction",
    "State",
    "GeoID",
    "Region",
    "Date",
    "CasesNew",
    "CasesTotal",
    "DeathsNew",
    "DeathsTotal",
    "TestsNew",
    "TestsTotal",
    "Population",
    "HospitalsReporting",
    "HospitalsTotal",
    "BedsTotal",
    "BedsUsed",
    "BedsAvailable",
    "BedsICUTotal",
    "BedsICUUsed",
    "BedsICUAvailable",
    "CovidTotal",
    "CovidNew",
    "CovidICUTotal",
    "CovidICUConfirmed",
    "CovidICUSuspected",
    "VentilatorsTotal",
    "VentilatorsUsed",
    "VentilatorsAvailable",
    "CovidVentilatorsUsed",
    "BedsInpatientUsedCovid",
    "BedsInpatientTotal",
)

# Measures of the 7- and 14-day summaries, in output order.
# Residual use is taken from the reported columns here, so it may be negative.
ROLLED = (
    RollSpec("CasesNew"),
    RollSpec("DeathsNew"),
    RollSpec("TestsNew"),
    RollSpec("CovidNew"),
    RollSpec("CovidTotal"),
    RollSpec("BedsUsedOther", expr="BedsUsed - CovidTotal"),
    RollSpec("BedsAvailable"),
    RollSpec("CovidICUTotal", total=False),
    RollSpec("BedsICUUsedOther", total=False, expr="BedsICUUsed - CovidICUTotal"),
    RollSpec("BedsICUAvailable", total=False),
    RollSpec("CovidVentilatorsUsed", total=False),
    RollSpec("VentilatorsUsedOther", total=False, expr="VentilatorsUsed - CovidVentilatorsUsed"),
    RollSpec("VentilatorsAvailable", total=False),
    RollSpec("HospitalsReporting"),
    RollSpec("HospitalsTotal"),
    RollSpec("BedsInpatientUsedCovid", total=False),
    RollSpec("BedsInpatientTotal", total=False),
)


def merge_case_and_hospital(cases: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Full outer merge of the *reported* panels, plus the two summed measures."""
    return reported_sums(merge_panels(cases, hospitals)).select(*MERGED_COLUMNS)


def base_bundle(inputs: Mapping[str, DataFrame]) -> Bundle:
    """Eight tables from the five inputs.

    The merged panel is built from hospital data as reported; the enriched
    hospital table (floored residuals, rebuilt totals) does not feed it.
    """
    recipes = {
        "cdtData": lambda: inputs["cdtData"],
        "cdtNRData": lambda: inputs["cdtNRData"],
        "hospData": lambda: hospital_measures(inputs["hospData"]),
        "vaccData": lambda: inputs["vaccData"],
        "vaccCDCData": lambda: age_bands(inputs["vaccCDCData"]),
        "cdtHospData": lambda: merge_case_and_hospital(inputs["cdtData"], inputs["hospData"]),
        "cdtHosp7DayRollingData": lambda: rolling_summary(bundle["cdtHospData"], 7, ROLLED),
        "cdtHosp14DayRollingData": lambda: rolling_summary(bundle["cdtHospData"], 14, ROLLED),
    }
    bundle = Bundle(
        recipes,
        shared=(
            "cdtData",
            "hospData",
            "vaccCDCData",
            "cdtHospData",
            "cdtHosp7DayRollingData",
            "cdtHosp14DayRollingData",
        ),
    )
    return bundle
