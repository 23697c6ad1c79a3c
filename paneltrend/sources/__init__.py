"""Reading landed reports, writing bundles, and panels over sample tables."""

from .export import export_bundle
from .landed import (
    INPUTS,
    Dimensions,
    SplitPanel,
    VersionConflict,
    conform,
    dimension_paths,
    dimension_tables,
    dimension_versions,
    latest_dimensions,
    one_row_per_day,
    read_bundle,
    read_dimensions,
    read_panel,
    refresh_dimensions,
    rejected_rows,
    split_panel,
)
from .stored import PanelStore, open_store, store_panels
from .tpch_panels import TpchPanels

__all__ = [
    "Dimensions",
    "INPUTS",
    "PanelStore",
    "SplitPanel",
    "TpchPanels",
    "VersionConflict",
    "conform",
    "dimension_paths",
    "dimension_tables",
    "dimension_versions",
    "export_bundle",
    "latest_dimensions",
    "one_row_per_day",
    "open_store",
    "read_bundle",
    "read_dimensions",
    "read_panel",
    "refresh_dimensions",
    "rejected_rows",
    "split_panel",
    "store_panels",
]
