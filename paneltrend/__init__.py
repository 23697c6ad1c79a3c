"""paneltrend: entity-by-day panel analytics as Spark DataFrame operators."""

from .plans import Bundle, SnapshotPlaces, base_bundle, hub_bundle, snapshot_bundle
from .sources import (
    Dimensions,
    export_bundle,
    read_bundle,
    read_dimensions,
    read_panel,
    refresh_dimensions,
)
from .specs import (
    Attachment,
    ChangeSpec,
    ChangeWindow,
    KpiBand,
    MeasureSpec,
    PeriodMeasureSpec,
    RollSpec,
)

__all__ = [
    "Attachment",
    "Bundle",
    "ChangeSpec",
    "ChangeWindow",
    "Dimensions",
    "KpiBand",
    "MeasureSpec",
    "PeriodMeasureSpec",
    "RollSpec",
    "SnapshotPlaces",
    "base_bundle",
    "export_bundle",
    "hub_bundle",
    "read_bundle",
    "read_dimensions",
    "read_panel",
    "refresh_dimensions",
    "snapshot_bundle",
]
