"""Named sets of tables built from the operators."""

from .base import base_bundle
from ..bundle import Bundle
from .hub import hub_bundle
from .snapshot import SnapshotPlaces, snapshot_bundle

__all__ = ["Bundle", "SnapshotPlaces", "base_bundle", "hub_bundle", "snapshot_bundle"]
