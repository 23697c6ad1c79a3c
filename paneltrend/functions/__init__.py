"""Column-level helpers: everything here returns a Spark ``Column``."""

from .calendar import (
    WEEKDAYS,
    iso_weekday,
    latest_monday,
    local_time,
    shifted_weekday,
    utc_instant,
    weekday_number,
)
from .expressions import derive
from .kpi import change_kpi, kpi_color, target_kpi
from .ratios import floor_at_zero, guarded_ratio, per_100k, weighted_whole_average

__all__ = [
    "WEEKDAYS",
    "change_kpi",
    "derive",
    "floor_at_zero",
    "guarded_ratio",
    "iso_weekday",
    "kpi_color",
    "latest_monday",
    "local_time",
    "per_100k",
    "shifted_weekday",
    "target_kpi",
    "utc_instant",
    "weekday_number",
    "weighted_whole_average",
]
