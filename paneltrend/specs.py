"""Typed configuration for the panel operators.

A spec says *which* measures an operator works on and what the generated
columns are called.  Specs are expanded on the driver, before any plan is
built; they never travel as data.
"""

from __future__ import annotations

from dataclasses import dataclass

# Identity of a panel row; every operator carries these through.
IDS = ("Jurisdiction", "State", "Region", "GeoID", "Date")
KEY = "GeoID"
DATE = "Date"


@dataclass(frozen=True)
class RollSpec:
    """One measure of a rolling summary.

    ``expr`` is Spark SQL text; when given, ``variable`` is computed from it
    before the roll.
    """

    variable: str
    avg: bool = True
    total: bool = True
    expr: str | None = None

    def __post_init__(self) -> None:
        if not (self.avg or self.total):
            raise ValueError(f"{self.variable}: ask for a total, an average or both")

    def total_name(self, days: int) -> str:
        return f"{self.variable}{days}DayTotal"

    def avg_name(self, days: int) -> str:
        return f"{self.variable}{days}DayAvg"

    def names(self, days: int) -> list[str]:
        wanted = []
        if self.total:
            wanted.append(self.total_name(days))
        if self.avg:
            wanted.append(self.avg_name(days))
        return wanted


@dataclass(frozen=True)
class MeasureSpec:
    """A compared measure; ``##`` in ``template`` stands for the day count."""

    template: str
    up_good: bool

    def name(self, days: int) -> str:
        return self.template.replace("##", str(days), 1)


@dataclass(frozen=True)
class PeriodMeasureSpec:
    """A measure of the period table (current against previous period)."""

    variable: str
    statistic: str
    label: str
    up_good: bool
    per_capita: bool = True

    def __post_init__(self) -> None:
        if self.statistic not in ("Total", "Avg"):
            raise ValueError(f"{self.variable}: statistic must be Total or Avg")

    def column(self, days: int) -> str:
        return f"{self.variable}{days}Day{self.statistic}"


@dataclass(frozen=True)
class ChangeWindow:
    """One entry of a change-since grid.  ``days=None`` asks for all time."""

    days: int | None
    lag: int | None = 0
    keep: str = "Both"

    def __post_init__(self) -> None:
        if self.keep not in ("Both", "Raw", "Per100K"):
            raise ValueError("keep must be one of 'Both', 'Raw' or 'Per100K'")
        if self.days is not None and self.lag is None:
            raise ValueError("a dated window needs a lag")

    @property
    def slicer(self) -> str:
        if self.days is None:
            return "All Time"
        return f"Last {self.days} days" + ("*" if self.lag else "")

    @property
    def filter_key(self) -> str:
        if self.days is None:
            return "9999"
        return f"{self.days:02d}_{self.lag:02d}"

    @property
    def kinds(self) -> tuple[str, ...]:
        return ("Raw", "Per100K") if self.keep == "Both" else (self.keep,)


@dataclass(frozen=True)
class Attachment:
    """A value of other measures put on the row of ``ChangeSpec.attach_to``."""

    name: str
    plus: str
    minus: str | None = None


@dataclass(frozen=True)
class ChangeSpec:
    """Running-total columns by label, and what to attach to which row."""

    totals: tuple[tuple[str, str], ...]
    attach_to: str
    attachments: tuple[Attachment, ...]


@dataclass(frozen=True)
class KpiBand:
    """Open interval of the change ratio that counts as flat."""

    low: float = 0.95
    high: float = 1.05

    @classmethod
    def percent(cls, change: float) -> "KpiBand":
        return cls(1 - change / 100, 1 + change / 100)
