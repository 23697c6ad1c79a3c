"""Comparison of each value with the one ``lag`` reports earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import change_kpi, guarded_ratio
from ..specs import DATE, IDS, KEY, KpiBand, MeasureSpec
from .positions import check_lag_strategy, with_earlier
from .reshape import common_number, stack


def with_previous(
    df: DataFrame,
    measures: Sequence[MeasureSpec],
    days: int = 7,
    lag: int | None = None,
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Wide panel with ``_prev_{measure}``: the value ``lag`` rows back in the key.

    The lag counts rows, not days, and is taken while the panel is wide: one
    lag per measure over the partitioning the rolling summary already has,
    instead of one over a table ``len(measures)`` times as long.  With
    ``strategy="blocks"`` no task holds a key (see :mod:`.positions`); ``ties``
    orders the rows that a key has on one day.
    """
    check_lag_strategy(strategy)
    step = days if lag is None else lag
    names = [m.name(days) for m in measures]
    if strategy == "blocks":
        kept = df.select(*dict.fromkeys((*ids, *names, *ties)))
        placed = with_earlier(kept, {f"_prev_{n}": n for n in names}, step, ties=ties, key=key, date=date)
        return placed.select(*ids, *names, *(f"_prev_{n}" for n in names))
    previous = [
        f"lag(`{n}`, {step}) over (partition by `{key}` order by `{date}`) as `_prev_{n}`"
        for n in names
    ]
    return df.selectExpr(*[f"`{c}`" for c in (*ids, *names)], *previous)


def compare_wide(
    wide: DataFrame,
    measures: Sequence[MeasureSpec],
    days: int = 7,
    *,
    ids: Sequence[str] = IDS,
    date: str = DATE,
    band: KpiBand = KpiBand(),
) -> DataFrame:
    """Long comparison rows of a panel prepared by :func:`with_previous`.

    Row filters (cutoffs, newest row per key) belong between the two calls:
    every measure of a row shares its date, so filtering the wide panel keeps
    the same rows while they are still few.
    """
    names = [m.name(days) for m in measures]
    number = common_number(wide, names)
    long = stack(
        wide,
        ids,
        [
            {
                "Measure": f"'{name}'",
                "CurrentWeekValue": f"cast(`{name}` as {number})",
                "DatePrev": f"date_sub(`{date}`, {days})",
                "PreviousWeekValue": f"cast(`_prev_{name}` as {number})",
                "_up_good": "true" if m.up_good else "false",
            }
            for name, m in zip(names, measures)
        ],
    )
    now, before = F.col("CurrentWeekValue"), F.col("PreviousWeekValue")
    ratio = F.when((now == 0) & (before == 0), F.lit(1.0)).otherwise(
        guarded_ratio(now, before)
    )
    changed = long.withColumns({"WeekChange": now - before, "WeekChangeRatio": ratio})
    return changed.withColumns(
        {
            "WeekChangeProp": F.col("WeekChangeRatio") - 1,
            "KPI_ID": change_kpi(
                F.col("WeekChangeRatio"), F.col("WeekChange"), F.col("_up_good"), band
            ),
        }
    ).drop("_up_good")


def compare_periods(
    df: DataFrame,
    measures: Sequence[MeasureSpec],
    days: int = 7,
    lag: int | None = None,
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    band: KpiBand = KpiBand(),
    strategy: str = "window",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Current and earlier value, change, ratio and KPI per row and measure.

    ``DatePrev`` is the calendar date ``days`` earlier even where, on a panel
    with gaps, the row compared with is older.  0 against 0 counts as ratio 1.
    """
    wide = with_previous(
        df, measures, days, lag, ids=ids, key=key, date=date, strategy=strategy, ties=ties
    )
    return compare_wide(wide, measures, days, ids=ids, date=date, band=band)
