"""Reporting-lag cutoffs, trailing periods and weekday thinning.

A cutoff compares each row's date with an anchor such as the newest date of
the table.  Anchors are scalar subqueries: Spark evaluates each one once, as a
partial aggregate over the date column only, and hands the value to the
filter.  No join, no window over the whole table, no driver round trip.
Tables that share their dates can share anchors: :class:`Calendar` reads the
dates once, and cutoffs take the anchor as ``newest``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import iso_weekday, latest_monday, shifted_weekday
from ..specs import DATE, KEY
from .latest import check_strategy, join_newest


def newest_date(df: DataFrame, date: str = DATE) -> Column:
    """The table's newest date (NULLs skipped) as a scalar."""
    return df.agg(F.max(date)).scalar()


def newest_date_on(df: DataFrame, weekday: int, date: str = DATE) -> Column:
    """The newest date that falls on an ISO weekday, as a scalar."""
    on_day = F.when(iso_weekday(F.col(date)) == weekday, F.col(date))
    return df.agg(F.max(on_day)).scalar()


class Calendar:
    """Anchors of all tables with the same dates, from one pass over one of them.

    The pass leaves one row with the distinct dates, as many as there are
    calendar days at most, whatever the table's size.
    """

    def __init__(self, df: DataFrame, date: str = DATE) -> None:
        self._days = df.agg(F.collect_set(date).alias("days"))

    def newest(self, lag: int = 0) -> Column:
        """The newest date at least ``lag`` days before the newest of all, as a scalar."""
        end = F.date_sub(F.array_max("days"), lag)
        return self._days.select(F.array_max(F.filter("days", lambda d: d <= end))).scalar()


def _anchor(df: DataFrame, date: str, newest: Column | None) -> Column:
    return newest_date(df, date) if newest is None else newest


def cut_to_lag(
    df: DataFrame, lag: int, date: str = DATE, newest: Column | None = None
) -> DataFrame:
    """Rows at least ``lag`` days older than the newest date of the table."""
    return df.where(F.col(date) <= F.date_sub(_anchor(df, date, newest), lag))


def _with_newest(df: DataFrame, key: str, date: str, strategy: str) -> DataFrame:
    check_strategy(strategy)
    if strategy == "join":
        return join_newest(df, [key], date)
    return df.withColumn("_newest", F.max(date).over(Window.partitionBy(key)))


def cut_to_lag_by_key(
    df: DataFrame, lag: int, key: str = KEY, date: str = DATE, strategy: str = "window"
) -> DataFrame:
    """As :func:`cut_to_lag`, with the newest date taken inside each key."""
    dated = _with_newest(df, key, date, strategy)
    return dated.where(F.col(date) <= F.date_sub("_newest", lag)).drop("_newest")


def trailing_period(
    df: DataFrame, days: int, lag: int = 0, date: str = DATE, newest: Column | None = None
) -> DataFrame:
    """Rows of the ``days`` days up to ``lag`` days before the newest, both ends in."""
    end = F.date_sub(_anchor(df, date, newest), lag)
    return df.where((F.col(date) <= end) & (F.col(date) >= F.date_sub(end, days)))


def thin_to_newest_weekday(
    df: DataFrame, date: str = DATE, newest: Column | None = None
) -> DataFrame:
    """Rows that fall on the weekday of the newest date."""
    return df.where(F.weekday(date) == F.weekday(_anchor(df, date, newest)))


def thin_to_weekday(
    df: DataFrame, weekday: int, lag: int = 0, date: str = DATE
) -> DataFrame:
    """Rows that fall ``lag`` days before ISO weekday ``weekday``."""
    return df.where(iso_weekday(F.col(date)) == shifted_weekday(weekday, lag))


def cut_to_weekday(
    df: DataFrame, weekday: int, lag: int = 0, date: str = DATE
) -> DataFrame:
    """Rows up to ``lag`` days before the newest occurrence of a weekday."""
    return df.where(F.col(date) <= F.date_sub(newest_date_on(df, weekday, date), lag))


def mondays_as_of(
    df: DataFrame, lag: int, as_of: dt.date | None = None, date: str = DATE
) -> DataFrame:
    """Monday rows up to ``lag`` days before the Monday of the current week."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    newest = F.date_sub(latest_monday(today), lag)
    return df.where((iso_weekday(F.col(date)) == 1) & (F.col(date) <= newest))


def on_date_or_newest(
    df: DataFrame, cutoff: Column, keys: Sequence[str], key: str = KEY, date: str = DATE
) -> DataFrame:
    """Rows of ``keys`` on a cutoff date or on the newest date.

    The newest date is that of the whole table, before keys are picked.
    """
    newest = newest_date(df, date)
    return df.where(
        F.col(key).isin(*keys) & ((F.col(date) == cutoff) | (F.col(date) == newest))
    )


def anchor_pair(
    df: DataFrame,
    days: int,
    lag: int = 0,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """Per key, rows on the newest date after the lag cut and ``days`` before it."""
    cut = cut_to_lag_by_key(df, lag, key, date, strategy)
    on_anchor = F.col(date).isin(F.col("_newest"), F.date_sub("_newest", days))
    return _with_newest(cut, key, date, strategy).where(on_anchor).drop("_newest")
