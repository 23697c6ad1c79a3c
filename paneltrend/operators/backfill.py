"""Rebuilding only what a back-update changed.

Reports of earlier days are corrected, added and withdrawn for weeks.  What has
changed is found by digests: per key and month the number of rows and sums of
their hashes, which don't depend on order and are combined before the shuffle.
Rows are compared only in the key-months whose digests differ.

A changed day ``d`` changes a range total of ``days`` days on ``d`` to
``d + days - 1`` of its key, and a comparison with the report ``lag`` rows back
on those days and on the ``lag`` reports after each, since a report added or
withdrawn shifts the positions behind it.  Rows outside are taken from the table
that was built before.  Windows run over the changed keys' dates alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..specs import DATE, IDS, KEY, MeasureSpec, RollSpec
from .compare import with_previous
from .rolling import rolling_summary


@dataclass(frozen=True)
class Rebuilt:
    """A table after a back-update: ``table`` is what a full rebuild gives.

    ``fresh``: the rows computed again; ``touched``: the key and day of these
    and of rows that are no more.
    """

    table: DataFrame
    fresh: DataFrame
    touched: DataFrame


def _month(date: str) -> Column:
    return F.year(date) * 100 + F.month(date)


def _prints(df: DataFrame, key: str, date: str) -> DataFrame:
    """``key, date, month`` and a hash of each row; a NULL and its place count."""
    cells = [c for name in sorted(df.columns) for c in (F.col(name).isNull(), F.col(name))]
    return df.select(F.col(key), F.col(date), _month(date).alias("_month"), F.xxhash64(*cells).alias("_print"))


def _summed(prints: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row counts and order-free sums of hashes; halves of a hash are summed apart, far from overflow."""
    return prints.groupBy(*by).agg(
        F.count("*").alias("_rows"),
        F.sum(F.shiftright("_print", 32)).alias("_high"),
        F.sum(F.col("_print").bitwiseAND(0xFFFFFFFF)).alias("_low"),
    )


def key_month_digests(df: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """``key, _month`` and its digest; equal for equal multisets of rows whatever their order."""
    return _summed(_prints(df, key, date), [key, "_month"])


def _differing(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = ("_rows", "_high", "_low")
    before = old.select(*by, *(F.col(c).alias(f"{c}_old") for c in sums))
    both = new.join(before, list(by), "full")
    same = F.lit(True)
    for c in sums:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_old"))
    return both.where(~same).select(*by)


def changed_days(old: DataFrame, new: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """``key, date`` on which two states of a panel differ; rows without key or date don't count."""
    def known(df: DataFrame) -> DataFrame:
        return df.where(F.col(key).isNotNull() & F.col(date).isNotNull())

    was, now = _prints(known(old), key, date), _prints(known(new.select(*old.columns)), key, date)
    months = _differing(_summed(was, [key, "_month"]), _summed(now, [key, "_month"]), [key, "_month"])
    rows = [p.join(months, [key, "_month"], "left_semi") for p in (was, now)]
    return _differing(*(_summed(r, [key, date]) for r in rows), [key, date])


def _days_around(days: DataFrame, before: int, after: int, key: str, date: str) -> DataFrame:
    around = F.sequence(F.date_sub(date, before), F.date_add(date, after))
    return days.select(key, F.explode(around).alias(date)).distinct()


def roll_again(
    rolled: DataFrame,
    panel: DataFrame,
    changed: DataFrame,
    days: int,
    specs: Sequence[RollSpec],
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> Rebuilt:
    """:func:`rolling_summary` of ``panel``, from the summary ``rolled`` of its state before and the changed days."""
    touched = _days_around(changed, 0, days - 1, key, date)
    read = _days_around(changed, days - 1, days - 1, key, date)
    part = panel.join(read, [key, date], "left_semi")
    fresh = rolling_summary(part, days, specs, ids=ids, key=key, date=date, strategy=strategy)
    fresh = fresh.join(touched, [key, date], "left_semi").select(*rolled.columns)
    kept = rolled.join(touched, [key, date], "left_anti").select(*rolled.columns)
    return Rebuilt(kept.unionByName(fresh), fresh, touched)


def compare_again(
    wide: DataFrame,
    rolled: DataFrame,
    touched: DataFrame,
    measures: Sequence[MeasureSpec],
    days: int = 7,
    lag: int | None = None,
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
) -> Rebuilt:
    """:func:`with_previous` of ``rolled``, from that of its state before and the days touched in it."""
    step = days if lag is None else lag
    line = rolled.select(key, date).join(touched.select(key).distinct(), key, "left_semi")
    marked = touched.select(key, date, F.col(date).alias("_mark"), F.lit(None).cast("boolean").alias("_row"))
    rows = line.select(key, date, F.lit(None).cast("date").alias("_mark"), F.lit(True).alias("_row"))
    upto = Window.partitionBy(key).orderBy(date)
    seen = rows.unionByName(marked).withColumn(
        "_mark", F.max("_mark").over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    )
    back = F.lag(date, step).over(upto)
    # a row is touched if a mark lies between it and the report it is compared with
    hit = F.col("_mark").isNotNull() & (F.col("_back").isNull() | (F.col("_mark") >= F.col("_back")))
    told = seen.where("_row").withColumn("_back", back).withColumn("_hit", hit)
    ahead = upto.rowsBetween(Window.currentRow, step)
    told = told.withColumn("_read", F.max("_hit").over(ahead))
    again = told.where("_hit").select(key, date)
    part = rolled.join(told.where("_read").select(key, date), [key, date], "left_semi")
    fresh = with_previous(part, measures, days, lag, ids=ids, key=key, date=date)
    fresh = fresh.join(again, [key, date], "left_semi").select(*wide.columns)
    gone = again.unionByName(touched.select(key, date)).distinct()
    kept = wide.join(gone, [key, date], "left_anti").select(*wide.columns)
    return Rebuilt(kept.unionByName(fresh), fresh, gone)
