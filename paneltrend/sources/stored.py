"""Panels stored by month and key bucket, beside a manifest of their days.

A store is a folder with a table for each panel.  A table is partitioned by
month and bucketed by key, with the same number of buckets in all of them, and
sorted by key and day.  So per-key windows read it without a shuffle, and panels
meet without one (:meth:`PanelStore.merged`).

The manifest tells for each file its month, first and last day, rows and the
days it has, as bits.  Summed up by month it is as long as the calendar, so the
days of a panel are known before any plan is made: newest dates are literals
instead of a pass over the table, and cutoffs name months, so files of other
months are not opened.

Rows without key or day are not stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import shifted_weekday
from ..operators.derive import drop_unkeyed
from ..specs import DATE, KEY

MONTH = "month"
#: The table of all keys and days that a panel of the store has.
SPINE = "spine"


def _month(day: dt.date) -> int:
    return day.year * 100 + day.month


def store_panels(
    spark: SparkSession, panels: Mapping[str, DataFrame], name: str, path: str, buckets: int | None = None
) -> "PanelStore":
    """Write ``panels`` as the store ``name`` (a prefix of its tables) in the folder ``path``.

    ``buckets`` defaults to the number of shuffle partitions.  Each panel is
    shuffled once, by key; a bucket's rows are in one file a month.
    """
    if SPINE in panels:
        raise ValueError(f"{SPINE!r} is the store's own table")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for panel, df in panels.items():
        _write(drop_unkeyed(df), f"{name}_{panel}", f"{path}/{panel}", buckets)
    days = [spark.table(f"{name}_{panel}").select(KEY, DATE) for panel in panels]
    _write(reduce(DataFrame.unionByName, days).distinct(), f"{name}_{SPINE}", f"{path}/{SPINE}", buckets)
    tables = (*panels, SPINE)
    files = reduce(DataFrame.unionByName, [_files(spark.table(f"{name}_{t}"), t) for t in tables])
    files.coalesce(1).write.parquet(f"{path}/manifest")
    layout = [(t, buckets, spark.table(f"{name}_{t}").drop(MONTH)) for t in tables]
    rows = [(t, n, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)) for t, n, df in layout]
    spark.createDataFrame(rows, "panel string, buckets int, fields string").coalesce(1).write.parquet(f"{path}/layout")
    return PanelStore(spark, name, path)


def open_store(spark: SparkSession, name: str, path: str) -> "PanelStore":
    """A store that another session has written; its tables are entered in this session's catalog."""
    for r in spark.read.parquet(f"{path}/layout").collect():
        table = f"{name}_{r['panel']}"
        if not spark.catalog.tableExists(table):
            spark.sql(
                f"create table {table} ({r['fields']}, {MONTH} int) using parquet partitioned by ({MONTH}) "
                f"clustered by ({KEY}) sorted by ({KEY}, {DATE}) into {r['buckets']} buckets "
                f"location '{path}/{r['panel']}'"
            )
            spark.catalog.recoverPartitions(table)
    return PanelStore(spark, name, path)


def _write(df: DataFrame, table: str, path: str, buckets: int) -> None:
    (
        df.withColumn(MONTH, F.year(DATE) * 100 + F.month(DATE))
        .repartition(buckets, KEY)
        .write.partitionBy(MONTH)
        .bucketBy(buckets, KEY)
        .sortBy(KEY, DATE)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )


def _files(df: DataFrame, panel: str) -> DataFrame:
    """A manifest row for each file, from the dates alone."""
    return (
        df.groupBy(F.input_file_name().alias("file"), MONTH)
        .agg(
            F.min(DATE).alias("first"),
            F.max(DATE).alias("last"),
            F.count("*").alias("rows"),
            F.bit_or(F.expr(f"shiftleft(1, dayofmonth({DATE}) - 1)")).alias("days"),
        )
        .select(F.lit(panel).alias("panel"), "file", F.col(MONTH).cast("int").alias(MONTH), "first", "last", "rows", "days")
    )


class PanelStore:
    """The panels of a store, read by day."""

    def __init__(self, spark: SparkSession, name: str, path: str) -> None:
        self.spark, self.name, self.path = spark, name, path
        self.manifest = spark.read.parquet(f"{path}/manifest")
        self._days: dict[str, list[dt.date]] = {}
        # a row for each month of a panel, however many files there are
        for r in self.manifest.groupBy("panel", MONTH).agg(F.bit_or("days").alias("days")).collect():
            year, month = divmod(r[MONTH], 100)
            own = self._days.setdefault(r["panel"], [])
            own += [dt.date(year, month, d + 1) for d in range(31) if r["days"] >> d & 1]
        for own in self._days.values():
            own.sort()

    def days(self, panel: str = SPINE) -> list[dt.date]:
        """The days that a panel has (default: any panel), ascending."""
        return self._days.get(panel, [])

    def newest(self, panel: str = SPINE, lag: int = 0) -> dt.date | None:
        """The newest day at least ``lag`` days before the newest of all."""
        days = self.days(panel)
        return next((d for d in reversed(days) if d <= days[-1] - dt.timedelta(lag)), None)

    def newest_on(self, weekday: int, panel: str = SPINE) -> dt.date | None:
        """The newest day that is on an ISO weekday."""
        return next((d for d in reversed(self.days(panel)) if d.isoweekday() == weekday), None)

    def files(self, panel: str, first: dt.date, last: dt.date) -> list[str]:
        """The files with days from ``first`` to ``last``."""
        held = (F.col("panel") == panel) & (F.col("last") >= F.lit(first)) & (F.col("first") <= F.lit(last))
        return sorted(r["file"] for r in self.manifest.where(held).select("file").collect())

    def frame(self, panel: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """A panel's rows from ``first`` to ``last``, both in; only their months' files are read."""
        return self._read(panel, first, last).drop(MONTH)

    def _read(self, panel: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
        df = self.spark.table(f"{self.name}_{panel}")
        if first is not None:
            df = df.where((F.col(MONTH) >= _month(first)) & (F.col(DATE) >= F.lit(first)))
        if last is not None:
            df = df.where((F.col(MONTH) <= _month(last)) & (F.col(DATE) <= F.lit(last)))
        return df

    def on_days(self, panel: str, days: list[dt.date]) -> DataFrame:
        """A panel's rows on some days."""
        df = self.spark.table(f"{self.name}_{panel}")
        months = sorted({_month(d) for d in days})
        return df.where(F.col(MONTH).isin(months) & F.col(DATE).isin(days)).drop(MONTH)

    # -- cutoffs; as those of operators.cutoffs, from the manifest -------------

    def cut_to_lag(self, panel: str, lag: int) -> DataFrame:
        return self._until(panel, self._end(panel, lag))

    def trailing_period(self, panel: str, days: int, lag: int = 0, history: int = 0) -> DataFrame:
        """Rows of the ``days`` days up to ``lag`` days before the newest, and of ``history`` days before those."""
        end = self._end(panel, lag)
        if end is None:
            return self.on_days(panel, [])
        return self.frame(panel, end - dt.timedelta(days + history), end)

    def thin_to_newest_weekday(self, panel: str) -> DataFrame:
        days = self.days(panel)
        return self.on_days(panel, [d for d in days if d.weekday() == days[-1].weekday()])

    def thin_to_weekday(self, panel: str, weekday: int, lag: int = 0) -> DataFrame:
        wanted = shifted_weekday(weekday, lag)
        return self.on_days(panel, [d for d in self.days(panel) if d.isoweekday() == wanted])

    def cut_to_weekday(self, panel: str, weekday: int, lag: int = 0) -> DataFrame:
        newest = self.newest_on(weekday, panel)
        return self._until(panel, newest and newest - dt.timedelta(lag))

    def _end(self, panel: str, lag: int) -> dt.date | None:
        days = self.days(panel)
        return days[-1] - dt.timedelta(lag) if days else None

    def _until(self, panel: str, last: dt.date | None) -> DataFrame:
        return self.on_days(panel, []) if last is None else self.frame(panel, None, last)

    # -- merges ----------------------------------------------------------------

    def merged(
        self, left: str, right: str, first: dt.date | None = None, last: dt.date | None = None
    ) -> DataFrame:
        """Full outer merge of two panels as :func:`merge_panels` gives it, without a shuffle.

        Both are joined to the store's keys and days, bucket by bucket, which
        keeps the buckets for the per-key windows that follow.  That the joins
        by key and day may use buckets by key alone is a setting of the session,
        made here.
        """
        self.spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        out = self._read(SPINE, first, last).drop(MONTH)
        sides = []
        for side, panel in enumerate((left, right)):
            df = self.frame(panel, first, last)
            named = {c: f"_{side}_{c}" for c in df.columns if c not in (KEY, DATE)}
            df = df.withColumnsRenamed(named).withColumn(f"_has_{side}", F.lit(True))
            out = out.join(df, [KEY, DATE], "left")
            sides.append(named)
        out = out.where(F.col("_has_0").isNotNull() | F.col("_has_1").isNotNull())
        columns = [KEY, DATE, *dict.fromkeys((*sides[0], *sides[1]))]
        merged = [F.coalesce(*(F.col(s[c]) for s in sides if c in s)).alias(c) for c in columns[2:]]
        return out.select(KEY, DATE, *merged)
