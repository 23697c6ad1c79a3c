"""Change over the last N days, raw and per capita, for a grid of windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import per_100k
from ..specs import DATE, IDS, KEY, ChangeSpec, ChangeWindow
from .reshape import stack


CHANGE_STRATEGIES = ("window", "index")


def _on_points(
    panel: DataFrame, anchor: dict, points: Sequence[tuple], key: str, date: str
) -> DataFrame:
    """The rows on a point of the grid, with their key's anchors, by an index of each key's days."""
    index = panel.groupBy(F.col(key).alias("_of")).agg(F.collect_set(date).alias("_days"))

    def newest(lag: int) -> Column:
        upto = F.filter("_days", lambda d: d <= F.date_sub(F.array_max("_days"), lag))
        return F.array_max(upto)

    anchors = {name: newest(lag or 0).alias(name) for lag, name in anchor.items()}
    told = index.where(F.size("_days") > 0).select("_of", *anchors.values())
    days = F.array_distinct(F.array(*(F.date_sub(anchor[lag], d) for lag, d in points)))
    told = told.withColumn("_day", F.explode(days))
    same = F.col(key).eqNullSafe(F.col("_of")) & (F.col(date) == F.col("_day"))
    return panel.join(told, same).drop("_of", "_day")


def change_since(
    df: DataFrame,
    spec: ChangeSpec,
    windows: Sequence[ChangeWindow],
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """Rows per key, window, measure and kind (``Raw``, ``Per100K``).

    A dated window is the running total on the key's newest day after the lag
    cut minus the one exactly ``days`` days earlier (NULL if that day has no
    row).  An all-time window is the newest running total itself.  A key with
    several rows on an anchor day has no one answer and fails the job.

    The whole grid is answered from one pass: the anchor dates are attached by
    windows without ordering, only rows on an anchor survive, and one
    aggregate per key (same partitioning, no further shuffle) lines them up.

    With ``strategy="index"`` the days of each key are gathered in an array
    (as long as the calendar, combined before the shuffle), all anchors
    are looked up in it, and only the rows on the days that the grid needs are
    joined, by key and day: no task holds a key's rows.
    """
    if strategy not in CHANGE_STRATEGIES:
        raise ValueError(f"strategy must be one of {CHANGE_STRATEGIES}, not {strategy!r}")
    totals = [column for _, column in spec.totals]
    by_key = Window.partitionBy(key)
    lags = sorted({w.lag for w in windows if w.days is not None})

    # Anchor of a window without days: the newest date of all.
    anchor = {None: "_anchor_all"} | {lag: f"_anchor_{lag}" for lag in lags}
    panel = df.select(*ids, "Population", *totals)

    # The points the grid needs: (lag, 0) is the anchor row, (lag, d) the
    # row d days before it.
    points = sorted(
        {(w.lag, d) for w in windows if w.days is not None for d in (0, w.days)}
    )
    if any(w.days is None for w in windows):
        points.append((None, 0))
    if strategy == "index":
        panel = _on_points(panel, anchor, points, key, date)
    else:
        panel = panel.withColumn("_anchor_all", F.max(date).over(by_key)).withColumns(
            {
                anchor[lag]: F.max(
                    F.when(F.col(date) <= F.date_sub("_anchor_all", lag), F.col(date))
                ).over(by_key)
                for lag in lags
            }
        )
    is_point = {p: F.col(date) == F.date_sub(anchor[p[0]], p[1]) for p in points}
    wanted = F.lit(False)
    for condition in is_point.values():
        wanted = wanted | condition

    others = [c for c in ids if c != key]

    def picked(point: tuple, columns: Sequence[str]):
        return F.max(F.when(is_point[point], F.struct(*columns)))

    said = F.concat(F.lit("several rows on an anchor day of "), F.col(key).cast("string"))
    lined_up = (
        panel.where(wanted)
        .groupBy(key)
        .agg(
            F.greatest(F.lit(0), *[F.count_if(is_point[p]) for p in points]).alias("_rows"),
            *[
                picked(p, totals if p[1] else [*others, "Population", *totals]).alias(
                    _point_name(p)
                )
                for p in points
            ]
        )
        .where(F.when(F.col("_rows") > 1, F.raise_error(said).cast("boolean")).otherwise(True))
        .drop("_rows")
    )

    # One row per key and window: identity, measures now and the change in each.
    def window_row(w: ChangeWindow) -> dict:
        now = F.col(_point_name((None, 0) if w.days is None else (w.lag, 0)))
        changes = {}
        for i, column in enumerate(totals):
            value = now[column]
            if w.days is not None:
                value = value - F.col(_point_name((w.lag, w.days)))[column]
            changes[f"_raw{i}"] = value.cast("double")
        return {
            **{c: F.col(key) if c == key else now[c] for c in ids},
            "Population": now["Population"],
            "days": F.lit(w.days).cast("int"),
            "lagDays": F.lit(None if w.days is None else w.lag).cast("int"),
            "SlicerLevels": F.lit(w.slicer),
            "filterLevels": F.lit(w.filter_key),
            "_kinds": F.array(*[F.lit(k) for k in w.kinds]),
            **changes,
        }

    per_window = stack(lined_up, [], [window_row(w) for w in windows]).where(
        F.col(date).isNotNull()
    )
    per_window = per_window.withColumns(
        {
            f"_per{i}": per_100k(F.col(f"_raw{i}"), F.col("Population"))
            for i in range(len(totals))
        }
    )

    labels = [label for label, _ in spec.totals]
    none = F.lit(None).cast("double")

    def measure_row(i: int, kind: str) -> dict:
        prefix = "_raw" if kind == "Raw" else "_per"
        row = {
            "Measure": F.lit(labels[i]),
            "Raw_Per100K": F.lit(kind),
            "NewValue": F.col(f"{prefix}{i}"),
        }
        for extra in spec.attachments:
            value = none
            if labels[i] == spec.attach_to:
                value = F.col(f"{prefix}{labels.index(extra.plus)}")
                if extra.minus is not None:
                    value = value - F.col(f"{prefix}{labels.index(extra.minus)}")
            row[extra.name] = value
        return row

    head = [*ids, "Population", "days", "lagDays"]
    tail = ["SlicerLevels", "filterLevels"]
    long = stack(
        per_window,
        [*head, *tail, "_kinds"],
        [measure_row(i, k) for i in range(len(totals)) for k in ("Raw", "Per100K")],
    )
    if any(w.keep != "Both" for w in windows):
        long = long.where(F.array_contains("_kinds", F.col("Raw_Per100K")))
    values = ["Measure", "Raw_Per100K", "NewValue", *[a.name for a in spec.attachments]]
    return long.select(*head, *values, *tail)


def _point_name(point: tuple) -> str:
    lag, days = point
    return "_all" if lag is None else f"_at_{lag}_{days}"
