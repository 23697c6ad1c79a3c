"""Calendar-range rolling totals, averages and maxima.

Three strategies give the same rows:

``window``
    one range frame per measure, partitioned by key.  Right for panels: with
    one row per key and day a partition can never exceed the number of
    calendar days covered, however large the table.  All frames, lags and
    ranks of later operators use the same partitioning and ordering, so they
    share its shuffle and sort.

``explode``
    for inputs with many rows per key and day, where a key could hold any
    share of the table.  Rows are first reduced to daily partials (combined
    before the shuffle), each day is spread over the days it counts for, and
    the sums are joined back on key *and* day.  No task ever holds a whole key.

``blocks``
    as ``explode``, with a cost that does not grow with the range.  Days are
    cut into blocks as long as the range, so a range reaches into two blocks at
    most: the end of one and the beginning of the next.  Each daily partial
    asks its own block for what lies up to the range's end and the block before
    for what lies from the range's start on; running sums within a block answer
    both, three rows a day however long the range is.  A group is one key in
    one block.  Nothing is subtracted, so maxima work the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import derive, guarded_ratio
from ..specs import DATE, IDS, KEY, RollSpec

STRATEGIES = ("window", "explode", "blocks")


def _check(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")


def _range_frame(
    function: str, column: str, before: int, after: int, key: str, date: str
) -> str:
    """SQL text of ``function(column)`` over the calendar days around a row.

    A date ordering takes whole-day bounds in SQL text (the column API wants a
    number to order by), and ordering by the date itself lets every window of
    a chain share one sort.  NULL where the row has no key or date.
    """
    upper = "current row" if after == 0 else f"{after} following"
    return (
        f"case when `{key}` is not null and `{date}` is not null then "
        f"{function}(`{column}`) over (partition by `{key}` order by `{date}` "
        f"range between {before} preceding and {upper}) end"
    )


def _known(key: str, date: str) -> Column:
    return F.col(key).isNotNull() & F.col(date).isNotNull()


def _spread(df: DataFrame, before: int, after: int, key: str, date: str) -> DataFrame:
    """Repeat each daily row on every day whose range contains it."""
    days = F.sequence(F.date_sub(F.col(date), after), F.date_add(F.col(date), before))
    values = [c for c in df.columns if c not in (key, date)]
    return df.select(key, F.explode(days).alias(date), *values)


def _by_blocks(
    daily: DataFrame, function: str, before: int, after: int, key: str, date: str
) -> DataFrame:
    """``function`` (sum or max) of each value column over the days around each daily row."""
    width = before + after + 1
    values = [c for c in daily.columns if c not in (key, date)]
    day = F.unix_date(date)

    def block(at: Column) -> Column:
        return at - F.pmod(at, F.lit(width))

    def event(at: Column, kind: int) -> Column:
        asked = F.lit(None).cast("int") if kind == 0 else day
        held = [F.col(c) if kind == 0 else F.lit(None).cast(daily.schema[c].dataType) for c in values]
        return F.struct(
            block(at).alias("_block"),
            at.alias("_at"),
            F.lit(kind).alias("_kind"),
            asked.alias("_asked"),
            *(h.alias(c) for h, c in zip(held, values)),
        )

    end, start = day + after, day - before
    events = F.array(event(day, 0), event(end, 1), event(start, 2))
    # a range that fills one block is answered by its end alone
    asking = daily.select(key, F.inline(events)).where(
        (F.col("_kind") < 2) | (F.col("_block") + width <= F.col("_at") + before + after)
    )
    group = Window.partitionBy(key, "_block").orderBy("_at")
    upto = group.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = group.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    combine = {"sum": F.sum, "max": F.max}[function]
    told = asking.withColumns(
        {
            c: F.when(F.col("_kind") == 1, combine(c).over(upto)).otherwise(combine(c).over(onward))
            for c in values
        }
    )
    return (
        told.where("_kind > 0")
        .groupBy(key, F.date_from_unix_date("_asked").alias(date))
        .agg(*(combine(c).alias(c) for c in values))
    )


def rolling_summary(
    df: DataFrame,
    days: int,
    specs: Sequence[RollSpec],
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """Totals and averages of the last ``days`` calendar days, one row per input row.

    Totals are NULL when the range holds no value; averages divide by the
    number of values present, not by ``days``.  Rows without a key or date get
    NULLs.  Columns come in spec order, each total before its average.
    """
    _check(strategy)
    source = derive(df, [(s.variable, s.expr) for s in specs if s.expr])
    if strategy != "window":
        return _rolling_by_days(source, days, specs, ids, key, date, strategy)

    rolled = []
    for spec in specs:
        for function, name, wanted in (
            ("sum", spec.total_name(days), spec.total),
            ("avg", spec.avg_name(days), spec.avg),
        ):
            if wanted:
                frame = _range_frame(function, spec.variable, days - 1, 0, key, date)
                rolled.append(f"{frame} as `{name}`")
    return source.selectExpr(*[f"`{c}`" for c in ids], *rolled)


def _rolling_by_days(
    source: DataFrame,
    days: int,
    specs: Sequence[RollSpec],
    ids: Sequence[str],
    key: str,
    date: str,
    strategy: str,
) -> DataFrame:
    partials = []
    merges = []
    for i, spec in enumerate(specs):
        partials += [
            F.sum(spec.variable).alias(f"_sum{i}"),
            F.count(spec.variable).alias(f"_n{i}"),
        ]
        merges += [F.sum(f"_sum{i}").alias(f"_sum{i}"), F.sum(f"_n{i}").alias(f"_n{i}")]
    daily = source.where(_known(key, date)).groupBy(key, date).agg(*partials)
    if strategy == "blocks":
        sums = _by_blocks(daily, "sum", days - 1, 0, key, date)
    else:
        sums = _spread(daily, days - 1, 0, key, date).groupBy(key, date).agg(*merges)

    named = []
    for i, spec in enumerate(specs):
        if spec.total:
            named.append(F.col(f"_sum{i}").alias(spec.total_name(days)))
        if spec.avg:
            mean = guarded_ratio(F.col(f"_sum{i}"), F.col(f"_n{i}"))
            named.append(mean.alias(spec.avg_name(days)))
    rolled = sums.select(key, date, *named)
    outputs = [c for c in rolled.columns if c not in (key, date)]
    return source.join(rolled, [key, date], "left").select(*ids, *outputs)


def rolling_max(
    df: DataFrame,
    column: str,
    name: str,
    *,
    before: int = 10,
    after: int = 10,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """Set ``name`` to the largest ``column`` within ``before``/``after`` days."""
    _check(strategy)
    if strategy == "window":
        return df.withColumn(
            name, F.expr(_range_frame("max", column, before, after, key, date))
        )

    daily = df.where(_known(key, date)).groupBy(key, date).agg(F.max(column).alias("_max"))
    if strategy == "blocks":
        peaks = _by_blocks(daily, "max", before, after, key, date)
    else:
        spread = _spread(daily, before, after, key, date)
        peaks = spread.groupBy(key, date).agg(F.max("_max").alias("_max"))
    joined = df.join(peaks, [key, date], "left").withColumn(name, F.col("_max"))
    return joined.select(*df.columns, *([] if name in df.columns else [name]))
