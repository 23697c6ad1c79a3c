"""Newest period against the one before it, raw and per capita."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import change_kpi, guarded_ratio, kpi_color, per_100k
from ..specs import DATE, IDS, KEY, KpiBand, PeriodMeasureSpec
from .cutoffs import cut_to_lag
from .merge import lookup
from .reshape import common_number, stack


PERIOD_STRATEGIES = ("window", "days")


def period_table(
    df: DataFrame,
    days: int,
    lag: int,
    measures: Sequence[PeriodMeasureSpec],
    population: DataFrame,
    percent: float = 5,
    *,
    ids: Sequence[str] = IDS,
    key: str = KEY,
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """One row per key and measure: latest value, the one ``days`` reports back, KPI.

    Reports are picked by position: rank 1 and, as its predecessor, the next
    of ranks ``days + 1`` and ``2 * days + 1``.  Unlike the long comparison,
    0 against 0 counts as a fall by 100 %.

    With ``strategy="days"`` ranks come from counts by key and day, combined
    before the shuffle, and only the picked days' rows are joined back: no task
    holds a key's rows, however many it has a day.
    """
    if strategy not in PERIOD_STRATEGIES:
        raise ValueError(f"strategy must be one of {PERIOD_STRATEGIES}, not {strategy!r}")
    columns = [m.column(days) for m in measures]
    picked = (1, days + 1, 2 * days + 1)
    newest_first = Window.partitionBy(key).orderBy(F.desc(date))
    recent = cut_to_lag(df, lag, date).select(*ids, *columns)
    if strategy == "days":
        later = F.sum("_n").over(newest_first.rowsBetween(Window.unboundedPreceding, -1))
        rank = (F.coalesce(later, F.lit(0)) + 1).alias("_rank")
        ranks = recent.groupBy(key, date).agg(F.count("*").alias("_n")).select(
            F.col(key).alias("_of"), F.col(date).alias("_day"), rank
        )
        same = F.col(key).eqNullSafe(F.col("_of")) & (F.col(date) == F.col("_day"))
        ranked = recent.join(ranks.where(F.col("_rank").isin(*picked)), same).drop("_of", "_day")
    else:
        # The rank limit is pushed below the shuffle: each map task sends at
        # most 2 * days + 1 reports per key.
        ranked = (
            recent.withColumn("_rank", F.rank().over(newest_first))
            .where(F.col("_rank") <= 2 * days + 1)
            .where(F.col("_rank").isin(*picked))
        )
    ranked = lookup(ranked, population, key, ["Population"])
    capita = {
        f"_per_{m.column(days)}": per_100k(F.col(m.column(days)), F.col("Population"))
        for m in measures
        if m.per_capita
    }
    ranked = ranked.withColumns(capita) if capita else ranked
    carried = [*columns, *capita]
    newest = (
        ranked.withColumns(
            {
                "PreviousDate": F.lead(date).over(newest_first),
                **{f"_prev_{c}": F.lead(c).over(newest_first) for c in carried},
            }
        )
        .where("_rank = 1")
        .withColumnRenamed(date, "CurrentDate")
    )

    number = common_number(newest, columns)

    def row(m: PeriodMeasureSpec) -> dict:
        name = m.column(days)
        now, before = F.col(name), F.col(f"_prev_{name}")
        base = F.when(before == 0, F.when(now == 0, F.lit(1.0))).otherwise(
            before.cast("double")
        )
        none = F.lit(None).cast("double")
        now_per = F.col(f"_per_{name}") if m.per_capita else none
        before_per = F.col(f"_prev__per_{name}") if m.per_capita else none
        return {
            "Measure": F.lit(m.label),
            "CurrentNew": now.cast(number),
            "PreviousNew": before.cast(number),
            "Change": (now - before).cast(number),
            "ChangeProp": guarded_ratio(now, base) - 1,
            "CurrentNewPer100K": now_per,
            "PreviousNewPer100K": before_per,
            "ChangePer100K": now_per - before_per,
            "_up_good": F.lit(m.up_good),
        }

    kept = ["CurrentDate" if c == date else c for c in ids]
    long = stack(newest, [*kept, "Population", "PreviousDate"], [row(m) for m in measures])
    rated = long.withColumns(
        {
            "DayPeriod": F.lit(days),
            "LagDays": F.lit(lag),
            "ChangeRatio": F.col("ChangeProp") + 1,
        }
    ).withColumn(
        "KPI_ID",
        change_kpi(
            F.col("ChangeRatio"), F.col("Change"), F.col("_up_good"), KpiBand.percent(percent)
        ),
    )
    return rated.withColumn("KPI_Color", kpi_color(F.col("KPI_ID"))).drop("_up_good")
