"""Values some reports back in a key, without a whole key in any task.

A report's position in its key is the number of reports on the key's earlier
days and its place among those of its day.  The first comes from counts by key
and day, which a window per key runs over: as many rows as there are calendar
days, whatever the table's size.  The value ``step`` positions back is then an
equality join on key and position, which spreads a key over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..specs import DATE, KEY

LAG_STRATEGIES = ("window", "blocks")


def check_lag_strategy(strategy: str) -> None:
    if strategy not in LAG_STRATEGIES:
        raise ValueError(f"strategy must be one of {LAG_STRATEGIES}, not {strategy!r}")


def positioned(
    df: DataFrame, ties: Sequence[str] = (), key: str = KEY, date: str = DATE, name: str = "_position"
) -> DataFrame:
    """``df`` with each row's position in its key, from 1, by date (null dates first).

    ``ties`` orders the rows of a day; rows that they don't tell apart may come
    in any order, so give columns that do where a day has several rows.
    """
    earlier = Window.partitionBy("_of").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        df.groupBy(F.col(key).alias("_of"), F.col(date).alias("_day"))
        .agg(F.count("*").alias("_reports"))
        .select("_of", "_day", F.coalesce(F.sum("_reports").over(earlier), F.lit(0)).alias("_before"))
    )
    same = F.col(key).eqNullSafe(F.col("_of")) & F.col(date).eqNullSafe(F.col("_day"))
    place = F.row_number().over(Window.partitionBy(key, date).orderBy(*(ties or [F.lit(0)])))
    found = df.join(before, same).withColumn(name, F.col("_before") + place)
    return found.drop("_of", "_day", "_before")


def with_earlier(
    df: DataFrame,
    columns: Mapping[str, str],
    step: int,
    *,
    ties: Sequence[str] = (),
    key: str = KEY,
    date: str = DATE,
) -> DataFrame:
    """``df`` with each new column holding its source ``step`` reports back, NULL where there are fewer."""
    placed = positioned(df, ties, key, date)
    back = placed.select(
        F.col(key).alias("_of"),
        (F.col("_position") + step).alias("_at"),
        *(F.col(source).alias(f"_back_{new}") for new, source in columns.items()),
    )
    same = F.col(key).eqNullSafe(F.col("_of")) & (F.col("_position") == F.col("_at"))
    joined = placed.join(back, same, "left")
    kept = [c for c in df.columns if c not in columns]
    return joined.select(*kept, *(F.col(f"_back_{new}").alias(new) for new in columns))
