"""Newest row per key.

``strategy="window"`` suits panels: one row per key and day.  Where a key may
hold any share of the rows, or many rows its newest day, ``strategy="join"``
finds the newest dates by an aggregate that combines before its shuffle and
joins them back on key and date, a join Spark can split or broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..specs import DATE, KEY

STRATEGIES = ("window", "join")


def check_strategy(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")


def join_newest(
    df: DataFrame, keys: Sequence[str], date: str, only_newest: bool = False
) -> DataFrame:
    """``df`` with the newest date of its key as ``_newest``; NULL keys are a key."""
    renamed = {k: f"_of_{k}" for k in keys}
    newest = df.groupBy(*keys).agg(F.max(date).alias("_newest")).withColumnsRenamed(renamed)
    same = F.lit(True)
    for key, other in renamed.items():
        same = same & F.col(key).eqNullSafe(F.col(other))
    if only_newest:
        same = same & (F.col(date) == F.col("_newest"))
    return df.join(newest, same).select(*df.columns, "_newest")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = (KEY,),
    date: str = DATE,
    strategy: str = "window",
) -> DataFrame:
    """Rows on the newest date of their key; ties are all kept.

    In the window plan Spark limits each map task to its own rank-1 rows
    before the shuffle, so only candidates travel.
    """
    check_strategy(strategy)
    if strategy == "join":
        return join_newest(df, keys, date, only_newest=True).drop("_newest")
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(date))
    return df.withColumn("_rank", F.rank().over(newest_first)).where("_rank = 1").drop("_rank")
