"""Panel merge, dimension lookups and key sets.

Lookups carry no broadcast hint: Spark broadcasts a side whose measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, so a
dimension that has grown is never forced into every executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import DATE, KEY


def merge_panels(
    left: DataFrame, right: DataFrame, on: Sequence[str] = (KEY, DATE)
) -> DataFrame:
    """Full outer merge; columns both sides have become one, left value first."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in shared})
    joined = left.join(other, list(on), "full")
    merged = [
        F.coalesce(F.col(c), F.col(f"_right_{c}")).alias(c) if c in shared else F.col(c)
        for c in left.columns
    ]
    added = [c for c in right.columns if c not in left.columns]
    return joined.select(*merged, *added)


def lookup(
    df: DataFrame, dimension: DataFrame, on: str = KEY, columns: Sequence[str] | None = None
) -> DataFrame:
    """Left lookup of dimension columns; rows without a match keep NULLs."""
    wanted = list(columns or [c for c in dimension.columns if c != on])
    return df.join(dimension.select(on, *wanted), on, "left").select(*df.columns, *wanted)


def in_key_set(
    df: DataFrame, key_sets: DataFrame, set_name: str, key: str = KEY
) -> DataFrame:
    """Rows whose key belongs to a named key set."""
    members = key_sets.where(F.col("set_name") == set_name).select(key)
    return df.join(members, key, "left_semi")


def site_bridge(pretty: DataFrame, population: DataFrame, site: str) -> DataFrame:
    """Display names of one site with their population."""
    own = pretty.where(F.col("Site") == site).drop("Site")
    return lookup(own, population, KEY, ["Population"])


def repeated_keys(df: DataFrame, on: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """Key/date pairs held by more than one row (a panel should have none)."""
    return df.groupBy(*on).agg(F.count("*").alias("rows")).where("rows > 1")
