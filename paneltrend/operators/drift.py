"""Has an upstream dimension table changed?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets of a digest.
BUCKETS = 1024


def dimension_drift(current: DataFrame, upstream: DataFrame) -> DataFrame:
    """Rows only one side has, with the number of copies on each side.

    One grouped pass over the tagged union, combined before the shuffle.
    """
    columns = current.columns
    tagged = current.select(*columns, F.lit(1).alias("_here"), F.lit(0).alias("_there")).unionByName(
        upstream.select(*columns, F.lit(0).alias("_here"), F.lit(1).alias("_there"))
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_here").alias("n_current"), F.sum("_there").alias("n_upstream"))
        .where("n_current = 0 or n_upstream = 0")
    )


def bucket_digests(df: DataFrame, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """A digest of the rows of each hash bucket: their number and order-free sums of their hashes.

    Equal multisets of rows have equal digests; those of parts of a table add up.
    """
    cells = [c for name in columns or df.columns for c in (F.col(name).isNull(), F.col(name))]
    prints = df.select(F.xxhash64(*cells).alias("_print"), F.xxhash64(F.lit(1), *cells).alias("_other"))
    half = F.col("_other").bitwiseAND(0xFFFFFFFF)
    return prints.groupBy(_bucket(F.col("_print"), buckets)).agg(
        F.count("*").alias("rows"),
        F.sum(F.shiftright("_print", 32)).alias("high"),
        F.sum(F.col("_print").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(half).alias("other"),
    )


def _bucket(print_: Column, buckets: int) -> Column:
    return F.pmod(print_, F.lit(buckets)).cast("int").alias("bucket")


def located_drift(current: DataFrame, upstream: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """As :func:`dimension_drift`, comparing rows only in the buckets whose digests differ.

    The digests are made at once: each table is read once for them, and a row
    for each bucket is what is shuffled and seen here.  Where all agree nothing
    is read again.
    """
    columns = current.columns
    digests = [{tuple(r) for r in bucket_digests(df, columns, buckets).collect()} for df in (current, upstream)]
    differing = sorted({r[0] for r in digests[0] ^ digests[1]})
    cells = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]

    def part(df: DataFrame) -> DataFrame:
        if not differing:
            return df.sparkSession.createDataFrame([], df.select(*columns).schema)
        return df.where(_bucket(F.xxhash64(*cells), buckets).isin(differing))

    return dimension_drift(part(current), part(upstream))


def drift_counts(current: DataFrame, upstream: DataFrame) -> DataFrame:
    """One row: current rows, distinct rows of both tables, and the verdict.

    The verdict is that of a refresh check: the tables have drifted when the
    distinct rows of both together are not as many as the current rows.  Rows
    that upstream dropped do not count; :func:`dimension_drift` lists them.
    """
    columns = current.columns
    both = current.select(*columns).unionByName(upstream.select(*columns)).distinct()
    return (
        current.agg(F.count("*").alias("n_current"))
        .withColumn("n_distinct", both.agg(F.count("*")).scalar())
        .withColumn("drifted", F.col("n_current") != F.col("n_distinct"))
    )


def has_drifted(current: DataFrame, upstream: DataFrame) -> bool:
    return bool(drift_counts(current, upstream).first()["drifted"])


def drift_report(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``drift_counts`` of each named pair (current, upstream), and whether any of them drifted."""
    if not tables:
        raise ValueError("no tables to compare")
    counts = [
        drift_counts(current, upstream).select(F.lit(name).alias("dimension"), "*")
        for name, (current, upstream) in tables.items()
    ]
    report = reduce(DataFrame.unionByName, counts)
    return report.withColumn("any_drifted", report.agg(F.max("drifted")).scalar())
