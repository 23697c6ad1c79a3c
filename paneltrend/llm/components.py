"""Connected components of a link table, by alternating star contractions.

Each round joins every link with the smallest neighbour of its endpoint, so a
node with millions of links is only ever a group of a partial minimum and a
join key, which adaptive execution splits; no neighbour list is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltrend.llm.common import settled


def _toward_minimum(links: DataFrame, large: bool) -> DataFrame:
    """One star step: nodes are linked to the smallest node around them."""
    if large:
        around = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter(F.col("u") != F.col("v")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node, root``: for each node of a link its component's smallest node.

    ``links`` has two long columns ``u`` and ``v``; loops, repeats and either
    direction are allowed, rows with a null end are ignored.  Nodes that are in
    no link do not appear, and the smallest node of a component does not either.
    The rounds needed grow with the logarithm of the longest path; each is
    checkpointed, so a lost executor costs one round.
    """
    now = settled(
        links.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        now = settled(_toward_minimum(_toward_minimum(now, large=True), large=False))
        # a fixed point is a set of stars: no root is itself linked downwards
        seen = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("hashes")
        ).first()
        if seen["n"] == 0 or seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
