"""Embedding near-duplicates by collision counting over sorted projections.

Every vector is normalised and projected onto ``PROJECTIONS`` random
directions.  Within a bucket each projection is sorted, and a window centred on
each vector, ``WIDTH`` to either side, collides with the vectors in it; pairs
with at least as many collisions as the count calibrated for the recall wanted
are verified by their cosine in double precision.

Windows over all vectors of a label would meet a fixed share of all pairs, so
the sort starts with the label and the signs of a few further random
projections: a table of cells.  There are as many signs as leave about
``OCCUPANCY`` vectors in a cell and as many tables as keep a pair at the
threshold from missing all of them.  A pair is judged in the first table that
has both in one cell and nowhere else, so links are counted, not gathered: a
task returns each vector's number of links and the stars that connect them.
Cells beyond ``SPLIT`` members are dealt in blocks, every two meeting once.

Equal vectors of a label are one class, told by 128 bits of hash of label and
vector, before any cell is made: a class stands in a cell once, with its number
of rows, which is what a link to it counts, and the links among its own rows are
counted by arithmetic.  Rows whose id is not theirs alone are classes by id.
Vectors are scaled by a power of two, which is exact, so that squares neither
overflow nor vanish.

Defined results: a vector is linked with nothing if it or its label is null,
if it is zero or if a component is null or not finite; vectors of unequal
length are not compared; repeated rows are rows of their own, but rows with
the same id are one node, not linked with itself, that counts a link once for
each of its rows; rows with a null id link with nothing;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table
from paneltrend.llm.components import connected
from paneltrend.llm.simhash_golay import stars

#: One-dimensional projections whose windows are counted, and the windows' half width
#: (a projection of a normalised vector has about unit variance).
PROJECTIONS = 24
WIDTH = 0.6
#: Wanted vectors of a cell, and the share of threshold pairs that the tables and the counts may each miss.
OCCUPANCY = 128
MISSED = 1e-3
#: Members of a cell that one task compares; larger cells are dealt in blocks.
SPLIT = 8_000
#: Rows compared with all others of a cell at a time.
STRIPE = 512
SEED = 20


def signs_and_tables(largest: int, threshold: float) -> tuple[int, int]:
    """Sign bits of a cell and tables of cells, for the largest label's size."""
    signs = max(0, round(math.log2(max(1, largest / OCCUPANCY))))
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, 1 if signs == 0 else math.ceil(math.log(MISSED) / math.log(1 - same))


def least_collisions(threshold: float, size: int) -> int:
    """The greatest count that all but ``MISSED`` of the pairs exactly at the threshold reach.

    Calibrated on random pairs, by the same directions as the vectors meet.
    """
    rng = np.random.default_rng(SEED + 1)
    x = rng.standard_normal((20_000, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((20_000, size))
    y -= (x * y).sum(1, keepdims=True) * x
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    y = np.divide(y, norm, out=np.zeros_like(y), where=norm > 0)
    y = threshold * x + math.sqrt(1 - threshold**2) * y
    counts = (np.abs((x - y) @ directions(size, PROJECTIONS)) <= WIDTH).sum(1)
    return int(np.quantile(counts, MISSED, method="lower"))


def directions(size: int, count: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, size, count]).standard_normal((size, count))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest component; any finite row but zero has a plain norm then."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _in_cells(batches: Iterator[pa.RecordBatch], signs: int, tables: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Each vector once per table, with its cell and the cells it has in all tables; components in ``kind``."""
    powers = 1 << np.arange(signs, dtype=np.int64)
    for batch in batches:
        vectors = batch.column("embedding").to_pylist()
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = np.array([vectors[i] for i in at], np.float64).reshape(len(at), size)
            bits = (scaled(x) @ directions(int(size), signs * tables, SEED + 2) > 0).reshape(len(at), tables, signs)
            cells = (bits * powers).sum(2).astype("<i4")
            part = batch.take(pa.array(at))
            raw = pa.array([v.tobytes() for v in x.astype(kind)], pa.binary())
            codes = pa.array([c.tobytes() for c in cells], pa.binary())
            for t in range(tables):
                yield pa.record_batch(
                    {
                        "label": part.column("label"),
                        "size": pa.array(np.full(len(at), size, np.int32)),
                        "cell": pa.array(t << 40 | cells[:, t].astype(np.int64)),
                        "vec_id": part.column("vec_id"),
                        "weight": part.column("weight"),
                        "times": part.column("times"),
                        "vector": raw,
                        "cells": codes,
                    }
                )


CELLED = "label string, size int, cell long, vec_id long, weight long, times long, vector binary, cells binary"


def _collisions(sorted_by: list[tuple[np.ndarray, np.ndarray]], rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Collisions of some rows with all: for each projection the window around a row is a slice of the sorted order."""
    counts = np.zeros((len(rows), n), np.int16)
    for p, (order, line) in enumerate(sorted_by):
        low = np.searchsorted(line, values[rows, p] - WIDTH)
        high = np.searchsorted(line, values[rows, p] + WIDTH, "right")
        # +1 where a row's window begins and -1 behind its end; the running sum marks the window
        marks = np.zeros((len(rows), n + 1), np.int8)
        i = np.arange(len(rows))
        np.add.at(marks, (i, low), 1)
        np.add.at(marks, (i, high), -1)
        inside = np.cumsum(marks[:, :n], axis=1, dtype=np.int8)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        counts += inside[:, back]
    return counts


def _links_of_cell(cell: pa.Table, least: int, threshold: float, kind: str) -> pa.Table:
    """Links that are judged in this cell: per class their number, and the stars that connect them.

    A link to a class counts its rows (``weight``), for each of the ``times``
    that the id has the vector.
    """
    ids = cell.column("vec_id").to_numpy()
    n = len(ids)
    if n == 0:
        return _told([], [], [], [])
    size = cell.column("size")[0].as_py()
    t = cell.column("cell")[0].as_py() >> 40
    x = scaled(np.frombuffer(b"".join(cell.column("vector").to_pylist()), kind).astype(np.float64).reshape(n, size))
    weight, times = cell.column("weight").to_numpy(), cell.column("times").to_numpy()
    codes = np.frombuffer(b"".join(cell.column("cells").to_pylist()), "<i4").reshape(n, -1)[:, :t]
    mine, other, blocks = (cell.column(c).to_numpy() for c in ("mine", "other", "blocks"))
    norm = np.linalg.norm(x, axis=1)
    values = (x / norm[:, None]) @ directions(size, PROJECTIONS)
    sorted_by = [(order := np.argsort(values[:, p], kind="stable"), values[order, p]) for p in range(PROJECTIONS)]
    links = np.zeros(n, np.int64)
    us, vs = [], []
    for begin in range(0, n, STRIPE):
        rows = np.arange(begin, min(n, begin + STRIPE))
        i, j = np.nonzero(_collisions(sorted_by, rows, values, n) >= least)
        i = rows[i]
        once = (i < j) & (ids[i] != ids[j])
        i, j = i[once], j[once]
        # two blocks meet here: a pair within one of them belongs to the meeting of that block with itself
        whole = (blocks[i] == 1) | (mine[i] != mine[j]) | (mine[i] == other[i]) & (mine[j] == other[j])
        i, j = i[whole], j[whole]
        if t:
            first = ~(codes[i] == codes[j]).any(1)
            i, j = i[first], j[first]
        for a in range(0, len(i), 1 << 16):
            p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
            linked = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= threshold
            p, q = p[linked], q[linked]
            np.add.at(links, p, times[p] * weight[q])
            np.add.at(links, q, times[q] * weight[p])
            if len(p):
                u, v = stars(ids[p], ids[q])
                us.append(u)
                vs.append(v)
    some = links > 0
    u, v = (np.concatenate(z) for z in (us, vs)) if us else ([], [])
    if len(us) > 1:
        u, v = stars(u, v)
    return _told(ids[some], links[some], u, v)


def _told(ids, links, u, v) -> pa.Table:
    n, m = len(ids), len(u)
    return pa.table(
        {
            "vec_id": pa.concat_arrays([pa.array(ids, pa.int64()), pa.nulls(m, pa.int64())]),
            "links": pa.concat_arrays([pa.array(links, pa.int64()), pa.nulls(m, pa.int64())]),
            "u": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(u, pa.int64())]),
            "v": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(v, pa.int64())]),
        }
    )


def classes_of(usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes ``label, vec_id, weight, times, embedding``, and ``of, vec_id, own``: each id's class and its links within it.

    The members travel as hashes; a class's vector is one of its rows', taken
    before the shuffle.
    """
    first, second = F.xxhash64("label", "embedding"), F.xxhash64(F.lit(1), "embedding", "label")
    rows = usable.withColumns({"h1": first, "h2": second})
    light = settled(rows.select("vec_id", "h1", "h2"))
    repeated = settled(light.groupBy("vec_id").count().filter("count > 1").select("vec_id"))
    if repeated.isEmpty():
        alone = F.lit(None).cast("long").alias("alone")
        rows, light = rows.select("*", alone), light.select("*", alone)
    else:
        again = repeated.withColumn("alone", F.col("vec_id"))
        rows, light = rows.join(again, "vec_id", "left"), light.join(again, "vec_id", "left")
    key = ["h1", "h2", "alone"]
    classes = settled(
        rows.groupBy(*key).agg(
            F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
        )
    )
    times = F.when(F.col("alone").isNull(), F.lit(1).cast("long")).otherwise(F.col("weight")).alias("times")
    # links of a row with its copies need no comparison; rows of repeated ids are their class's own
    copied = classes.filter("alone is null and weight > 1").select("h1", "h2", F.col("vec_id").alias("class"), "weight")
    members = (
        light.filter("alone is null")
        .join(copied, ["h1", "h2"])
        .select(F.col("vec_id").alias("of"), F.col("class").alias("vec_id"), (F.col("weight") - 1).alias("own"))
    )
    return classes.select("label", "vec_id", "weight", times, "embedding"), members


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, split: int = SPLIT) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    kind = "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    usable = vectors.filter(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    ).select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string"),
        F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>"),
    )
    classes, members = classes_of(usable)
    sizes = classes.groupBy("label", F.size("embedding").alias("size")).count()
    seen = sizes.agg(F.max("count").alias("largest"), F.max("size").alias("size")).first()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if seen["largest"] is None:
        own = F.col("vec_id")
        return rows.select(own, F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
    signs, tables = signs_and_tables(seen["largest"], threshold)
    least = least_collisions(threshold, seen["size"])
    celled = classes.mapInArrow(lambda batches: _in_cells(batches, signs, tables, kind), CELLED)
    key = ["label", "size", "cell"]
    large = settled(
        celled.groupBy(*key)
        .count()
        .filter(F.col("count") > split)
        .select(*key, F.ceil(F.col("count") / split).cast("int").alias("blocks"))
    )
    whole = [F.lit(0).alias("mine"), F.lit(0).alias("other"), F.lit(1).alias("blocks")]
    if large.isEmpty():
        dealt = celled.select("*", *whole)
    else:
        spread = celled.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        spread = spread.withColumn("mine", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        dealt = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
    judged = settled(
        dealt.groupBy(*key, "low", "high").applyInArrow(
            lambda cell: _links_of_cell(cell, least, threshold, kind), "vec_id long, links long, u long, v long"
        )
    )
    counts = judged.filter("links is not null").groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = connected(judged.filter("u is not null").select("u", "v"))
    # an id that is not a class's own takes what its class has
    found = rows.join(members, F.col("of") == rows["vec_id"], "left").select(
        rows["vec_id"], F.coalesce(members["vec_id"], rows["vec_id"]).alias("class"), F.coalesce("own", F.lit(0)).alias("own")
    )
    counts, roots = counts.withColumnRenamed("vec_id", "counted"), roots.select("node", "root")
    component = F.coalesce("root", "class")
    return (
        found.join(counts, F.col("class") == F.col("counted"), "left")
        .join(roots, F.col("class") == F.col("node"), "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("own")).cast("long").alias("n_links"),
            component.alias("component_id"),
            (F.col("vec_id").isNull() | (F.col("vec_id") == component)).alias("kept"),
        )
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
