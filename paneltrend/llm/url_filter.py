"""URL rules by a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and a path prefix; it fits the host, all its subdomains and
every path that starts so; the longest fitting rule wins (then the longer
host, then block before allow).  The keys a url could match are its host
suffixes and path prefixes in the shapes that occur among the rules.  All
distinct keys of the corpus are the universe.  Level 0 of a cascade encodes
the listed keys, level 1 the unlisted keys of the universe that pass level 0,
level 2 the listed ones that pass level 1, and so on until none is left; a key
of the universe is listed or not by the first level that rejects it, exactly
and without a join.

Level 0 gets a false positive rate of |list| / |universe| / sqrt 2 and later
levels one half, so a cascade takes about ``|list| * (1.44 log2(|universe| /
|list|) + 4)`` bits: it follows the list, hardly the corpus.  It is put into
the plan as constants while it has at most ``max_bytes``; for longer lists the
keys are joined with the list instead.

Defined results: a null url and one without ``://`` have empty host and path
and fit no rule; so does an empty host; repeated rows are judged each; an
empty list allows all; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed rules of the registered query: host, path prefix, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MAX_BYTES = 64 << 20
OWN = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path, empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def keys_of(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The rules a url could match: one key for each shape (labels of the host, length of the path)."""
    labels = F.size(F.split(host, r"\."))
    found = [
        F.when(
            (host != "") & (labels >= n) & (F.length(path) >= size),
            F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, size)),
        )
        for n, size in shapes
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


@dataclass(frozen=True)
class Level:
    bits: bytes
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        """Whether the filter holds ``key``, or seems to."""
        held = F.lit(self.bits)

        def bit(i: int) -> Column:
            at = _position(key, self.seed, i, len(self.bits) * 8)
            byte = F.conv(F.hex(F.substr(held, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, (at % 8).cast("int")) == 1

        out = bit(0)
        for i in range(1, self.hashes):
            out = out & bit(i)
        return out


def _position(key: Column, seed: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits))


def _encode(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """A Bloom filter of ``count`` keys; its bytes are combined in the tasks and read once."""
    size = max(8, math.ceil(-math.log(rate) / math.log(2) ** 2 * count / 8))
    hashes = max(1, round(size * 8 / count * math.log(2)))
    places = F.explode(F.array(*(_position(F.col("key"), seed, i, size * 8) for i in range(hashes)))).alias("at")
    set_bits = (
        keys.select(places)
        .groupBy(F.floor(F.col("at") / 8).alias("byte"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("at") % 8).cast("int"))).alias("bits"))
    )
    out = bytearray(size)
    for row in set_bits.toLocalIterator():
        out[row["byte"]] = row["bits"]
    return Level(bytes(out), hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for t in reversed(range(len(self.levels))):
            out = F.when(self.levels[t].passes(key), out).otherwise(F.lit(t % 2 == 1))
        return out

    def size(self) -> int:
        return sum(len(level.bits) for level in self.levels)


def build_cascade(universe: DataFrame, seed: int = 0, max_bytes: int = MAX_BYTES) -> Cascade | None:
    """``universe``: distinct ``key`` with ``listed``.  None if the cascade would exceed ``max_bytes``."""
    sizes = universe.agg(F.count_if("listed").alias("p"), F.count_if(~F.col("listed")).alias("n")).first()
    listed, others = sizes["p"], sizes["n"]
    levels: list[Level] = []
    if listed and listed * (1.5 * math.log2(max(2, others / listed)) + 8) / 8 > max_bytes:
        return None
    while True:
        t = len(levels)
        left = universe.filter(F.col("listed") == F.lit(t % 2 == 0))
        for level in levels:
            left = left.filter(level.passes(F.col("key")))
        count = listed if t == 0 else left.count()
        if count == 0:
            return Cascade(tuple(levels))
        rate = min(0.5, max(1e-9, listed * math.sqrt(0.5) / others)) if t == 0 and others else 0.5
        levels.append(_encode(left, count, rate, seed + t))


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_column: str = "url",
    default: str = "allow",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` added (columns of these names are replaced).

    ``rules``: ``host, path, verdict``; verdicts are allow or block.
    """
    listed = rules.select(
        F.concat(F.translate("host", UPPER, LOWER), F.col("path")).alias("key"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("size"),
        "verdict",
    ).filter(F.col("key").isNotNull())
    shapes = [(r["labels"], r["size"]) for r in listed.select("labels", "size").distinct().collect()]
    host, path = host_and_path(F.col(url_column))
    kept = [c for c in pages.columns if c not in OWN]
    told = pages.select(F.struct(F.lit(0).alias("_"), *kept).alias("_row"), host.alias("host"), path.alias("path"))
    keys = told.select("host", "path").distinct().select(F.explode(keys_of(F.col("host"), F.col("path"), shapes)).alias("key"))
    flags = [F.lit(False).alias("allow"), F.lit(False).alias("block")]
    universe = settled(
        keys.select("key", *flags)
        .unionByName(
            listed.select("key", (F.col("verdict") == "allow").alias("allow"), (F.col("verdict") == "block").alias("block"))
        )
        .groupBy("key")
        .agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    )
    cascades = [
        build_cascade(universe.select("key", F.col(v).alias("listed")), seed, max_bytes)
        for v, seed in (("block", 0), ("allow", 1000))
    ]
    row = [F.col("_row").getField(c).alias(c) for c in kept]
    if None in cascades:
        return _joined(told, listed, shapes, default).select(*row, *OWN)
    block, allow = cascades

    def judged(key: Column) -> Column:
        held = F.when(block.holds(key), F.lit("block")).when(allow.holds(key), F.lit("allow"))
        # the longest wins; of two as long, the one with the longer host
        host_size = F.length(F.substring_index(key, "/", 1))
        return F.struct(F.length(key).alias("n"), host_size.alias("h"), held.alias("verdict"), key.alias("rule"))

    hits = F.filter(F.transform(keys_of(F.col("host"), F.col("path"), shapes), judged), lambda x: x["verdict"].isNotNull())
    return (
        told.withColumn("_best", F.array_max(hits))
        .withColumn("rule", F.col("_best.rule"))
        .withColumn("verdict", F.coalesce("_best.verdict", F.lit(default)))
        .select(*row, *OWN)
    )


def _joined(told: DataFrame, listed: DataFrame, shapes: Sequence[tuple[int, int]], default: str) -> DataFrame:
    """The same for lists too long to stand in a plan: keys are joined with the list."""
    places = told.select("host", "path").distinct()
    best = (
        places.withColumn("key", F.explode(keys_of(F.col("host"), F.col("path"), shapes)))
        .join(listed.groupBy("key").agg(F.max("verdict").alias("verdict")), "key")
        .withColumn("h", F.length(F.substring_index("key", "/", 1)))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("key"), "h", "verdict", F.col("key").alias("rule"))).alias("_best"))
    )
    return (
        told.join(best, ["host", "path"], "left")
        .withColumn("rule", F.col("_best.rule"))
        .withColumn("verdict", F.coalesce("_best.verdict", F.lit(default)))
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH cut AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), told AS (
  SELECT page_id, n,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM told JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM told LEFT JOIN fits USING (n)
"""
