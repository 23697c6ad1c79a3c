"""Mixing sources to target weights by temperature, with DataFrame functions only.

A source's weight is its share of the tokens to the power ``a``, normalised.
``a`` is the point on a grid of millionths in [0, 1] found by bisection: the
least at which no source repeats more than ``max_repeats`` times, or the
greatest at which the entropy of the weights is at least ``target_entropy``;
given both, the greater of the two, so the repetition limit holds.

The weights are realised as permutations: a document of source ``s`` takes
part in ``floor(r)`` whole passes over its source and, if it stands early
enough in the next permutation, in one more, which ends where the budget of
the source is spent.  The place of that end is found from sums over about
sqrt(n) blocks of the permutation and one block's rows, so no source, however
large, is sorted or gathered.  Without ``budget`` the smallest one is taken
that uses every document, so nothing is dropped.

Defined results: a null source is a source; documents without tokens cost
nothing and stand once in every pass; a source without tokens stands once;
null text is empty; repeated rows are rows; an empty table stays empty; extra
columns pass through, and those named ``epoch``, ``block``, ``n_tokens`` or
``mix_weight`` are replaced by the operator's own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table, whole_text

GRID = 1_000_000
SECTIONS = 16
#: Draws are this many bits of a hash.
DRAW_BITS = 40
#: Source tables of at most so many rows are broadcast.
BROADCAST_SOURCES = 10_000
#: Output blocks: each holds the sources in their weights.
BLOCKS = 1024
NO_SOURCE = "\u0000"


def token_estimate(text: Column) -> Column:
    """Tokens of a text, estimated as a quarter of its bytes."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def draw(seed: int, epoch: Column, id_column: Column) -> Column:
    """Place of a document in the permutation of ``epoch``: a hash below 2**40."""
    text = F.concat_ws("|", F.lit(seed).cast("string"), epoch.cast("string"), F.coalesce(id_column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def _sums(shares: DataFrame, points: list[int]) -> dict[int, tuple[float, float]]:
    """For each exponent: the sum of powers and the entropy of the weights, all in one pass."""
    aggregates = []
    for k in points:
        a = k / GRID
        aggregates += [F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.log("p"))]
    row = shares.agg(*aggregates).first()
    out = {}
    for i, k in enumerate(points):
        z, s = row[2 * i], row[2 * i + 1]
        out[k] = (z, math.log(z) - k / GRID * s / z)
    return out


def find_exponent(
    shares: DataFrame,
    total: int,
    budget: int | None = None,
    max_repeats: float | None = None,
    target_entropy: float | None = None,
) -> float:
    """The exponent by bisection; every round tries 16 points in one aggregate."""
    ends = shares.agg(F.min("p").alias("low"), F.max("p").alias("high")).first()
    if ends["low"] is None:
        return 1.0

    def repeats(k: int, z: float) -> float:
        a = k / GRID
        if budget is None:
            return math.exp((1 - a) * (math.log(ends["high"]) - math.log(ends["low"])))
        return budget / total / z * math.exp((a - 1) * math.log(ends["low"]))

    def least(holds) -> int:
        """The least grid point from which ``holds`` is true on; GRID if it never is."""
        low, high = -1, GRID
        while high - low > 1:
            step = max(1, (high - low) // SECTIONS)
            points = [k for k in range(low + step, high, step)][: SECTIONS + 1]
            sums = _sums(shares, points)
            good = [k for k in points if holds(k, *sums[k])]
            high = min(good, default=high)
            low = max([k for k in points if k < high], default=low)
        return high

    chosen = []
    if max_repeats is not None:
        chosen.append(least(lambda k, z, h: repeats(k, z) <= max_repeats * (1 + 1e-12)))
    if target_entropy is not None:
        chosen.append(max(0, least(lambda k, z, h: h < target_entropy - 1e-12) - 1))
    return max(chosen, default=GRID) / GRID


def mix(
    docs: DataFrame,
    max_repeats: float | None = 2.0,
    target_entropy: float | None = None,
    budget: int | None = None,
    source_column: str = "source",
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 0,
) -> DataFrame:
    """``docs`` repeated to their weights, with ``n_tokens``, ``mix_weight``, ``epoch`` and ``block``.

    Reading the blocks in order gives the sources in their weights throughout.
    """
    source = F.coalesce(F.col(source_column).cast("string"), F.lit(NO_SOURCE))
    tokens = token_estimate(whole_text(text_column))
    light = settled(docs.select(source.alias("_s"), F.col(id_column).alias("_i"), tokens.alias("_t")))
    sources = settled(light.groupBy("_s").agg(F.sum("_t").alias("tokens"), F.count("*").alias("rows")))
    sums = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    total = sums["t"] or 0
    shares = sources.filter("tokens > 0").select("_s", "tokens", "rows", (F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))
    a = find_exponent(shares, total, budget, max_repeats, target_entropy)
    if total:
        z = _sums(shares, [round(a * GRID)])[round(a * GRID)][0]
        top = shares.agg(F.max("p")).first()[0]
        spend = float(budget) if budget is not None else total * z * top ** (1 - a)
    else:
        z, spend = 1.0, 0.0
    quota = F.floor(F.lit(spend) * F.pow("p", F.lit(a)) / F.lit(z) + 1e-6).cast("long")
    if budget is None:
        quota = F.greatest(quota, F.col("tokens"))
    planned = (
        sources.join(shares.select("_s", "p"), "_s", "left")
        .withColumn("quota", F.when(F.col("p").isNotNull(), quota))
        .select(
            "_s",
            F.coalesce(F.floor(F.col("quota") / F.col("tokens")), F.lit(1)).cast("int").alias("passes"),
            F.coalesce(F.col("quota") % F.col("tokens"), F.lit(0)).alias("rest"),
            F.coalesce(F.pow("p", F.lit(a)) / F.lit(z), F.lit(0.0)).alias("mix_weight"),
            F.coalesce(F.col("quota") / F.col("tokens"), F.lit(1.0)).alias("repeats"),
            F.ceil(F.sqrt("rows")).cast("long").alias("blocks"),
        )
    )
    few = sums["n"] <= BROADCAST_SOURCES
    small = F.broadcast if few else (lambda df: df)

    # the end of the last, partial pass of each source
    block_of_draw = F.floor(F.col("_h") * F.col("blocks") / F.lit(1 << DRAW_BITS))
    rows = light.join(small(planned.filter("rest > 0")), "_s").select(
        "_s", "_t", "_i", "rest", "blocks", draw(seed, F.col("passes"), F.col("_i")).alias("_h")
    )
    rows = rows.withColumn("_b", block_of_draw)
    upto = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (
        rows.groupBy("_s", "_b")
        .agg(F.sum("_t").alias("t"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("t").over(upto))
        .filter("upto > rest")
        .groupBy("_s")
        .agg(F.min(F.struct("_b", (F.col("rest") - F.col("upto") + F.col("t")).alias("left"))).alias("cut"))
        .select("_s", F.col("cut._b").alias("_b"), F.col("cut.left").alias("left"))
    )
    inside = Window.partitionBy("_s").orderBy("_h", "_i", "_t").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        rows.join(small(blocks), ["_s", "_b"])
        .withColumn("run", F.sum("_t").over(inside))
        .groupBy("_s")
        .agg(
            F.max(F.when(F.col("run") <= F.col("left"), F.struct("_h", "_i", "_t"))).alias("last"),
            F.min("_b").alias("cut"),
        )
    )
    plan = settled(planned.join(ends, "_s", "left"))

    own = ("n_tokens", "mix_weight", "epoch", "block")
    kept = [c for c in docs.columns if c not in own]
    wide = (
        docs.select(
            F.struct(*kept).alias("_row"), source.alias("_s"), tokens.alias("n_tokens"), F.col(id_column).alias("_i")
        )
        .join(small(plan), "_s")
        .withColumn("_h", draw(seed, F.col("passes"), F.col("_i")))
    )
    place = F.struct(F.col("_h").alias("_h"), F.col("_i").alias("_i"), F.col("n_tokens").alias("_t"))
    one_more = F.when(
        F.col("rest") > 0,
        # no row of the block where the budget ends may fit any more
        F.coalesce(place <= F.col("last"), block_of_draw < F.col("cut")),
    )
    copies = F.col("passes") + F.coalesce(one_more, F.lit(False)).cast("int")
    out = wide.withColumn("epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))))
    fraction = (F.col("epoch") + draw(seed, F.col("epoch"), F.col("_i")) / F.lit(float(1 << DRAW_BITS))) / F.col("repeats")
    return out.withColumn("block", F.least(F.floor(fraction * BLOCKS), F.lit(BLOCKS - 1)).cast("int")).select(
        *(F.col("_row").getField(c).alias(c) for c in kept), *own
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", "n_tokens", F.round("mix_weight", 6).alias("mix_weight"), "epoch", "block")


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, chr(1)) AS s, source,
         ceil(strlen(coalesce(text, '')) / 4)::BIGINT AS n_tokens FROM documents
), s AS (
  SELECT s, sum(n_tokens)::BIGINT AS t, count(*) AS n FROM d GROUP BY s
), p AS (SELECT *, t / sum(t) OVER () AS p FROM s WHERE t > 0
), a AS (
  SELECT least(1, greatest(0, ceil((1 - ln(2) / nullif(ln(max(p)) - ln(min(p)), 0)) * 1000000 - 1e-5) / 1000000)) AS a, max(p) AS top, sum(t) AS total FROM p
), z AS (
  SELECT coalesce(a, 0) AS a, top, total, (SELECT sum(pow(p, coalesce(a, 0))) FROM p) AS z FROM a
), q AS (
  SELECT s.s, s.t, s.n, pow(p, a) / z AS w,
         greatest(floor(total * z * pow(top, 1 - a) * pow(p, a) / z + 1e-6), s.t)::BIGINT AS quota
  FROM s LEFT JOIN p ON s.s = p.s CROSS JOIN z
), r AS (
  SELECT s, coalesce(quota // nullif(t, 0), 1) AS passes, coalesce(quota % nullif(t, 0), 0) AS rest,
         coalesce(w, 0) AS w, coalesce(quota / nullif(t, 0), 1) AS repeats
  FROM q
), last AS (
  SELECT d.*, r.*, ('0x' || substr(md5('0|' || passes || '|' || doc_id), 1, 10))::BIGINT AS h FROM d JOIN r ON d.s = r.s
), run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY s ORDER BY h, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) <= rest AND rest > 0 AS more
  FROM last
), copies AS (
  SELECT doc_id, source, n_tokens, w, repeats, unnest(range(passes::BIGINT + more::INT)) AS epoch FROM run
)
SELECT doc_id, source, n_tokens, round(w, 6) AS mix_weight, epoch::INT AS epoch,
       least(floor((epoch + ('0x' || substr(md5('0|' || epoch || '|' || doc_id), 1, 10))::BIGINT / 1099511627776.0::DOUBLE) / repeats * 1024), 1023)::INT AS block
FROM copies
"""
