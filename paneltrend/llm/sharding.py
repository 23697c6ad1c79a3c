"""Shards by balanced label propagation, with DataFrame functions only.

Documents that share a key are linked: by default the key is the text, so
copies belong together; ``links`` gives other keys, any number a document.  A
document starts in a shard told by its hash.  Each round counts the weight of
every key in every shard, joins the counts to the key's documents, and has each
document ask for the shard that holds most of its neighbours, in every other
round among those that still have room; ties go to one shard that the key and
the round name, so two halves of a group don't swap places.  A shard takes what fits:
its room and what leaves it, strongest wishes first and one key's documents
together, part of a key only where a whole one is too much.  Rounds end when
the cut (shards beyond the first that a key is in, summed over the keys) no
longer falls; the labels of the smallest cut are taken.

Then sizes are made even.  Linked documents beyond a shard's capacity and the
documents without links, which may stand anywhere, fill what room the shards
have, in the order of their keys.  All of this is arithmetic on one number a
row: its place in the order of shard, key and hash, from a range partitioning
and the counts of its partitions.

What the driver sees is sums by pair of shards, strength of the wish and slot
of the key: at most ``shards ** 2 * 64 * SLOTS`` rows, whatever the input.  A key
that a third of all rows have is one row of counts; its documents are joined by
a plain sort-merge join, which adaptive execution splits.

Laws: ``rows``, counts of rows at most one apart; ``bytes``, sums of sizes
(UTF-8 bytes and one more) that differ from the mean by at most the largest
document on either side.

Defined results: null text is the empty text; null, empty and equal ids are
rows like any other; rows that repeat id and text stand in different slots;
fewer rows than shards leave shards empty; a null key links nothing; an empty
table gives an empty result; other columns are ignored or, in ``sharded``,
passed through, ``shard`` and ``slot`` being replaced.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table, unused, whole_text

#: Cells into which the keys of equally strong wishes are dealt; a shard takes whole cells but for its last.
SLOTS = 16
#: A shard that linked documents fill so far takes no more of them.
FULL = 0.98
#: Shares of its capacity that a shard may hold between rounds; without slack full shards could not swap.
SLACK = 1.05
#: Rounds at most, and rounds that may pass without a smaller cut.
ROUNDS, PATIENCE = 16, 2
#: Steps into which the documents of a shard's last cell are dealt.
FINE = 1 << 20


def size_of(text: Column) -> Column:
    return (F.octet_length(text) + 1).cast("long")


def _tally(now: DataFrame, shards: int) -> DataFrame:
    """``key, t0, t1, ...``: the weight of each key in each shard."""
    return now.groupBy("key").agg(
        *(F.sum(F.when(F.col("label") == t, F.col("w")).otherwise(0)).alias(f"t{t}") for t in range(shards))
    )


def first_choice(turn: int, shards: int) -> Column:
    """The shard that a key prefers in a round among those that hold as much of it."""
    return F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(shards))


def _wishes(now: DataFrame, tally: DataFrame, shards: int, open_shards: list[int], turn: int, single: bool) -> DataFrame:
    """``now`` with ``target`` and ``level`` for the documents that would rather be in another shard, else null."""
    held = [f"t{t}" for t in range(shards)]
    if single:
        several = " + ".join(f"int({t} > 0)" for t in held)
        seen = now.join(tally.filter(F.expr(several) > 1), "key", "left")
    else:
        # the neighbours over all keys of a document, itself left out; its least key names the slot and the order of ties
        sums = [F.sum(t).alias(t) for t in held]
        seen = (
            now.join(tally, "key")
            .groupBy("row")
            .agg(F.min("key").alias("key"), F.first("w").alias("w"), F.first("h").alias("h"), F.first("label").alias("label"), F.count("*").alias("n"), *sums)
        )
        itself = F.col("n") * F.col("w")
        seen = seen.withColumns(
            {t: F.col(t) - F.when(F.col("label") == i, itself).otherwise(0) for i, t in enumerate(held)}
        ).drop("n")
    rank = {
        t: -F.pmod(F.lit(t) - first_choice(turn, shards), F.lit(shards)) if t in open_shards else F.lit(-shards).cast("long")
        for t in range(shards)
    }
    place = [F.struct(F.col(f"t{t}").alias("held"), rank[t].alias("rank"), F.lit(t).alias("t")) for t in range(shards)]
    own = F.element_at(F.array(*place), F.col("label") + 1)
    best = F.greatest(*(place[t] for t in open_shards)) if len(open_shards) > 1 else place[open_shards[0]]
    wish = F.when(best > own, best)
    # in a graph half of the documents stay each round, so that neighbours don't swap places for ever
    asks = F.col("t0").isNotNull() if single else F.pmod(F.xxhash64("h", F.lit(turn)), F.lit(2)) == 0
    seen = seen.withColumn("_wish", F.when(asks, wish)).withColumn("_own", own)
    return seen.withColumns(
        {
            "target": F.col("_wish.t"),
            "level": F.floor(F.log2(F.col("_wish.held") - F.col("_own.held") + 1)).cast("int"),
        }
    ).drop("_wish", "_own", *held)


def _admitted(cells: list, room: list[float]) -> dict[int, tuple[int, int, float]]:
    """For each target the level, the slot and the share of that cell up to which its wishes are met.

    ``cells``: rows of label, target, level, slot, w.  A shard takes what
    leaves it and its room more; shares of what is asked for are lowered until
    that holds for all.
    """
    asked: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    by_cell: dict[int, dict[tuple[int, int], float]] = defaultdict(lambda: defaultdict(float))
    for c in cells:
        asked[c["target"]][c["label"]] += c["w"]
        by_cell[c["target"]][-c["level"], c["slot"]] += c["w"]
    share = dict.fromkeys(asked, 1.0)
    for _ in range(200):
        before = dict(share)
        for t, by in asked.items():
            leaving = sum(share[to] * own.get(t, 0.0) for to, own in asked.items())
            share[t] = min(share[t], max(0.0, room[t] + leaving) / sum(by.values()))
        if all(before[t] - share[t] < 1e-6 for t in share):
            break
    ends = {}
    for t, own in by_cell.items():
        left = share[t] * sum(asked[t].values())
        if left <= 0:
            continue
        for (level, slot), w in sorted(own.items()):
            ends[t] = (-level, slot, min(1.0, left / w))
            left -= w
            if left <= 0:
                break
    return ends


def propagate(linked: DataFrame, shards: int, capacity: list[float], single: bool = True, rounds: int = ROUNDS) -> DataFrame:
    """``linked`` (``row, key, w, h, label`` and more) with the labels after the rounds.

    ``single``: each row has one key; else a row stands once for each of its keys.
    """
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS)).cast("int")
    fine = F.pmod(F.xxhash64("h"), F.lit(FINE))
    now, best, lowest, since = linked, linked, None, 0
    for turn in range(rounds + 1):
        tally = settled(_tally(now, shards))
        filled = [F.col(f"t{t}") > 0 for t in range(shards)]
        cut = sum((f.cast("int") for f in filled[1:]), filled[0].cast("int")) - 1
        seen = tally.agg(F.sum(cut).alias("cut"), *(F.sum(f"t{t}").alias(f"t{t}") for t in range(shards))).first()
        if not seen["cut"]:
            return now
        if lowest is None or seen["cut"] < lowest:
            best, lowest, since = now, seen["cut"], 0
        else:
            since += 1
            if since == (PATIENCE if single else 2 * PATIENCE):
                return best
        if single:
            loads = [seen[f"t{t}"] for t in range(shards)]
        else:
            by = {r["label"]: r["w"] for r in now.dropDuplicates(["row"]).groupBy("label").agg(F.sum("w").alias("w")).collect()}
            loads = [by.get(t, 0) for t in range(shards)]
        # by turns shards swap documents, and those that have room take what full ones can't
        open_shards = [t for t in range(shards) if turn % 2 and loads[t] < FULL * capacity[t]] or list(range(shards))
        wishes = settled(_wishes(now, tally, shards, open_shards, turn, single).withColumn("slot", slot))
        cells = (
            wishes.filter("target is not null").groupBy("label", "target", "level", "slot").agg(F.sum("w").alias("w")).collect()
        )
        ends = _admitted(cells, [c * SLACK - x for c, x in zip(capacity, loads)])
        met = F.lit(False)
        for t, (level, last, share) in ends.items():
            in_cell = (F.col("level") == level) & (
                (F.col("slot") < last) | ((F.col("slot") == last) & (fine < int(share * FINE)))
            )
            met |= (F.col("target") == t) & ((F.col("level") > level) | in_cell)
        if single:
            now = wishes.withColumn("label", F.when(met, F.col("target")).otherwise(F.col("label"))).select(*linked.columns)
        else:
            moved = wishes.filter(met).select("row", "target")
            label = F.coalesce("target", "label").alias("label")
            now = settled(now.join(moved, "row", "left").select(*(label if c == "label" else c for c in linked.columns)))
    return best


def _numbered(rows: DataFrame, weighed: bool) -> tuple[DataFrame, list]:
    """``rows`` with ``pos``, their place by ``label, key, h, row``, and ``upto``, the weight up to and with them.

    Beside it the sums ``label, n, w``.
    """
    order = ["label", "key", "h", "row"]
    dealt = settled(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_n", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_n", 33).cast("int"))
        .withColumn("_n", F.col("_n").bitwiseAND((1 << 33) - 1))
    )
    # a row for each partition, however many rows there are
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("_part")
        .agg(F.count("*").alias("n"), F.sum("w").alias("weight"))
        .select(
            "_part",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"),
            F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("_w0"),
        )
    )
    out = dealt.join(F.broadcast(starts), "_part").withColumn("pos", F.col("_n0") + F.col("_n"))
    if weighed:
        inside = Window.partitionBy("_part").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.col("_w0") + F.sum("w").over(inside)
    else:
        upto = F.col("pos") + 1
    loads = dealt.groupBy("label").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()
    return out.withColumn("upto", upto).drop("_part", "_n", "_n0", "_w0"), loads


def _interval(place: Column, ends: list[float]) -> Column:
    """The number of the first of ``ends`` beyond ``place``, the last one for places beyond all."""
    out = F.lit(len(ends) - 1)
    for t in range(len(ends) - 2, -1, -1):
        out = F.when(place < ends[t], F.lit(t)).otherwise(out)
    return out


def _by_number(names: str, values: list[float]) -> Column:
    """The value of the shard in column ``names``."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col(names) + 1)


def _settle_sizes(rows: DataFrame, shards: int, capacity: list[float], law: str) -> DataFrame:
    """``rows`` (label ``shards``: without links) with ``shard`` and ``slot``."""
    numbered, found = _numbered(rows, law == "bytes")
    loads = {r["label"]: r for r in found}

    def sums(field: str) -> list[int]:
        return [loads[t][field] if t in loads else 0 for t in range(shards + 1)]

    n, w = sums("n"), sums("w")
    kind = float if law == "bytes" else int
    n0 = [sum(n[:t]) for t in range(shards + 1)]
    w0 = [sum(w[:t]) for t in range(shards + 1)]
    stays = F.col("upto") - _by_number("label", w0) <= _by_number("label", [*capacity, kind(-1)])
    placed = numbered.withColumn("stays", stays)
    if law == "bytes":
        placed = settled(placed)  # read three times
        kept = {r["label"]: r for r in placed.filter("stays").groupBy("label").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()}
        kept_n = [kept[t]["n"] if t in kept else 0 for t in range(shards)]
        kept_w = [kept[t]["w"] if t in kept else 0 for t in range(shards)]
    else:
        kept_n = kept_w = [min(a, b) for a, b in zip(n, capacity)]
    # what doesn't stay, in order: rows and weight before each label's
    over_n = [a - b for a, b in zip(n, [*kept_n, 0])]
    over_w = [a - b for a, b in zip(w, [*kept_w, 0])]
    q0 = [sum(over_n[:t]) - n0[t] - ([*kept_n, 0][t]) for t in range(shards + 1)]
    v0 = [sum(over_w[:t]) - w0[t] - ([*kept_w, 0][t]) for t in range(shards + 1)]
    room = [max(0, c - k) for c, k in zip(capacity, kept_w)]
    ends = [sum(room[: t + 1]) for t in range(shards)]
    middle = F.col("upto") + _by_number("label", v0) - F.col("w") / 2
    placed = placed.withColumn("shard", F.when(F.col("stays"), F.col("label")).otherwise(_interval(middle, ends)).cast("int"))
    q = F.col("pos") + _by_number("label", q0)
    if law == "bytes":
        firsts = {r["shard"]: r["q"] for r in placed.filter(~F.col("stays")).groupBy("shard").agg(F.min(q).alias("q")).collect()}
        first = [firsts.get(t, 0) for t in range(shards)]
    else:
        first = [0, *ends[:-1]]
    slot = F.when(F.col("stays"), F.col("pos") - _by_number("label", n0)).otherwise(
        q - _by_number("shard", first) + _by_number("shard", kept_n)
    )
    return placed.withColumn("slot", slot.cast("long"))


def balanced_shards(
    docs: DataFrame,
    shards: int = 8,
    law: str = "rows",
    links: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    ``links``: ``id, key`` rows; documents with a key in common are linked (an
    edge of a graph is a key that two have).  None: equal texts are linked.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"no law {law!r}: rows or bytes")
    text = whole_text(text_column)
    light = docs.select(
        F.col(id_column).alias("id"),
        size_of(text).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    light = settled(
        light.withColumns(
            {
                "row": F.monotonically_increasing_id(),
                "w": F.col("size") if law == "bytes" else F.lit(1).cast("long"),
                "h": F.xxhash64("id", "text_key"),
            }
        )
    )
    total = light.agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).first()
    if law == "bytes":
        capacity = [total["w"] / shards] * shards
    else:
        capacity = [total["n"] // shards + (t < total["n"] % shards) for t in range(shards)]
    start = F.pmod("h", F.lit(shards)).cast("int").alias("label")
    if links is None:
        held = light.groupBy(F.col("text_key").alias("key")).agg(F.count("*").alias("n")).filter("n > 1").select("key")
        state = settled(
            light.join(held.withColumn("linked", F.lit(True)), F.col("text_key") == F.col("key"), "left").select(
                *light.columns, F.coalesce("key", F.lit(0)).alias("key"), F.col("linked").isNotNull().alias("linked"), start
            )
        )
        linked = state.filter("linked").drop("linked")
        rows = propagate(linked, shards, capacity, rounds=rounds)
        free = state.filter("not linked").drop("linked").withColumn("label", F.lit(shards))
    else:
        named = links.select(F.col(links.columns[0]).alias("_of"), F.xxhash64(links.columns[1]).alias("key"), F.col(links.columns[1]).alias("_key"))
        members = light.join(named.filter("_key is not null").distinct(), F.col("id") == F.col("_of"))
        several = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
        members = settled(members.join(several, "key", "left_semi").select("row", "key", "w", "h", start))
        moved = propagate(members, shards, capacity, single=False, rounds=rounds)
        labels = moved.groupBy("row").agg(F.min("label").alias("label"), F.min("key").alias("key"))
        state = light.join(labels, "row", "left").withColumns(
            {"label": F.coalesce("label", F.lit(shards)), "key": F.coalesce("key", F.lit(0))}
        )
        rows, free = state, None
    everything = rows if free is None else rows.unionByName(free)
    placed = _settle_sizes(everything, shards, capacity, law)
    return placed.select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, for ``write.partitionBy("shard")``; each whole row is shuffled once."""
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    copy, crc, ident, size = (unused(n, docs.columns) for n in ("_copy", "_crc", "_id", "_size"))
    place = balanced_shards(docs, id_column=id_column, text_column=text_column, **options)
    same = Window.partitionBy(ident, crc, size)
    place = place.select(F.col(id_column).alias(ident), F.col("text_crc32").alias(crc), F.col("size").alias(size), "shard", "slot")
    place = place.withColumn(copy, F.row_number().over(same.orderBy("shard", "slot")))
    text = whole_text(text_column)
    keyed = {ident: F.col(id_column), crc: F.crc32(text.cast("binary")), size: size_of(text)}
    rows = docs.select(*names).withColumns(keyed)
    rows = rows.withColumn(copy, F.row_number().over(same.orderBy(F.xxhash64(text_column))))
    left, right = rows.alias("l"), place.alias("r")
    on = F.lit(True)
    for c in (ident, crc, size, copy):
        on &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, on).select(*(F.col(f"l.{c}") for c in names), "r.shard", "r.slot")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return balanced_shards(table(spark, folder, "documents"))
