"""Sharding: laws, slots, and the rounds against a plain version."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from paneltrend.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot int, label string, key string, row long, h long, w int"


def documents(seed, groups, singles):
    """Groups of copies of the given sizes, single texts, odd rows."""
    rng = random.Random(seed)
    rows, n = [], 0
    for g, size in enumerate(groups):
        text = f"copied {g} " * rng.randint(1, 30)
        for _ in range(size):
            rows.append((n, text))
            n += 1
    for _ in range(singles):
        rows.append((n, f"lone {n} " * rng.randint(0, 30) + str(n)))
        n += 1
    rows += [(n, None), (n + 1, ""), (None, "nobody"), (None, None), (3, "same id"), (3, "same id"), (n + 2, "é" * 20_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 0, 0, 0) for r in rows], SCHEMA).repartition(5)


def check(rows, got, law, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert {r["law"] for r in got} <= {law} and {r["grown_shard"] for r in got} <= {None}
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if law == "rows":
        counts = [len(slots[t]) for t in range(shards)]
        assert max(counts) - min(counts) <= 1
    else:
        mean = sum(sizes.values()) / shards
        assert max(abs(sizes[t] - mean) for t in range(shards)) <= max((r["size"] for r in got), default=0)


def cut_of(got):
    """Shards beyond the first of each text, which its size and checksum tell here."""
    held = defaultdict(set)
    for r in got:
        held[r["size"], r["text_crc32"]].add(r["shard"])
    return sum(len(s) - 1 for s in held.values())


@pytest.mark.parametrize("law", ["rows", "bytes"])
@pytest.mark.parametrize(
    "groups, singles",
    [
        ([2, 3, 5, 8] * 20, 150),  # small groups and single texts
        ([300, 40, 12, 2, 2, 2, 7], 400),  # one text beyond two shards
        ([2] * 150, 0),  # nothing is free
    ],
)
def test_laws_slots_and_groups(spark, law, groups, singles):
    rows = documents(len(groups), groups, singles)
    got = sharding.balanced_shards(frame(spark, rows), 8, law).collect()
    check(rows, got, law, 8)
    # each end of a shard may cut a text, one of more rows than a shard has is in several
    needed = sum(-(-g * 8 // len(rows)) - 1 for g in groups) if law == "rows" else 4
    by_hash = sum(min(8, g) - 1 for g in groups)
    assert cut_of(got) <= needed + 14 < by_hash


def plain_rounds(rows, shards, capacity, choices):
    """``propagate`` over a list of (row, key, w, h, label, slot, fine); ``choices``: key -> first choice in each round."""
    labels = {r[0]: r[4] for r in rows}
    best, lowest, since = dict(labels), None, 0
    for turn in range(sharding.ROUNDS + 1):
        held = defaultdict(lambda: [0] * shards)
        for row, key, w, *_ in rows:
            held[key][labels[row]] += w
        cut = sum(sum(x > 0 for x in t) - 1 for t in held.values())
        if not cut:
            return labels
        if lowest is None or cut < lowest:
            best, lowest, since = dict(labels), cut, 0
        else:
            since += 1
            if since == sharding.PATIENCE:
                return best
        loads = [sum(t[s] for t in held.values()) for s in range(shards)]
        open_shards = [t for t in range(shards) if turn % 2 and loads[t] < sharding.FULL * capacity[t]] or range(shards)
        wishes = []
        for row, key, w, _, _, slot, fine in rows:
            t = held[key]

            def place(s, t=t, first=choices[key][turn], held=open_shards):
                return t[s], -((s - first) % shards) if s in held else -shards, s

            to = max(open_shards, key=place)
            if sum(x > 0 for x in t) > 1 and place(to) > place(labels[row]):
                level = (t[to] - t[labels[row]] + 1).bit_length() - 1
                wishes.append((row, labels[row], to, level, slot, fine, w))
        cells = Counter()
        for _, label, to, level, slot, _, w in wishes:
            cells[label, to, level, slot] += w
        names = ("label", "target", "level", "slot")
        ends = sharding._admitted([dict(zip(names, k)) | {"w": w} for k, w in cells.items()], [c * sharding.SLACK - x for c, x in zip(capacity, loads)])
        for row, _, to, level, slot, fine, _ in wishes:
            if to in ends:
                end, last, share = ends[to]
                if (-level, slot) < (-end, last) or ((level, slot) == (end, last) and fine < int(share * sharding.FINE)):
                    labels[row] = to
    return best


@pytest.mark.parametrize("groups, free", [([2, 2, 3, 4, 9] * 12, 100), ([90, 60, 5, 5, 3] + [2] * 30, 40)])
def test_rounds_by_brute_force(spark, groups, free):
    from pyspark.sql import functions as F

    rng = random.Random(len(groups))
    rows = [(rng.getrandbits(62), key * 1_000_003 - 17) for key, n in enumerate(groups) for _ in range(n)]
    df = spark.createDataFrame([(n, key, 1, h, h % 4) for n, (h, key) in enumerate(rows)], "row long, key long, w long, h long, label int")
    told = df.select(
        "row", "key", "w", "h", "label",
        F.pmod(F.xxhash64("key"), F.lit(sharding.SLOTS)).cast("int"), F.pmod(F.xxhash64("h"), F.lit(sharding.FINE)),
    ).collect()
    every = [sharding.first_choice(turn, 4) for turn in range(sharding.ROUNDS + 1)]
    choices = {r["key"]: r["all"] for r in df.select("key", F.array(*every).alias("all")).distinct().collect()}
    n = len(rows) + free
    capacity = [n // 4 + (t < n % 4) for t in range(4)]
    got = {r["row"]: r["label"] for r in sharding.propagate(df, 4, capacity).collect()}
    assert got == plain_rounds([tuple(r) for r in told], 4, capacity, choices)


def test_links_of_a_graph(spark):
    """Communities with edges inside and a few between: far fewer edges are cut than by hash."""
    rng = random.Random(4)
    rows = [(i, f"text {i}") for i in range(400)]
    edges = [(c * 25 + rng.randrange(25), c * 25 + rng.randrange(25)) for c in range(16) for _ in range(150)]
    edges += [(rng.randrange(400), rng.randrange(400)) for _ in range(60)] + [(7, None), (999, 3)]
    links = [(i, f"{a}-{b}") for a, b in edges for i in (a, b)] + [(5, None)]
    got = sharding.balanced_shards(
        frame(spark, rows), 4, "bytes", spark.createDataFrame(links, "id long, key string").repartition(3), rounds=8
    ).collect()
    check(rows, got, "bytes", 4)
    shard = {r["doc_id"]: r["shard"] for r in got}
    cut = sum(shard[a] != shard[b] for a, b in edges if b is not None and a < 400)
    assert cut < 0.5 * len(edges)  # by hash three in four


def test_whole_rows_in_shards(spark):
    rows = documents(1, [6, 2, 2], 30)
    df = frame(spark, rows)
    out = sharding.sharded(df, shards=3)
    assert out.columns == [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    place = Counter((r["doc_id"], r["shard"], r["slot"]) for r in sharding.balanced_shards(df, 3).collect())
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in got) == place


def test_few_and_no_rows(spark):
    for rows in ([], [(1, "a")], [(1, "a"), (2, "a"), (None, None)]):
        for law in ("rows", "bytes"):
            df = frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
            check(rows, sharding.balanced_shards(df, 8, law).collect(), law, 8)
    with pytest.raises(ValueError, match="no law"):
        sharding.balanced_shards(df, law="key")


def test_the_query_has_no_python_in_its_plan(spark):
    from conftest import SF_DIR

    out = sharding.query(spark, SF_DIR)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = out.collect()
    check(rows, got, "rows", 8)
    copies = Counter(t for _, t in rows)
    assert cut_of(got) <= 14 + sum(-(-n * 8 // len(rows)) - 1 for n in copies.values())
