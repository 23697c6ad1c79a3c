"""Vector codes against plain versions and SQL."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from conftest import SF_DIR

from checks.harness import connect, differences
from paneltrend.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, _label string"


def plain(rows, parts, entries, rounds):
    """id -> (code, error), label errors and the codebooks, by loops over Python integers."""
    kept = [
        (i, [max(-vector_codes.LARGEST, min(vector_codes.LARGEST, math.floor(256 * x))) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1]) if kept else 0
    kept = [r for r in kept if len(r[1]) == length]
    width = -(-length // parts)
    cut = [[(v + [0] * parts)[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = {}
            for c in cut:
                of.setdefault(near(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*of[n])] if n in of else e for n, e in enumerate(book)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((i, label, "".join(f"{n:02x}" for _, n in found), error))
        by_label[label] = by_label.get(label, 0) + error
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    return [(*r, by_label[r[1]]) for r in out], hashlib.sha256(numbers.encode()).hexdigest()


def order(rows):
    return sorted(rows, key=repr)


def check(spark, rows, parts=4, entries=6, rounds=2):
    df = spark.createDataFrame([(*r, "c", 1, "l") for r in rows], SCHEMA).repartition(3)
    got = vector_codes.compress(df, parts, entries, rounds).collect()
    want, digest = plain(rows, parts, entries, rounds)
    assert order((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"]) for r in got) == order(want)
    assert {r["codebooks_sha256"] for r in got} <= {digest}


@pytest.mark.parametrize("length", [8, 16, 10])
def test_codes_by_brute_force(spark, length):
    rng = random.Random(length)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(length)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(200 + i, rows[3][1], 1) for i in range(40)]  # copies
    rows += [(300 + i, [round(x, 1) for x in rows[i][1]], 2) for i in range(60)]  # ties
    rng.shuffle(rows)
    check(spark, rows, 4)


def test_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 1) for i in range(10, 30)]
    rows += [(1, None, 1), (2, [], 1), (3, [1.0, None] * 4, 1), (4, [float("nan")] * 8, 2), (5, [math.inf] + [0.0] * 7, 2)]
    rows += [(6, [1e300] * 4 + [-1e300] * 4, None), (7, [1e-300] * 8, None), (40, [1.0] * 7, 1), (None, [0.5] * 8, 1)]
    rows += [(11, rows[1][1], 1), (11, rows[2][1], 1)]
    check(spark, rows)
    check(spark, rows, entries=64)
    check(spark, rows, rounds=0)
    check(spark, rows[20:24])
    with pytest.raises(ValueError, match="256"):
        check(spark, rows, entries=257)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = vector_codes.compress(empty)
    assert out.count() == 0 and out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("subtrie", [1, 7, 4096])
def test_tries_by_brute_force(monkeypatch, subtrie):
    monkeypatch.setattr(vector_codes, "SUBTRIE", subtrie)
    rng = np.random.default_rng(subtrie)
    parts = rng.integers(-4, 4, (3000, 4))
    leaves, number, weight = vector_codes.distinct_parts(parts)
    assert (leaves[number] == parts).all() and weight.sum() == 3000
    assert list(map(tuple, leaves.tolist())) == sorted(set(map(tuple, parts.tolist())))
    entries = rng.integers(-4, 4, (9, 4))
    entries[5] = entries[2]  # the first of equals is taken
    near, distance = vector_codes.nearest(leaves, entries)
    all_of = ((leaves[:, None, :] - entries[None]) ** 2).sum(2)
    assert (near == all_of.argmin(1)).all() and (distance == all_of.min(1)).all()


def test_decoding_names_the_entries(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(10)], 1) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    length, books = vector_codes.train(df, parts=4, entries=5)
    codes = vector_codes.encode(df, length, books, ["vec_id", "embedding"])
    for r in vector_codes.decode(codes, length, books).collect():
        numbers = [x for p in range(4) for x in books[p, int(r["code"][2 * p : 2 * p + 2], 16)].tolist()]
        assert r["decoded"] == [x / 256 for x in numbers[:10]]
        whole = vector_codes.whole_numbers(np.array([r["embedding"]]), 4)[0]
        assert r["error"] == ((whole - np.array(numbers)) ** 2).sum()


def test_the_query_equals_its_sql(spark):
    assert differences(vector_codes.query(spark, SF_DIR), connect(SF_DIR), vector_codes.SQL) == []
