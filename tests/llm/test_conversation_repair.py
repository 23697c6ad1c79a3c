"""Conversation repair: block tables against plain searches, faults, streams, SQL."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.harness import connect, differences
from paneltrend.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, key string, audit string, print int, kind string"
PATTERN = re.compile("(s?(ua)+)?")


def plain_audit(symbols):
    """Cost and audit of the cheapest edits by trying all, from each place of the output on; least cost, then least text."""
    places = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
    n = len(symbols)
    best = [dict.fromkeys(places) for _ in range(n + 1)]
    best[n].update({"": (0, ""), "a": (0, "")})
    for i in range(n, -1, -1):
        for _ in range(4):  # inserts lead to other places of the same row
            for place, then in places.items():
                found = [best[i][place]] if best[i][place] is not None else []
                if best[i][then[-1]] is not None:
                    cost, text = best[i][then[-1]]
                    found.append((cost + 2, "I" + text))
                if i < n:
                    must, cut, initial = symbols[i] == 8, symbols[i] // 4, "sua-"[symbols[i] % 4]
                    after = best[i + 1]
                    options = [(3, "D", place)]
                    if not must:
                        options += [(cut, "K", initial)] if initial in then else []
                        options += [(2 + cut, "R", then[-1])]
                    found += [(after[to][0] + c, e + after[to][1]) for c, e, to in options if after[to] is not None]
                best[i][place] = min(found, default=None)
    return best[0][""]


@given(st.lists(st.integers(0, 8), max_size=23))
@settings(max_examples=400, deadline=None)
def test_audits_by_brute_force(symbols):
    audit, cost = repair.tables().audit(np.array(symbols, np.int64))
    assert (cost, audit) == plain_audit(symbols)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_any_block_length_gives_the_same(block):
    rng = random.Random(block)
    for _ in range(60):
        symbols = np.array([rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 8]) for _ in range(rng.randrange(60))], np.int64)
        assert repair.tables(block).audit(symbols) == repair.tables().audit(symbols)


def test_vectors_are_few_and_blocks_compose():
    t = repair.tables()
    assert len(t.vectors) < 100 and t.block_step.shape == (len(t.vectors), 9**4)
    at = 0
    for digits in ([8, 3, 1, 2], [0, 0, 0, 0], [5, 5, 2, 8]):
        cost, now = 0, at
        for s in digits:
            cost += t.more[now, s]
            now = t.step[now, s]
        b = sum(d * 9 ** (3 - i) for i, d in enumerate(digits))
        assert (t.block_step[at, b], t.block_more[at, b]) == (now, cost)
        at = now


def plain_repair(rows):
    """conv -> columns of the query, from ``conv, turn, role, text`` after damage."""
    out, by = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text, turn))
    for conv, own in by.items():
        own.sort(key=lambda r: r[:4])
        seen, faults = set(), []
        for _, _, role, _, text, _ in own:
            bare = text.strip(" \t\n\x0b\f\r")
            if not bare:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        symbols = [
            8 if f in ("blank", "duplicate") else 4 * (f == "truncated") + {"s": 0, "u": 1, "a": 2}.get(i, 3)
            for f, i in zip(faults, initials)
        ]
        cost, audit = plain_audit(symbols)
        lines, at, shape = [], 0, ""
        for e in audit:
            role, text = (own[at][2], own[at][4]) if e != "I" else ("", "")
            at += e != "I"
            if e in "IR":
                role = "user" if shape[-1:] in ("", "s", "a") else "assistant"
            if e != "D":
                lines.append(f"{role}:{text}")
                shape += role[0]
        assert PATTERN.fullmatch(shape)
        turns = [r[5] for r in own if r[5] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


ROLES = ["system", "user", "user", "assistant", "assistant", "tool", "umpire", "", None, "User"]
TEXTS = ["Hello.", "What?", "cut sho", "ends. \n\t", " \x0b", "", None, "é!", "no end ", "x" * 3000 + "."]


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None, -1]:
        turn = 0
        for _ in range(rng.choice([1, 2, 5, 9, 40])):
            turn += rng.choice([1, 1, 1, 1, 2, 5])
            rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(ROLES), rng.choice(TEXTS)))
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "a", 1, "b") for r in rows], SCHEMA).repartition(5)


def named(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.fixture(scope="module")
def talk(spark):
    rows = conversations(3, 60)
    rows += [(500, i, ROLES[1 + i % 3], TEXTS[i % 4]) for i in range(3000)]  # one conversation with most rows
    return rows


def test_structure_and_repair_by_brute_force(spark, talk):
    rows = repair.as_rows(frame(spark, talk))
    want = plain_repair(named(talk))
    got = {r["conv"]: tuple(r)[1:] for r in repair.structure(rows).collect()}
    assert got == {conv: w[:-1] for conv, w in want.items()}
    lines = defaultdict(list)
    for r in repair.repaired(rows).orderBy("place").collect():
        assert r["place"] == len(lines[r["conv"]])
        lines[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_no_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.structure(repair.as_rows(empty)).count() == 0
    assert repair.repaired(repair.damaged(empty)).count() == 0
    empty.write.parquet(str(tmp_path / "conversations.parquet"))
    assert repair.query(spark, str(tmp_path)).count() == 0


def test_the_query_on_odd_rows_equals_its_sql(spark, talk, tmp_path):
    # a conversation of which every row is dropped, and rows that repeat whole
    import zlib

    dropped = [(9000, t, "user", "Hi.") for t in range(400) if zlib.crc32(f"9000:{t}".encode()) % 20 == 0][:3]
    frame(spark, talk + dropped + talk[:5] * 2).select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    (part,) = (tmp_path / "conversations.parquet").glob("*.parquet")
    db = connect(str(tmp_path / "none"))
    db.execute(f"create view conversations as select * from read_parquet('{part}')")
    got = repair.query(spark, str(tmp_path))
    assert differences(got, db, repair.SQL) == []
    row = got.filter("conv_id = 9000").first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_the_query_equals_its_sql(spark):
    assert differences(repair.query(spark, SF_DIR), connect(SF_DIR), repair.SQL) == []
