"""Cheapest repairs of conversation structure, by Four-Russians block tables.

A conversation's rows, in the order of their turns, are edited until their
roles read ``(system?(user assistant)+)?``: a row is kept, given another role
or deleted, and rows without text may be inserted.  Of the cheapest edits the
ones whose initials (Delete, Insert, Keep, Rerole) are least in ASCII are made.

A prefix of rows has four costs, one for each place in the pattern that the
output may have reached: nothing, a system row, a user row, an assistant row.
Less their minimum there are few such vectors: places differ by a few inserts,
and a place that costs more than any use of it could save is left out.  So a
row's symbol (what its role is, whether it is cut short, whether it must go)
takes a vector to another and adds to the minimum, and the same holds for a
block of ``BLOCK`` symbols: the tables of all blocks are composed from those of
single symbols.  A conversation is then read a block at a time by lookup, and
the vectors at block ends are kept.  The blocks are expanded from the last to
the first, each marking which places at each row some cheapest repair passes
through; read forward, the least possible initial at each step gives the least
audit.

In Spark: faults are told by native columns; a repeated role and text by the
least row of each such group, taken before the shuffle.  Rows without texts
(a byte a symbol) come sorted by conversation to one Arrow pass that writes an
audit a conversation; a second pass gets each audit ahead of its
conversation's whole rows and streams the repaired ones.  A task holds one
batch and a few bytes a row of one conversation; a result that has one string
of a letter a row, and one digest over a whole conversation, bounds these by
its own size.

Defined results: a null role, text, conversation or turn counts as one space
(in the key of ``damaged``, and as a role or text); turns that are null come
first; rows of one turn go by role and the MD5 of their text; null
conversations are one conversation; a role's initial is its first character
(none for the empty role), so ``u...`` is a user's and an unknown role must
change; a conversation without rows left has the empty audit; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table

#: ASCII white space, ends of sentences, the roles that an edit may give.
SPACE, ENDS = " \t\n\x0b\f\r", ".!?"
USER, ASSISTANT = "user", "assistant"
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 0, 2, 3, 2, 1
#: Symbols of a block.
BLOCK = 4
#: Places in the pattern; the initials that lead there, and where a user or an assistant row leads.
NOTHING, SYSTEM, ASKED, ANSWERED = range(4)
INITIALS = "sua"
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
FINAL = 1 << NOTHING | 1 << ANSWERED
#: Faults of a row as codes; a code is fault * 4 + initial (3: any other); GONE stands for a conversation without this row.
CLEAN, TRUNCATED, BLANK, DUPLICATE, GONE = range(5)
#: No place has this cost.
NEVER = 1 << 20


# --- block tables -------------------------------------------------------------------------


def symbol_of(code: int) -> int:
    """Clean rows 0 to 3 by initial, truncated ones 4 to 7, rows that must go 8."""
    return min(code, 8)


SYMBOLS = 9


def _keeps(place: int, initial: int) -> int | None:
    """Where a kept row of that initial leads."""
    if initial == 0:
        return SYSTEM if place == NOTHING else None
    return NEXT[place] if initial < 3 and NEXT[place] == (ASKED, ANSWERED)[initial - 1] else None


def edits_of(place: int, symbol: int) -> list[tuple[str, int, int]]:
    """Initial, place and cost of the edits of a row, in ASCII order."""
    out = [("D", place, DELETE_COST)]
    if symbol < 8:
        cut, initial = divmod(symbol, 4)
        to = _keeps(place, initial)
        if to is not None:
            out.append(("K", to, KEEP_COST + cut * CUT_COST))
        out.append(("R", NEXT[place], REROLE_COST + cut * CUT_COST))
    return out


def _with_inserts(costs: list[int]) -> list[int]:
    costs = list(costs)
    for place in (NOTHING, SYSTEM, ANSWERED, ASKED, ANSWERED):
        costs[NEXT[place]] = min(costs[NEXT[place]], costs[place] + INSERT_COST)
    return costs


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """The vector less its minimum, without places that no cheapest repair passes through; and the minimum.

    What can follow a system row can follow an answer; what can follow nothing
    can, but for a kept system row, which would have to be deleted there.
    """
    costs = list(costs)
    if costs[SYSTEM] > costs[ANSWERED]:
        costs[SYSTEM] = NEVER
    if costs[NOTHING] > costs[ANSWERED] + DELETE_COST:
        costs[NOTHING] = NEVER
    low = min(costs)
    return tuple(c if c == NEVER else c - low for c in costs), low


class Tables:
    """Vectors by number, the start being 0; transitions of symbols and blocks; marks of places."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        start, _ = _normal(_with_inserts([0, NEVER, NEVER, NEVER]))
        self.vectors, number = [start], {start: 0}
        step, more = [], []
        for vector in self.vectors:  # grows
            for symbol in range(SYMBOLS):
                costs = [NEVER] * 4
                for place in range(4):
                    if vector[place] < NEVER:
                        for _, to, cost in edits_of(place, symbol):
                            costs[to] = min(costs[to], vector[place] + cost)
                after, low = _normal(_with_inserts(costs))
                if after not in number:
                    number[after] = len(self.vectors)
                    self.vectors.append(after)
                step.append(number[after])
                more.append(low)
        self.step = np.array(step, np.int32).reshape(-1, SYMBOLS)
        self.more = np.array(more, np.int64).reshape(-1, SYMBOLS)
        # blocks: the first symbol is the highest digit
        self.block_step, self.block_more = self.step, self.more
        for _ in range(block - 1):
            to = self.block_step
            self.block_more = (self.block_more[:, :, None] + self.more[to]).reshape(len(to), -1)
            self.block_step = self.step[to].reshape(len(to), -1)

    def _reached_by_insert(self, vector: tuple[int, ...], marked: int) -> int:
        """The marked places and those from which inserts lead there at no loss."""
        for _ in range(2):
            for place in range(4):
                to = NEXT[place]
                if vector[place] < NEVER and marked >> to & 1 and vector[to] == vector[place] + INSERT_COST:
                    marked |= 1 << place
        return marked

    @lru_cache(maxsize=None)  # noqa: B019  few vectors, 9 symbols, 16 marks
    def before(self, vector: int, symbol: int, marked: int) -> int:
        """Places before a row from which a cheapest repair reaches the marked ones after it."""
        here, after = self.vectors[vector], self.vectors[self.step[vector, symbol]]
        low = int(self.more[vector, symbol])
        out = 0
        for place in range(4):
            for _, to, cost in edits_of(place, symbol) if here[place] < NEVER else ():
                if marked >> to & 1 and after[to] + low == here[place] + cost:
                    out |= 1 << place
        return self._reached_by_insert(here, out)

    @lru_cache(maxsize=None)  # noqa: B019
    def last(self, vector: int) -> int:
        """The places after the last row from which a cheapest repair ends."""
        here = self.vectors[vector]
        low = min(here[NOTHING], here[ANSWERED])
        out = sum(1 << p for p in (NOTHING, ANSWERED) if here[p] == low)
        return self._reached_by_insert(here, out)

    @lru_cache(maxsize=None)  # noqa: B019
    def choice(self, vector: int, symbol: int, here_marked: int, after_marked: int, place: int) -> tuple[str, int]:
        """The least initial by which a cheapest repair goes on from a marked place, and where to."""
        here, after = self.vectors[vector], self.vectors[self.step[vector, symbol]]
        low = int(self.more[vector, symbol])
        found = [
            (name, to)
            for name, to, cost in edits_of(place, symbol)
            if after_marked >> to & 1 and after[to] + low == here[place] + cost
        ]
        to = NEXT[place]
        if here_marked >> to & 1 and here[to] == here[place] + INSERT_COST:
            found.append(("I", to))
        return min(found)

    def forward(self, symbols: np.ndarray) -> tuple[list[int], int]:
        """The vectors at the starts of blocks and of the rest, and the cost of the cheapest repair."""
        n = len(symbols) // self.block * self.block
        digits = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        blocks = (symbols[:n].reshape(-1, self.block) @ digits).tolist()
        at, cost, starts = 0, 0, []
        for b in blocks:
            starts.append(at)
            cost += int(self.block_more[at, b])
            at = int(self.block_step[at, b])
        starts.append(at)
        for s in symbols[n:].tolist():
            cost += int(self.more[at, s])
            at = int(self.step[at, s])
        end = self.vectors[at]
        return starts, cost + min(end[NOTHING], end[ANSWERED])

    def audit(self, symbols: np.ndarray) -> tuple[str, int]:
        """The least audit of the cheapest repairs, and their cost."""
        starts, cost = self.forward(symbols)
        n = len(symbols)
        vectors, marks = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.uint8)
        marked = None
        for b in range(len(starts) - 1, -1, -1):
            low, high = b * self.block, min(n, (b + 1) * self.block)
            own = symbols[low:high].tolist()
            inside = [starts[b]]
            for s in own:
                inside.append(int(self.step[inside[-1], s]))
            vectors[low : high + 1] = inside
            if marked is None:
                marked = marks[n] = self.last(inside[-1])
            for k in range(len(own) - 1, -1, -1):
                marked = marks[low + k] = self.before(inside[k], own[k], marked)
        out, place = [], NOTHING
        told, vector, mark = symbols.tolist(), vectors.tolist(), marks.tolist()
        for k in range(n):
            name = "I"
            while name == "I":
                name, place = self.choice(vector[k], told[k], mark[k], mark[k + 1], place)
                out.append(name)
        here = self.vectors[vector[n]]
        low = min(here[NOTHING], here[ANSWERED])
        while not (FINAL >> place & 1 and here[place] == low):
            out.append("I")
            place = NEXT[place]
        return "".join(out), cost


@lru_cache
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


@lru_cache(maxsize=1 << 14)
def _short_audit(symbols: bytes) -> tuple[str, int]:
    return tables().audit(np.frombuffer(symbols, np.uint8).astype(np.int64))


def audit_of(symbols: np.ndarray) -> tuple[str, int]:
    """Audit and cost; those of short conversations, which are often alike, are remembered."""
    if len(symbols) <= 64:
        return _short_audit(symbols.astype(np.uint8).tobytes())
    return tables().audit(symbols.astype(np.int64))


# --- faults, as columns -------------------------------------------------------------------


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` with planted faults, told by crc32 of ``conv:turn`` modulo 20; null roles and texts are a space.

    A dropped row stays as one whose ``dropped`` is true.
    """
    kind = F.pmod(F.crc32(F.concat(_named(conv), F.lit(":"), _named(turn)).cast("binary")), F.lit(20))
    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _named(role).alias("role"), _named(text).alias("text"), kind.alias("kind")
    )
    told = (
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        told.alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with a conversation's key (null has one of its own) and what orders rows of a turn."""
    key = F.coalesce(F.concat(F.lit("#"), F.col("conv").cast("string")), F.lit(""))
    return rows.withColumns({"key": key, "print": F.md5("text")})


def codes(rows: DataFrame) -> DataFrame:
    """``key, turn, role, print, row, code``: every row's first fault and its role's initial, without texts.

    A row is a duplicate if its conversation has its role and text earlier: the
    least row of each such group is joined back, so a group of any size is a
    partial minimum and one side of a join that adaptive execution splits.
    """
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    number = F.lit(3)
    for i, c in enumerate(INITIALS):
        number = F.when(initial == c, F.lit(i)).otherwise(number)
    fault = F.when(F.col("dropped"), GONE).when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(*ENDS), TRUNCATED).otherwise(CLEAN)
    light = settled(
        _keyed(rows).select(
            "key", "turn", "role", "print", F.monotonically_increasing_id().alias("row"), (fault * 4 + number).cast("int").alias("code")
        )
    )
    first = (
        light.filter(F.col("code") < 4 * BLANK)
        .groupBy("key", "role", "print")
        .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "row")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "role", "print", F.col("first.row").alias("first"))
    )
    later = (F.col("code") < 4 * BLANK) & F.col("first").isNotNull() & (F.col("first") != F.col("row"))
    code = F.when(later, DUPLICATE * 4 + F.col("code") % 4).otherwise(F.col("code"))
    return light.join(first, ["key", "role", "print"], "left").select("key", "turn", "role", "print", "row", code.alias("code"))


# --- conversations in sorted Arrow batches ------------------------------------------------

REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def report_of(key: str, turns: list[np.ndarray], code: np.ndarray) -> tuple:
    code = code[code < 4 * GONE]
    turn = np.concatenate(turns) if turns else np.empty(0, np.int64)
    gaps = int(turn[-1] - turn[0] - (turn[1:] != turn[:-1]).sum()) if len(turn) else 0
    fault, initial = code >> 2, code & 3
    pair = initial[:-1] * 4 + initial[1:]
    legal = np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]).sum()
    audit, cost = audit_of(np.where(fault < BLANK, code, 8))
    counts = (int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED))
    return key, gaps, *counts, int(len(pair) - legal), cost, audit


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, turn, code`` by key and turn (null turns first) in, a row of ``REPORT`` for each key out."""
    names = [c.split()[0] for c in REPORT.split(", ")]
    last, turns, held = None, [], []

    def close() -> tuple:
        return report_of(last, turns, np.concatenate(held))

    for batch in batches:
        out = []
        keys = batch.column(0).to_pylist()
        turn, code = batch.column(1), batch.column(2).to_numpy()
        real = turn.is_valid().to_numpy(zero_copy_only=False) & (code < 4 * GONE)
        turn = turn.fill_null(0).to_numpy()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and keys[a] != last:
                out.append(close())
                turns, held = [], []
            last = keys[a]
            turns.append(turn[a:b][real[a:b]])
            held.append(code[a:b].astype(np.uint8))
        if out:
            yield pa.record_batch([pa.array(list(c)) for c in zip(*out)], names)
    if held:
        yield pa.record_batch([pa.array([x]) for x in close()], names)


def reports(coded: DataFrame) -> DataFrame:
    """A row of ``REPORT`` for each conversation of ``codes``."""
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("print"), F.col("row")]
    dealt = coded.repartition("key").sortWithinPartitions(*order).select("key", "turn", "code")
    return dealt.mapInArrow(_reports, REPORT)


EDITED = "key string, place long, edit string, role string, text string"


class _Reader:
    """The repaired rows of one conversation as its rows come in, by the letters of its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, NOTHING

    def _next_role(self) -> str:
        self.place = NEXT[self.place]
        return USER if self.place == ASKED else ASSISTANT

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield "I", self._next_role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K" and self.place == NOTHING and role[:1] == INITIALS[0]:
            self.place = SYSTEM
            yield edit, role, text
        elif edit != "D":
            given = self._next_role()
            yield edit, role if edit == "K" else given, text


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, str, str]]]]:
    """Of rows ``key, audit, role, text``, each audit ahead of its rows, the key and the repaired rows of each; the last rows end a key."""
    key, reader = None, None
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(4))
        for k, audit, role, text in zip(*columns):
            if audit is None:
                yield k, list(reader.row(role, text))
                continue
            if reader is not None:
                yield key, list(reader.inserts())
            key, reader = k, _Reader(audit)
    if reader is not None:
        yield key, list(reader.inserts())


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``EDITED``."""
    names = [c.split()[0] for c in EDITED.split(", ")]
    last, place, out, size = None, 0, [], 0

    def send() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.record_batch([pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)], names)

    for key, rows in _edited(batches):
        if key != last:
            last, place = key, 0
        for edit, role, text in rows:
            out.append((key, place, edit, role, text))
            place, size = place + 1, size + len(text) + 64
        if size > 1 << 22:
            yield send()
            out, size = [], 0
    if out:
        yield send()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key and digest of each conversation's repaired ``role:text`` lines, which pass one at a time."""
    last, digest, any_row, out = None, None, False, []

    def send() -> pa.RecordBatch:
        return pa.record_batch([pa.array([k for k, _ in out]), pa.array([d for _, d in out])], ["key", "repaired_sha256"])

    for key, rows in _edited(batches):
        if digest is None or key != last:
            if digest is not None:
                out.append((last, digest.hexdigest()))
            last, digest, any_row = key, hashlib.sha256(), False
        for _, role, text in rows:
            digest.update((("\n" if any_row else "") + role + ":" + text).encode())
            any_row = True
        if len(out) > 4096:
            yield send()
            out = []
    if digest is not None:
        out.append((last, digest.hexdigest()))
    if out:
        yield send()


def _with_audits(rows: DataFrame, told: DataFrame) -> DataFrame:
    """``key, audit, role, text``: each conversation's audit and after it its rows in order."""
    nothing = F.lit(None).cast("string")
    ahead = told.select("key", F.lit(0).alias("kind"), "audit", F.lit(None).cast("long").alias("turn"), nothing.alias("role"), nothing.alias("text"), nothing.alias("print"))
    body = _keyed(rows.filter("not dropped")).select("key", F.lit(1).alias("kind"), nothing.alias("audit"), "turn", "role", "text", "print")
    order = [F.col("key"), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("print")]
    return ahead.unionByName(body).repartition("key").sortWithinPartitions(*order).select("key", "audit", "role", "text")


def _conv(kind: str) -> Column:
    return F.when(F.col("key") != "", F.expr("substring(key, 2)").cast(kind)).alias("conv")


def as_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, dropped`` of conversations as they are."""
    return conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _named(role).alias("role"), _named(text).alias("text"), F.lit(False).alias("dropped")
    )


def structure(rows: DataFrame) -> DataFrame:
    """``conv`` and the columns of ``REPORT`` of each conversation of ``as_rows`` or ``damaged``."""
    kind = rows.schema["conv"].dataType.simpleString()
    return reports(codes(rows)).select(_conv(kind), *[c.split()[0] for c in REPORT.split(", ")][1:])


def repaired(rows: DataFrame) -> DataFrame:
    """``conv, place, edit, role, text``: the repaired conversations, numbered from 0."""
    kind = rows.schema["conv"].dataType.simpleString()
    told = reports(codes(rows))
    return _with_audits(rows, told).mapInArrow(_repaired, EDITED).select(_conv(kind), "place", "edit", "role", "text")


def query(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    rows = damaged(conversations)
    told = settled(reports(codes(rows)))
    digests = _with_audits(rows, told).mapInArrow(_digested, "key string, repaired_sha256 string")
    kind = rows.schema["conv"].dataType.simpleString()
    return told.join(digests, "key").select(
        _conv(kind).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def _more(value: str, cost: str, initial: str) -> str:
    """A suffix's cost (six digits) and audit with one edit before it."""
    return f"printf('%06d', left({value}, 6)::INT + {cost}) || '{initial}' || substr({value}, 7)"


def _edited_sql(place: int) -> str:
    """Least cost and audit from a place, the next edit being one of the row's; least text is least cost, then least audit."""
    to = NEXT[place]
    own = {NOTHING: "initial = 's' OR initial = 'u'", SYSTEM: "initial = 'u'", ASKED: "initial = 'a'", ANSWERED: "initial = 'u'"}
    kept = f"CASE WHEN initial = 's' THEN v1 ELSE v{to} END" if place == NOTHING else f"v{to}"
    return f"""least({_more(f"v{place}", "3", "D")},
      CASE WHEN NOT must AND ({own[place]}) THEN {_more(f"({kept})", "cut", "K")} END,
      CASE WHEN NOT must THEN {_more(f"v{to}", "2 + cut", "R")} END) AS d{place}"""


#: The cheapest suffixes from the last row to the first, as text of cost and audit; then the audit's letters joined with the rows.
SQL = f"""
WITH RECURSIVE base AS (
  SELECT coalesce(conv_id::VARCHAR, 'none') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations
), kinds AS (
  SELECT *, xor(list_reduce(bytes, lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind
  FROM base
), damaged AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), told AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST) AS again
  FROM damaged
), faults AS (
  SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY k) AS n, lag(initial) OVER o || initial AS pair,
    CASE WHEN blank THEN 'blank' WHEN again > 1 THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM told WINDOW o AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text), again)
), lines AS MATERIALIZED (
  SELECT k, i, n, turn, role, text, initial, pair, fault, fault IN ('blank', 'duplicate') AS must, (fault = 'truncated')::INT AS cut FROM faults
), suffix(k, i, v0, v1, v2, v3) AS (
  SELECT DISTINCT k, n, '000000', '000004II', '000002I', '000000' FROM lines
  UNION ALL
  SELECT k, i - 1,
    least(d0, {_more("d2", "2", "I")}, {_more("d3", "4", "II")}),
    least(d1, {_more("d2", "2", "I")}, {_more("d3", "4", "II")}),
    least(d2, {_more("d3", "2", "I")}),
    least(d3, {_more("d2", "2", "I")})
  FROM (
    SELECT k, i, {", ".join(map(_edited_sql, range(4)))}
    FROM suffix JOIN lines USING (k, i)
  )
), audits AS (
  SELECT k, left(v0, 6)::BIGINT AS cost, substr(v0, 7) AS audit FROM suffix WHERE i = 0
), letters AS (
  SELECT k, j, substr(audit, j, 1) AS e,
    len(replace(left(audit, j), 'I', '')) AS i, len(replace(left(audit, j), 'D', '')) AS o
  FROM (SELECT k, audit, unnest(range(1, len(audit) + 1)) AS j FROM audits)
), output AS (
  SELECT l.k, j, o, e, r.role, CASE WHEN e = 'I' THEN '' ELSE r.text END AS text,
    bool_or(o = 1 AND e = 'K' AND initial = 's') OVER (PARTITION BY l.k) AS opened
  FROM letters l LEFT JOIN lines r ON l.k = r.k AND l.i = r.i AND e <> 'I' WHERE e <> 'D'
), repaired AS (
  SELECT k, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - coalesce(opened, false)::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY j) AS text
  FROM output GROUP BY k
), counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lines GROUP BY k
)
SELECT CASE WHEN c.k <> 'none' THEN c.k::BIGINT END AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT k FROM base) c LEFT JOIN counts USING (k) LEFT JOIN audits USING (k) LEFT JOIN repaired r USING (k)
"""
