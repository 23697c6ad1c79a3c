"""Vector codes from product codebooks, assigned by tries over distinct parts.

Components become whole numbers, floor(256 x), and each vector is cut into
equal parts.  A codebook of entries for each part position starts as the parts
of the vectors with the smallest ids; rounds assign every part to its nearest
entry and move each entry to the floor of its parts' mean.

Parts are assigned by a lexicographic trie.  A task takes its vectors in
blocks; of each position the distinct parts, in lexicographic order with their
counts, are the leaves of a trie whose inner nodes are common prefixes of
dimensions.  A depth-first traversal carries down the distances of the prefix
to all entries, so a prefix is measured once for all parts below it; a subtrie
of few leaves is finished level by level as arrays.  Leaves take the nearest
entry, and their counts weigh the sums of the next round.

Spark reads the table once a round.  A task sends one row for each entry in
use (parts x entries at most, however many vectors there are); the codebooks
are that small too.  Vectors are never shuffled; their codes are, once, with
the sum of errors of their label.

Defined results: a vector that is null, empty or holds null or non-finite
components is dropped, as is one of another length than the kept vector of
smallest id; lengths that the number of parts does not divide are filled with
zeros; numbers beyond +-2**27 count as that (their squares would not fit a
long); null ids come last and are coded too, null labels are one label;
repeated rows are rows, also among the first entries; fewer vectors than
entries give smaller codebooks; a label whose error does not fit a long has
null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import settled, table

#: Whole numbers for one unit of a component.
SCALE = 256
#: Numbers beyond this count as this: squared distances then fit 64 bits over 16 parts of 16 components.
LARGEST = 1 << 27
#: Vectors whose parts share a trie.
BLOCK_VECTORS = 1 << 15
#: Leaves of a subtrie that is finished level by level.
SUBTRIE = 1 << 11


# --- tries over distinct parts ------------------------------------------------------------


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, the number of each row's, and their counts."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    ordered = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    number = np.empty(len(parts), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number, np.bincount(number, minlength=int(new.sum()))


def _levels(parts: np.ndarray, entries: np.ndarray, depth: int, shared: np.ndarray) -> np.ndarray:
    """Distances of the sorted ``parts`` below one node, a level of the subtrie at a time."""
    new = np.zeros(len(parts), bool)
    new[0] = True
    node, held = np.zeros(len(parts), np.int64), shared[None, :]
    for k in range(depth, parts.shape[1]):
        new[1:] |= parts[1:, k] != parts[:-1, k]
        first = np.flatnonzero(new)
        # a node's distances are its parent's and one dimension more
        held = held[node[first]] + np.square(parts[first, k][:, None] - entries[None, :, k])
        node = np.cumsum(new) - 1
    return held[node]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry (the first of equals) of sorted, distinct ``parts``."""
    number = np.zeros(len(parts), np.int64)
    distance = np.zeros(len(parts), np.int64)
    ahead = [(0, len(parts), 0, np.zeros(len(entries), np.int64))] if len(parts) else []
    while ahead:
        low, high, depth, shared = ahead.pop()
        if high - low <= SUBTRIE or depth == parts.shape[1]:
            held = _levels(parts[low:high], entries, depth, shared)
            best = held.argmin(1)
            number[low:high], distance[low:high] = best, held[np.arange(high - low), best]
            continue
        value = parts[low:high, depth]
        starts = np.concatenate([[0], np.flatnonzero(value[1:] != value[:-1]) + 1, [high - low]])
        for a, b in zip(starts[-2::-1].tolist(), starts[:0:-1].tolist()):
            below = shared + np.square(value[a] - entries[:, depth])
            ahead.append((low + a, low + b, depth + 1, below))
    return number, distance


# --- vectors in Arrow batches -------------------------------------------------------------


def whole_numbers(vectors: np.ndarray, parts: int) -> np.ndarray:
    """``floor(256 x)``, filled with zeros to a length that ``parts`` divides."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    numbers = np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)
    return np.pad(numbers, ((0, 0), (0, -numbers.shape[1] % parts)))


def _kept(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and components of the lists that have ``length`` components, all finite."""
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sizes == length)
    values = column.take(pa.array(at)).flatten().cast(pa.float64())
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(at), length)
    good = np.isfinite(flat).all(1)
    return at[good], flat[good]


def _blocks(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[tuple[list, np.ndarray]]:
    """The other columns' arrays and the whole numbers of the kept vectors, a block at a time; the vector is the last column."""
    held: list[tuple[list[pa.Array], np.ndarray]] = []
    size = 0

    def close() -> tuple[list, np.ndarray]:
        return [pa.concat_arrays(c) for c in zip(*(o for o, _ in held))], np.concatenate([n for _, n in held])

    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_VECTORS):
            part = batch.slice(begin, BLOCK_VECTORS)
            at, vectors = _kept(part.columns[-1], length)
            held.append(([c.take(pa.array(at)) for c in part.columns[:-1]], whole_numbers(vectors, parts)))
            size += len(at)
            if size >= BLOCK_VECTORS:
                yield close()
                held, size = [], 0
    if size:
        yield close()


def _sums(batches: Iterator[pa.RecordBatch], length: int, books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each position and entry in use the number and the sums of its parts."""
    parts, entries, width = books.shape
    counts = np.zeros((parts, entries), np.int64)
    sums = np.zeros((parts, entries, width), np.int64)
    for _, numbers in _blocks(batches, length, parts):
        for p in range(parts):
            leaves, _, weight = distinct_parts(numbers[:, p * width : (p + 1) * width])
            entry, _ = nearest(leaves, books[p])
            np.add.at(counts[p], entry, weight)
            np.add.at(sums[p], entry, leaves * weight[:, None])
    part, entry = np.nonzero(counts)
    yield pa.record_batch(
        {
            "part": pa.array(part, pa.int32()),
            "entry": pa.array(entry, pa.int32()),
            "n": pa.array(counts[part, entry]),
            "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        }
    )


def _codes(
    batches: Iterator[pa.RecordBatch], length: int, books: np.ndarray, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """The other columns, of these names, with the code and the error of each vector."""
    parts, _, width = books.shape
    for others, numbers in _blocks(batches, length, parts):
        codes = np.empty((len(numbers), parts), np.uint8)
        error = np.zeros(len(numbers), np.int64)
        for p in range(parts):
            leaves, number, _ = distinct_parts(numbers[:, p * width : (p + 1) * width])
            entry, distance = nearest(leaves, books[p])
            codes[:, p] = entry[number]
            error += distance[number]
        text = codes.tobytes().hex()
        told = pa.array([text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string())
        yield pa.RecordBatch.from_arrays([*others, told, pa.array(error)], [*names, "code", "error"])


# --- the operator -------------------------------------------------------------------------


def _finite(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""

    def good(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce((F.size(vector) > 0) & F.forall(vector, good), F.lit(False))


def first_codebooks(vectors: DataFrame, parts: int, entries: int, id_column: str, vector_column: str) -> tuple[int, np.ndarray]:
    """The length of the vectors, and the parts of the ``entries`` vectors of smallest ids: parts x entries x width."""
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).alias("id"), vector.alias("v")).filter(_finite(F.col("v")))
    order = [F.col("id").asc_nulls_last(), "v"]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return 0, np.zeros((parts, 0, 0), np.int64)
    length = len(first[0]["v"])
    found = rows.filter(F.size("v") == length).orderBy(*order).limit(entries).collect()
    numbers = whole_numbers(np.array([r["v"] for r in found]), parts)
    return length, np.ascontiguousarray(numbers.reshape(len(found), parts, -1).swapaxes(0, 1))


def train(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[int, np.ndarray]:
    """The length of the vectors and the codebooks after the rounds."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    length, books = first_codebooks(vectors, parts, entries, id_column, vector_column)
    rows = vectors.select(F.col(vector_column).cast("array<double>").alias("v"))
    for _ in range(rounds if length else 0):
        sent = rows.mapInArrow(
            lambda batches, books=books: _sums(batches, length, books), "part int, entry int, n long, sums array<long>"
        )
        width = books.shape[2]
        total = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
        books = books.copy()
        for r in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return length, books


def encode(
    vectors: DataFrame,
    length: int,
    books: np.ndarray,
    kept: list[str],
    vector_column: str = "embedding",
) -> DataFrame:
    """The columns ``kept`` with ``code`` (two hex digits a part) and ``error`` of every kept vector."""
    rows = vectors.select(*kept, F.col(vector_column).cast("array<double>").alias("_vector"))
    shape = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(kept)]]
    schema = ", ".join([*shape, "code string", "error long"])
    if not length:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(lambda batches: _codes(batches, length, books, kept), schema)


def decode(codes: DataFrame, length: int, books: np.ndarray, code_column: str = "code") -> DataFrame:
    """The rows of ``codes`` with ``decoded``: the entries that the code names, as components."""
    width = books.shape[2]
    held = F.array(*(F.array(*(F.lit(float(x) / SCALE) for entry in book for x in entry)) for book in books))
    digits = F.sequence(F.lit(0), F.lit(books.shape[0] - 1))
    entry = [F.transform(digits, lambda p: F.conv(F.substring(F.col(code_column), 2 * p + 1, F.lit(2)), 16, 10).cast("int"))]
    parts = F.transform(digits, lambda p: F.slice(held[p], entry[0][p] * width + 1, width))
    return codes.withColumn("decoded", F.slice(F.flatten(parts), 1, length))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``id, label, code, error, label_error`` of every kept vector, and the digest of the codebooks."""
    length, books = train(vectors, parts, entries, rounds, id_column, vector_column)
    named = vectors.select(F.col(id_column).alias("_id"), F.col(label_column).alias("_label"), F.col(vector_column).alias("_v"))
    coded = settled(encode(named, length, books, ["_id", "_label"], "_v"))
    by_label = coded.groupBy(F.col("_label").alias("_of")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_column),
        F.col("_label").alias(label_column),
        "code",
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return compress(table(spark, folder, "embeddings")).drop("label")


def _assigned(books: str) -> str:
    """Nearest entry of every part: the least of distance * 64 + entry."""
    return f"""
  SELECT p.vec_id, p.part, min((
      (p.a - b.a) * (p.a - b.a) + (p.b - b.b) * (p.b - b.b) + (p.c - b.c) * (p.c - b.c) + (p.d - b.d) * (p.d - b.d)
    ) * 64 + b.entry) AS near
  FROM p JOIN {books} b ON p.part = b.part GROUP BY p.vec_id, p.part"""


def _moved(books: str, assigned: str) -> str:
    """Each entry moved to the floor of its parts' mean, if it has any."""
    means = ", ".join(f"floor(sum(p.{x})::DOUBLE / count(*))::BIGINT AS {x}" for x in "abcd")
    return f"""
  SELECT b.part, b.entry, {", ".join(f"coalesce(m.{x}, b.{x}) AS {x}" for x in "abcd")}
  FROM {books} b LEFT JOIN (
    SELECT p.part, n.near % 64 AS entry, {means}
    FROM p JOIN {assigned} n ON p.vec_id = n.vec_id AND p.part = n.part GROUP BY ALL
  ) m ON b.part = m.part AND b.entry = m.entry"""


#: Vectors of 64 components with ids of their own, as the table has them.
SQL = f"""
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND list_count(embedding) = 64
    AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), p AS MATERIALIZED (
  SELECT vec_id, part, floor(256 * e[4 * part + 1])::BIGINT AS a, floor(256 * e[4 * part + 2])::BIGINT AS b,
         floor(256 * e[4 * part + 3])::BIGINT AS c, floor(256 * e[4 * part + 4])::BIGINT AS d
  FROM v, range(16) r(part)
), b0 AS (
  SELECT part, rank - 1 AS entry, a, b, c, d
  FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM v) USING (vec_id) WHERE rank <= 64
), n0 AS MATERIALIZED ({_assigned("b0")}
), b1 AS MATERIALIZED ({_moved("b0", "n0")}
), n1 AS MATERIALIZED ({_assigned("b1")}
), b2 AS MATERIALIZED ({_moved("b1", "n1")}
), n2 AS MATERIALIZED ({_assigned("b2")}
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', (near % 64)::INT), '' ORDER BY part) AS code, sum(near // 64)::BIGINT AS error
  FROM n2 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""
