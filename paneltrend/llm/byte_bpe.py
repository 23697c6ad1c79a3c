"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into pre-tokens once.  Each chunk of a task's texts leaves two
kinds of rows: per document the numbers of its words in order of position, and
the chunk's distinct words, dealt into buckets by their hash and packed.  The
buckets of all chunks are shuffled together, every distinct word is encoded
once in its bucket, and its ids go back to the chunks that have it, where the
documents are reassembled by position.  The pieces are bucketed by chunk, so
the documents never move.

Decoding joins each row's ids with the token-byte table.  The table is a fixed
vocabulary, so every task holds it and joins a whole row of ids at once; an id
that is not in it fails the job instead of losing bytes.

A chunk is closed after ``CHUNK_TOKENS`` pre-tokens, so a group holds a chunk
and not a source or a hot word; a hot word is one row per chunk.  A single
document is never divided, so the longest document bounds a chunk.

Defined results: null text is empty and has no ids; ids and bytes of a text
are those of its pre-tokens in order; repeated rows are encoded each; an empty
table gives an empty result; other columns are ignored by ``encode`` and pass
through ``decode``.  The encoder never emits special tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import bucketed, hand_back, lean, table, whole_text

CHUNK_TOKENS = 3_000_000
#: Buckets of words for each shuffle partition; a bucket's distinct words are held in memory.
BUCKETS_PER_PARTITION = 2
PIECES = "chunk long, doc_id long, places binary, bucket int, steps binary, sizes binary, words binary"
ENCODED = "part long, steps binary, sizes binary, ids binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file, read on the driver: a fixed vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank, leftmost first, is merged until none is left."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n < 32:
        parts = [word[i : i + 1] for i in range(n)]
        while len(parts) > 1:
            pairs = [ranks.get(parts[i] + parts[i + 1], 1 << 60) for i in range(len(parts) - 1)]
            best = min(pairs)
            if best == 1 << 60:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]
    # long words: a heap of pairs over a linked list, n log n
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray([1]) * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or ends[j] != end:
            continue  # one of the two has been merged since
        alive[j], ends[i], after[i] = 0, end, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : ends[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, ends[after[i]]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    return [ranks[word[i : ends[i]]] for i in range(n) if alive[i]]


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return _squeeze(planes.tobytes())


def _squeeze(content: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(content)


def _expand(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_expand(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _cut(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """Chunks of pre-tokens: each document's word numbers, and their distinct words by bucket."""
    from pyspark import TaskContext

    find = regex.compile(pattern).findall
    chunk = TaskContext.get().partitionId() << 32
    words: dict[str, int] = {}
    ids: list[int | None] = []
    places: list[bytes] = []
    held = 0

    def piece(n: int, **columns: list) -> pa.RecordBatch:
        kinds = {"chunk": pa.int64(), "doc_id": pa.int64(), "bucket": pa.int32()}
        columns["chunk"] = [chunk] * n
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.record_batch({c: pa.array(columns.get(c, [None] * n), kinds.get(c, pa.binary())) for c in names})

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal chunk, words, ids, places, held
        if ids:
            yield piece(len(ids), doc_id=ids, places=places)
        if words:
            texts = [w.encode() for w in words]
            bucket = np.fromiter(map(crc32, texts), np.int64, len(texts)) % buckets
            order = np.argsort(bucket, kind="stable")
            rows = []
            for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                own = [texts[i] for i in at]
                # numbers rise within a bucket: their differences are small
                steps, sizes = _pack(np.diff(at, prepend=0)), _pack([len(w) for w in own])
                rows.append((int(bucket[at[0]]), steps, sizes, _squeeze(b"".join(own))))
            yield piece(len(rows), **dict(zip(("bucket", "steps", "sizes", "words"), map(list, zip(*rows)))))
        chunk, words, ids, places, held = chunk + 1, {}, [], [], 0

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = find(text.as_py())
            ids.append(doc_id)
            places.append(_pack(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found))))
            held += len(found)
            if held >= CHUNK_TOKENS:
                yield from close()
    yield from close()


def _encode_buckets(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in, for each the ids of its words out; a bucket's words are encoded once."""
    bucket, known = None, {}
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                bucket, known = row["bucket"], {}
            ends = np.cumsum(_unpack(row["sizes"]), dtype=np.int64).tolist()
            whole = _expand(row["words"])
            ids = []
            for a, b in zip([0, *ends], ends):
                word = whole[a:b]
                found = known.get(word)
                if found is None:
                    found = known[word] = merge(word, ranks)
                ids.append(found)
            flat = np.fromiter(chain.from_iterable(ids), np.uint32)
            out.append((row["chunk"], row["steps"], _pack([len(i) for i in ids]), _pack(flat)))
        if out:
            columns = list(zip(*out))
            yield pa.record_batch(
                {
                    "part": pa.array(columns[0], pa.int64()),
                    **{n: pa.array(c, pa.binary()) for n, c in zip(("steps", "sizes", "ids"), columns[1:])},
                }
            )


def _assemble(docs: pa.Table, words: pa.Table, tokens: "TokenBytes | None") -> pa.Table:
    """The ids of a chunk's documents, from the ids of its words by number; with ``tokens`` also what they decode to."""
    numbers, sizes, flat = [], [], []
    for row in words.to_pylist():
        numbers.append(np.cumsum(_unpack(row["steps"]), dtype=np.int64))
        sizes.append(_unpack(row["sizes"]))
        flat.append(_unpack(row["ids"]))
    none = [np.empty(0, np.int64)]
    number, size, ids = (np.concatenate(x or none).astype(np.int64) for x in (numbers, sizes, flat))
    start = np.cumsum(size) - size
    order = np.argsort(number)
    size, start = size[order], start[order]
    values, lengths = [np.empty(0, np.int32)], []
    for places in docs.column("places").to_pylist():
        at = _unpack(places)
        n = size[at]
        ends = np.cumsum(n)
        # place of each id: its word's start and its place within the word
        values.append(ids[np.arange(n.sum()) + np.repeat(start[at] - ends + n, n)].astype(np.int32))
        lengths.append(len(values[-1]))
    digests = [hashlib.sha256(v.astype("<u4").tobytes()).hexdigest() for v in values[1:]]
    told = {
        "doc_id": docs.column("doc_id"),
        "n_tokens": pa.array(lengths, pa.int64()),
        "ids_sha256": pa.array(digests, pa.string()),
    }
    if tokens is not None:
        decoded = [hashlib.sha256(tokens.join(v)).hexdigest() for v in values[1:]]
        told["decoded_sha256"] = pa.array(decoded, pa.string())
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    told["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values), pa.int32()))
    hand_back()
    return pa.table(told)


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text_column: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, ids`` of every row; the digest is of little-endian unsigned 32-bit ids.

    With ``decoded`` the ids are joined with the token-byte table where they are
    put together, and ``decoded_sha256`` tells what they decode to.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # a fixed vocabulary of about 1 MB
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    cut = source.mapInArrow(lean(lambda batches: _cut(batches, pattern, buckets)), PIECES)
    pieces = bucketed(cut, "chunk", "bpe-pieces")
    words = (
        pieces.filter(F.col("bucket").isNotNull())
        .select("chunk", "bucket", "steps", "sizes", "words")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(lean(lambda batches: _encode_buckets(batches, shared.value)), ENCODED)
    )
    rows = pieces.filter(F.col("places").isNotNull()).select("chunk", "doc_id", "places")
    both = rows.groupBy("chunk").cogroup(words.groupBy("part"))
    tokens = spark.sparkContext.broadcast(TokenBytes(ranks) if decoded else None)  # a fixed vocabulary of about 1 MB

    def assemble(docs: pa.Table, words: pa.Table) -> pa.Table:
        return _assemble(docs, words, tokens.value)

    more = "decoded_sha256 string, " if decoded else ""
    return both.applyInArrow(assemble, f"doc_id long, n_tokens long, ids_sha256 string, {more}ids array<int>")


class TokenBytes:
    """The token-byte table by id: all bytes in one array, with the start and the length of each id's."""

    def __init__(self, ranks: dict[bytes, int]):
        top = max(ranks.values(), default=-1) + 1
        words = [b""] * top
        self.known = np.zeros(top, bool)
        for word, i in ranks.items():
            words[i], self.known[i] = word, True
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.content = np.frombuffer(b"".join(words), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        """The bytes of a row of ids, in their order."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.known) and self.known[ids].all()):
            raise ValueError("an id is not in the token-byte table")
        n = self.sizes[ids]
        ends = np.cumsum(n)
        at = np.arange(n.sum()) + np.repeat(self.starts[ids] - ends + n, n)
        return self.content[at].tobytes()


def decode(
    encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", digest: bool = False, keep_ids: bool = False
) -> DataFrame:
    """The rows (without their ids unless ``keep_ids``) with ``decoded`` (or ``decoded_sha256``): the bytes the ids stand for.

    Null and empty ids decode to no bytes.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(TokenBytes(ranks))  # a fixed vocabulary of about 1 MB
    name, kind = ("decoded_sha256", pa.string()) if digest else ("decoded", pa.binary())
    kept = [c for c in encoded.columns if c not in (ids, name)]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            out = []
            for row in batch.column(batch.num_columns - 1):
                found = tokens.join(np.zeros(0, np.int64) if row.values is None else row.values.to_numpy().astype(np.int64))
                out.append(hashlib.sha256(found).hexdigest() if digest else found)
            columns = batch.columns if keep_ids else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], [*batch.schema.names[: len(columns)], name])

    rows = encoded.select(*kept, ids)
    shape = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if keep_ids or f.name != ids]
    return rows.mapInArrow(lean(joined), ", ".join([*shape, f"{name} {'string' if digest else 'binary'}"]))


def query(spark: SparkSession, folder: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode(table(spark, folder, "documents"), ranks, decoded=True).drop("ids")
