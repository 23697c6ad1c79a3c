"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into segments of at most 23 bits.  Every 23-bit word lies
within 3 bits of exactly one word of the binary Golay code, and within 4 bits
of that one and five more if it is 3 away.  Two segments that differ in at most
2 bits have a midpoint within 1 bit of both, so they share the code word
nearest to it: the indices of all code words within 4 bits are keys that such
segments cannot miss.

Pigeonhole: if fingerprints differ in at most ``3 * segments - 4`` bits, the
two segments with the fewest errors have at most 2 each.  So every pair of
segments gives keys (both indices, 24 bits), and linked fingerprints share one.
Only distinct fingerprints take part, each bucket verifies its members by their
bits, and links leave a task as stars: the links that join something, never all
pairs of a group.  Buckets beyond ``SPLIT`` members are dealt in blocks over
tasks, every two blocks meeting in one.

Defined results: null text is empty; a text without words has fingerprint
zero; texts of fewer words than a shingle are one shingle; repeated rows have
one fingerprint each; rows with a null id get the component of their
fingerprint, whose name is the smallest id that is not null; an empty table
gives an empty result; other columns are ignored or, in ``keep_one``, passed
through (names that begin with an underscore included).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import lean, settled, table, unused, whole_text
from paneltrend.llm.components import connected

#: Fixed value: generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY = 0b110001110101
#: Seed of the shingle hash, fixed by the query's contract.
SEED = 42
#: Members of a bucket that one task compares; larger buckets are dealt in blocks.
SPLIT = 50_000
#: One in so many nodes is counted to find the larger buckets.
COUNTED = 64
#: Buckets up to this size are compared by shifted rows, larger ones node by node.
SMALL = 24
#: Links a task holds before it sends their stars.
SEND_LINKS = 500_000


# --- fingerprints -------------------------------------------------------------------------


def simhash(shingles: list[bytes], digest, width: int) -> bytes:
    """Bits set in over half of the shingles' hashes, repeats counted; most significant first."""
    counts = np.zeros(width, np.int64)
    for i in range(0, len(shingles), 1 << 16):
        hashes = b"".join([digest(s) for s in shingles[i : i + (1 << 16)]])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, width // 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(shingles)).tobytes()


def shingles_of(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words; the whole sequence if it is shorter, nothing if it is empty."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]


def _xxh64(shingle: bytes) -> bytes:
    return xxhash.xxh64_digest(shingle, SEED)


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return text.encode().lower().split()


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, printed, fp``: a hash of every row's text, and its 64-bit fingerprint, as signed longs."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = b"".join(simhash(shingles_of(words_of(t.as_py()), words), _xxh64, 64) for t in batch.column(2))
            fp = pa.array(np.frombuffer(prints, ">i8").astype(np.int64))
            yield pa.record_batch({"doc_id": batch.column(0), "printed": batch.column(1), "fp": fp})

    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("printed"), text.alias("text"))
    return rows.mapInArrow(lean(made), "doc_id long, printed long, fp long")


# --- Golay keys ---------------------------------------------------------------------------


@lru_cache
def _code() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of each byte of a 23-bit word; for each syndrome the changes, up to 4 bits, that give a code word."""

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << bit - 11
        return word

    of_byte = np.array([[syndrome(b << 8 * i & 0x7FFFFF) for b in range(256)] for i in range(3)], np.int64)
    changes = np.zeros((2048, 6), np.int64)
    found = np.zeros(2048, np.int64)
    for weight in range(5):
        for places in combinations(range(23), weight):
            change = sum(1 << p for p in places)
            s = syndrome(change)
            changes[s, found[s]] = change
            found[s] += 1
    return of_byte, changes, found


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word up to six code words' indices, and which of the six places are filled."""
    of_byte, changes, found = _code()
    s = of_byte[0][words & 255] ^ of_byte[1][words >> 8 & 255] ^ of_byte[2][words >> 16 & 255]
    # 12 consecutive bits of a cyclic code word tell all of it
    return (words[:, None] ^ changes[s]) >> 11, np.arange(6) < found[s][:, None]


def segment_sizes(segments: int, bits: int = 64) -> list[int]:
    return [bits // segments + (i < bits % segments) for i in range(segments)]


def golay_keys(prints: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned 64-bit fingerprints, with the row each belongs to."""
    parts, at = [], 0
    for size in segment_sizes(segments):
        parts.append(golay_indices((prints >> np.uint64(at) & np.uint64((1 << size) - 1)).astype(np.int64)))
        at += size
    rows, keys = [], []
    for n, (i, j) in enumerate(combinations(range(segments), 2)):
        (a, has_a), (b, has_b) = parts[i], parts[j]
        both = has_a[:, :, None] & has_b[:, None, :]
        keys.append((n << 24 | a[:, :, None] << 12 | b[:, None, :])[both])
        rows.append(np.nonzero(both)[0])
    return np.concatenate(rows), np.concatenate(keys)


# --- links in buckets ---------------------------------------------------------------------


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the same effect: each node of a component to the component's smallest node."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for end in (a, b):
            np.minimum.at(root, root[end], low)
        root = root[root]
        if (root == before).all():
            break
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints of one or more 64-bit words."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def _links_of_bucket(nodes: np.ndarray, codes: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A forest that joins what is linked: each node is compared with those that nothing has reached yet."""
    left = np.arange(len(nodes))
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = _apart(codes[left], codes[at]) <= most
            if near.any():
                new = left[near]
                yield np.full(len(new), nodes[at]), nodes[new]
                reached.extend(new.tolist())
                left = left[~near]


def links_in_buckets(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows ``key, node, code...`` sorted by key in, stars ``u, v`` out."""
    held: list[tuple[np.ndarray, ...]] = []
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []

    def compare(key: np.ndarray, node: np.ndarray, code: np.ndarray) -> None:
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        size = ends - starts
        for a, b in zip(starts[size > SMALL], ends[size > SMALL]):
            for u, v in _links_of_bucket(node[a:b], code[a:b], most):
                us.append(u)
                vs.append(v)
        some = np.repeat((size > 1) & (size <= SMALL), size)
        key, node, code = key[some], node[some], code[some]
        for d in range(1, SMALL):
            same = np.flatnonzero(key[d:] == key[:-d])
            if not len(same):
                break
            near = same[_apart(code[same], code[same + d]) <= most]
            us.append(node[near])
            vs.append(node[near + d])

    def send() -> Iterator[pa.RecordBatch]:
        u, v = stars(np.concatenate(us), np.concatenate(vs))
        us.clear(), vs.clear()
        if len(u):
            yield pa.record_batch({"u": pa.array(u), "v": pa.array(v)})

    last = None
    for batch in batches:
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        code = np.stack([c.to_numpy().view(np.uint64) for c in batch.columns[2:]], 1)
        if not len(key):
            continue
        if held and key[-1] == last and key[0] == last:
            held.append((key, node, code))
            continue
        held.append((key, node, code))
        key, node, code = (np.concatenate(x) for x in zip(*held))
        end = int(np.searchsorted(key, key[-1]))
        if end:
            compare(key[:end], node[:end], code[:end])
        held, last = [(key[end:], node[end:], code[end:])], key[-1]
        if sum(map(len, us)) > SEND_LINKS:
            yield from send()
    if held:
        compare(*(np.concatenate(x) for x in zip(*held)))
    if us:
        yield from send()


def linked_components(nodes: DataFrame, most: int, segments: int, split: int = SPLIT) -> DataFrame:
    """``node, root`` of nodes linked by fingerprints that share a Golay key and differ in at most ``most`` bits.

    ``nodes``: ``node, fp`` and, if the links are to be verified by other bits
    than those of ``fp``, further long columns that hold these.
    """
    spark = nodes.sparkSession
    verified = nodes.columns[2:] or ["fp"]
    shape = "key long, node long, " + ", ".join(f"{c} long" for c in verified)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                rows, keys = golay_keys(part.column(1).to_numpy().view(np.uint64), segments)
                taken = {c: pa.array(part.column(c).to_numpy()[rows]) for c in ("node", *verified)}
                yield pa.record_batch({"key": pa.array(keys), **taken})

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = nodes.repartition(tasks).mapInArrow(keyed, shape)
    # where the large buckets are is told by a part of the nodes; that decides how they are dealt, not what is found
    sample = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(COUNTED)) == 0).repartition(tasks)
    large = settled(
        sample.mapInArrow(keyed, shape)
        .groupBy("key")
        .count()
        .filter(F.col("count") * COUNTED > split)
        .select("key", F.ceil(F.col("count") * COUNTED / split).cast("int").alias("blocks"))
    )
    if not large.isEmpty():
        mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        dealt = (
            keys.join(large, "key", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .select("*", mine.alias("mine"), other)
        )
        pair = F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")
        keys = dealt.select((F.col("key") + pair.cast("long") * (1 << 32)).alias("key"), "node", *verified)
    links = (
        keys.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lean(lambda batches: links_in_buckets(batches, most)), "u long, v long")
    )
    return connected(links)


def classes_of(prints: DataFrame, best: Column, max_bits: int) -> DataFrame:
    """``fp, best`` for each fingerprint: the least ``best`` (an aggregate of rows) over its component."""
    classes = settled(prints.groupBy("fp").agg(best.alias("own")))
    segments = max(3, -(-(max_bits + 4) // 3))
    roots = linked_components(classes.select(F.col("fp").alias("node"), "fp"), max_bits, segments)
    members = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "own", F.coalesce("root", "fp").alias("root")
    )
    least = members.groupBy("root").agg(F.min("own").alias("best"))
    return members.join(least, "root").select("fp", "best")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; fingerprints that differ in at most ``max_bits`` bits are linked."""
    prints = settled(fingerprints(docs, words)).select("doc_id", "fp")
    found = classes_of(prints, F.min("doc_id"), max_bits)
    return prints.join(found.withColumnRenamed("best", "component_id"), "fp")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without those that another one of their component, with a smaller id, stands for.

    Rows that repeat an identifier and a text are one document; of an
    identifier with several texts in a component one text stays; a null
    identifier loses to any other.
    """
    prints = settled(fingerprints(docs, words, id_column, text_column))
    gone_id, gone_text = unused("_gone", docs.columns), unused("_printed", docs.columns)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "printed")
    gone = (
        prints.join(classes_of(prints, F.min(row), max_bits), "fp")
        .filter(row != F.col("best"))
        .select(F.col("doc_id").alias(gone_id), F.col("printed").alias(gone_text))
        .distinct()
    )
    own = F.col(id_column).cast("long").eqNullSafe(F.col(gone_id)) & (F.xxhash64(whole_text(text_column)) == F.col(gone_text))
    return docs.join(settled(gone), own, "left_anti")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
