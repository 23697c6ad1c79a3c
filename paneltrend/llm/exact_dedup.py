"""Exact deduplication with a stateful stream.

Arrivals (digest, stable identifier, content locator) are appended to a log in
the shared folder.  A stream over the log keeps one state row per digest on
disk (RocksDB), without watermark and so without expiry: the identifier that
stays, the locator of its content and the size of the group.  Only digests
that were hit again have their whole texts compared, byte for byte; texts that
share a digest without being equal are told apart there.

Defined results: null text is the empty text; a repeated row counts once per
row; of rows with equal text and equal identifier all carry ``kept`` (they are
one document); a null identifier loses to any other; columns beyond the
identifier and the text are ignored or, in ``keep_one``, passed through; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltrend.llm.common import new_folder, settled, table, unused, whole_text

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVAL = "digest string, id long, locator string"
#: Parts that the rows of one digest are compared in.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class StreamingDedup:
    """Deduplication whose state outlives a run: ``add`` may be called again with new documents.

    ``folder`` must be shared by all executors.  ``digest`` maps the text
    column to a string; results don't depend on it being free of collisions.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str | None = None,
        id_column: str = "doc_id",
        text_column: str = "text",
        digest: Callable[[Column], Column] = sha256,
    ):
        self.spark = spark
        self.folder = folder or new_folder(spark, "exact-dedup")
        self.id, self.text, self.digest = id_column, text_column, digest

    def _arrivals(self, docs: DataFrame) -> DataFrame:
        text = whole_text(self.text)
        return docs.select(
            self.digest(text).alias("digest"),
            F.col(self.id).cast("long").alias("id"),
            F.concat_ws("#", F.input_file_name(), F.col(self.id).cast("string")).alias("locator"),
        )

    def add(self, docs: DataFrame) -> "StreamingDedup":
        """Log the documents and run the stream over what is new in the log."""
        log = f"{self.folder}/arrivals"
        self._arrivals(docs).write.mode("append").parquet(log)
        partitions = self.spark.conf.get("spark.sql.shuffle.partitions")
        with _settings(
            self.spark,
            {
                "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                # many small stores: take disk as it is written instead of ahead
                "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
                "spark.sql.streaming.minBatchesToRetain": "2",
                "spark.sql.shuffle.partitions": partitions,
            },
        ):
            state = (
                self.spark.readStream.schema(ARRIVAL)
                .parquet(log)
                .groupBy("digest")
                .agg(
                    F.max(F.struct("id", "locator")).alias("content"),
                    F.count("*").alias("group_size"),
                )
            )
            run = (
                state.writeStream.outputMode("update")
                .format("noop")
                .option("checkpointLocation", f"{self.folder}/stream")
                .trigger(availableNow=True)
                .start()
            )
            run.awaitTermination()
        return self

    def state(self) -> DataFrame:
        """``digest, keep_id, locator, group_size`` as the state store holds them."""
        held = self.spark.read.format("statestore").load(f"{self.folder}/stream")
        names = [f.name for f in held.schema["value"].dataType.fields]
        content, size = (F.col("value").getField(n) for n in names)
        return held.select(
            F.col("key.digest").alias("digest"),
            content.getField("id").alias("keep_id"),
            content.getField("locator").alias("locator"),
            size.alias("group_size"),
        )

    def unequal(self, docs: DataFrame) -> DataFrame:
        """Digests whose texts are not all the same bytes.

        The least and the greatest text of each digest are compared; the rows
        of a digest are spread over salts and both texts are taken there first,
        so a group of any size costs no task more than its share.
        """
        text = whole_text(self.text)
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        hits = self.state().filter("group_size > 1").select("digest", salts)
        told = docs.select(
            self.digest(text).alias("digest"),
            F.pmod(F.xxhash64(F.col(self.id)), F.lit(SALTS)).cast("int").alias("salt"),
            text.cast("binary").alias("content"),
        )
        return (
            told.join(hits, ["digest", "salt"], "left_semi")
            .groupBy("digest")
            .agg(F.min("content").alias("low"), F.max("content").alias("high"))
            .filter("low <> high")
            .select("digest")
        )

    def _held(self, docs: DataFrame) -> tuple[DataFrame, bool]:
        """The groups ``_d, _keep, _size``, and whether some unequal texts share a digest: those groups have their text, ``_t``."""
        text = whole_text(self.text)
        held = self.state().select(
            F.col("digest").alias("_d"), F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size")
        )
        clashing = settled(self.unequal(docs)).select(F.col("digest").alias("_c"))
        if clashing.isEmpty():
            return held, False
        apart = (
            docs.withColumn("_digest", self.digest(text))
            .join(clashing, F.col("_digest") == F.col("_c"), "left_semi")
            .groupBy(F.col("_digest").alias("_d"), text.alias("_t"))
            .agg(F.max(F.col(self.id).cast("long")).alias("_keep"), F.count("*").alias("_size"))
        )
        plain = held.join(clashing, F.col("_d") == F.col("_c"), "left_anti").withColumn("_t", F.lit(None).cast("string"))
        return plain.unionByName(apart), True

    def groups(self, docs: DataFrame) -> DataFrame:
        """Identifier and text of each row of ``docs`` (all that were added) with ``_digest``, ``_keep`` and ``_size``."""
        docs = docs.select(self.id, self.text)
        held, clash = self._held(docs)
        same = F.col("_digest") == F.col("_d")
        if clash:
            same &= F.col("_t").isNull() | (F.col("_t") == whole_text(self.text))
        return docs.withColumn("_digest", self.digest(whole_text(self.text))).join(held, same)

    def kept(self, docs: DataFrame) -> DataFrame:
        """The rows that stay, one of each identifier and text.

        Each row is shuffled once, by digest and identifier together, so copies
        spread over the tasks; the grouping that drops repeated rows reads the
        join's partitions as they lie.
        """
        held, clash = self._held(docs.select(self.id, self.text))
        place, stay, own = (unused(n, docs.columns) for n in ("_place", "_stay", "_own"))

        def key(digest: Column, identifier: Column) -> Column:
            return F.concat_ws("#", F.coalesce(identifier.cast("long").cast("string"), F.lit("-")), digest)

        staying = held.select(key(F.col("_d"), F.col("_keep")).alias(stay), *([F.col("_t").alias(own)] if clash else []))
        rows = docs.withColumn(place, key(self.digest(whole_text(self.text)), F.col(self.id)))
        same = F.col(place) == F.col(stay)
        if clash:
            same &= F.col(own).isNull() | (F.col(own) == whole_text(self.text))
        one = [place, *([own] if clash else [])]
        return rows.join(staying, same).dropDuplicates(one).select(*docs.columns)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, dropped ones too."""
    dedup = StreamingDedup(docs.sparkSession, None, id_column, text_column)
    found = dedup.add(docs).groups(docs)
    return found.select(
        F.col(id_column),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col(id_column).cast("long").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns and one row for each.

    Rows that repeat both identifier and text are one document.
    """
    return StreamingDedup(docs.sparkSession, None, id_column, text_column).add(docs).kept(docs)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
