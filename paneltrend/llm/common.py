"""Helpers shared by the operators: checkpoints, text columns, folds."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch that a Python worker gets; Spark's own bound is eight times that.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a context, wherever they run; small Arrow batches for them."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(context, "_paneltrend_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "paneltrend.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._paneltrend_shipped = True


def hand_back() -> None:
    """Give freed memory back to the system: Spark keeps Python workers for later stages, with what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(made: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` after which the worker holds no more than it has to."""

    def run(*given, **named) -> Iterator[pa.RecordBatch]:
        yield from made(*given, **named)
        hand_back()

    return run


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which all executors share.

    Where none is set, a session within one process gets a temporary folder;
    on a cluster that would be some machine's own, so it is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it (names don't tell cases apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold_of(name: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % folds, F.lit(0))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucketed(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` written once to the shared folder in buckets by ``column``.

    A later grouping or join by that column reads the buckets without a
    shuffle.  There are as many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    held = "llm_" + path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(held)
    return spark.table(held)
