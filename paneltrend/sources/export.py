"""Writing a named set of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

FORMATS = ("csv", "parquet", "orc", "json", "noop")


def export_bundle(
    tables: Mapping[str, DataFrame],
    folder: str,
    fmt: str = "csv",
    single_file: bool = False,
    at_once: int = 4,
    sort_by: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Write each table to ``folder/{name}``, replacing that table only.

    CSV has a header and empty fields for NULL.  Each task writes its own
    part; ``single_file`` gathers a (small) table into one, which only the
    write itself does in one task.  ``sort_by`` names columns that a table's
    output is sorted by.  Most tables are small next to a cluster, so
    ``at_once`` of them are written side by side.
    """
    order = sort_by or {}
    unknown = sorted(set(order) - set(tables))
    if unknown:
        raise ValueError(f"no such tables to sort: {', '.join(unknown)}")
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")

    def arranged(name: str) -> DataFrame:
        table, columns = tables[name], list(order.get(name, ()))
        if single_file:
            table = table.repartition(1)
            return table.sortWithinPartitions(*columns) if columns else table
        return table.orderBy(*columns) if columns else table

    def write(table: DataFrame, target: str) -> str:
        writer = table.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True).option("nullValue", "")
        writer.format(fmt).save(target)
        return target

    # Plans are built here, in order; only the writes run side by side.
    built = [(arranged(name), f"{folder}/{name}") for name in tables]
    if not built:
        return []
    in_session = inheritable_thread_target(built[0][0].sparkSession)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        jobs = [pool.submit(in_session(write), *work) for work in built]
        return [job.result() for job in jobs]
