"""Columns derived from SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def derive(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """Add ``(name, SQL text)`` columns in order; later texts see earlier names."""
    for name, text in columns:
        df = df.withColumn(name, F.expr(text))
    return df
