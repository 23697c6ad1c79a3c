"""Wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def stack(
    df: DataFrame, keep: Sequence[str], rows: Sequence[Mapping[str, Column | str]]
) -> DataFrame:
    """One output row per input row and entry of ``rows``, after ``keep`` columns.

    Values are columns or SQL text.
    """
    structs = [
        F.struct(
            *[
                F.expr(f"{value} as `{name}`") if isinstance(value, str) else value.alias(name)
                for name, value in row.items()
            ]
        )
        for row in rows
    ]
    return df.select(*keep, F.inline(F.array(*structs)))


def common_number(df: DataFrame, columns: Sequence[str]) -> str:
    """Type a stacked value column takes: whole only if all sources are whole."""
    whole = all(isinstance(df.schema[c].dataType, _WHOLE) for c in columns)
    return "bigint" if whole else "double"
