"""Run registered queries next to their SQL and report differences."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type name -> DuckDB type name.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def differences(
    result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str, ordered: bool = False
) -> list[str]:
    """What differs between a Spark result and a statement (empty when equal).

    With ``ordered`` the columns must also come in the same order.
    """
    relation = db.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    actual_types = {n: TYPES.get(t, t) for n, t in result.dtypes}
    found = []
    for name in sorted(set(expected_types) | set(actual_types)):
        if expected_types.get(name) != actual_types.get(name):
            found.append(f"{name}: {actual_types.get(name)} against {expected_types.get(name)}")
    if found:
        return found
    if ordered and result.columns != relation.columns:
        return [f"columns in the order {result.columns} against {relation.columns}"]
    names = sorted(actual_types)
    actual = Counter(_key(row[n] for n in names) for row in result.select(*_quoted(names)).collect())
    order = [relation.columns.index(n) for n in names]
    expected = Counter(_key(row[i] for i in order) for row in relation.fetchall())
    extra, missing = actual - expected, expected - actual
    if extra or missing:
        found.append(
            f"{sum(actual.values())} rows against {sum(expected.values())}; "
            f"{sum(extra.values())} unexpected, {sum(missing.values())} missing"
        )
        found += [f"unexpected {dict(zip(names, r))}" for r in list(extra)[:2]]
        found += [f"missing {dict(zip(names, r))}" for r in list(missing)[:2]]
    return found


def _quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _key(values) -> tuple:
    return tuple(
        "NaN" if isinstance(v, float) and math.isnan(v) else v for v in values
    )
