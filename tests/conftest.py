from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("paneltrend-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY = dt.date(2021, 3, 1)  # a Monday


def day(offset: int) -> dt.date:
    return DAY + dt.timedelta(days=offset)


@pytest.fixture
def make_panel(spark):
    """Panel from (key, day offset or None, measures...) rows."""

    def make(rows, measures, kind="bigint"):
        schema = (
            "Jurisdiction string, State string, Region string, GeoID string, Date date"
            + "".join(f", {m} {kind}" for m in measures)
        )
        full = [
            (key and f"J{key}", "S", "R", key, None if d is None else day(d), *values)
            for key, d, *values in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


def rows_of(df, *columns):
    """Rows as tuples of ``columns``, sorted with NULLs first."""
    got = [tuple(r[c] for c in columns) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    return sorted(got, key=lambda row: [(v is not None, v) for v in row])
