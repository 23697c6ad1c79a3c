"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local threads and
``BENCH_RUNS`` the timed runs per query (median, after one warm-up).  A run
builds the plan and writes every row to Spark's no-op sink.  A bundle entry
builds and writes all tables of a bundle once over pinned shared tables;
``BENCH_LOOSE=1`` adds the same without pinning.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = (
    "rolling_7",
    "rolling_explode",
    "rolling_raw_events",
    "latest_per_key",
    "hospital_derive",
    "age_bands",
    "compare_7",
    "compare_latest",
    "period_table_7",
    "change_since_grid",
    "vacc_change_grid",
    "criteria_14",
    "snapshot_region_vacc",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("paneltrend-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_out(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def whole_bundle(spark: SparkSession, kind: str, pinned: bool) -> None:
    from checks.queries import AS_OF, PLACES, SITES
    from paneltrend import base_bundle, export_bundle, hub_bundle, snapshot_bundle
    from paneltrend.sources import TpchPanels

    panels = TpchPanels(spark, FOLDER)
    base = base_bundle(panels.inputs)
    if kind == "hub":
        tables = hub_bundle(base, panels.dimensions, SITES, as_of=AS_OF)
    else:
        tables = snapshot_bundle(base, PLACES, as_of=AS_OF)
    try:
        if pinned:
            needed = ("cdtHospData", "cdtHosp7DayRollingData", "cdtHosp14DayRollingData")
            base.pin(*(base.shared if kind == "hub" else needed))
            tables.pin()
        export_bundle(tables, "/unused", "noop")
    finally:
        tables.release()
        base.release()


def main() -> None:
    from checks.queries import registered

    spark = session()
    queries = registered()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        runs = [timed(lambda: write_out(queries[name](spark, FOLDER))) for _ in range(RUNS + 1)]
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
    seconds["hub_bundle_pinned"] = round(timed(lambda: whole_bundle(spark, "hub", True)), 3)
    seconds["snapshot_bundle_pinned"] = round(timed(lambda: whole_bundle(spark, "snapshot", True)), 3)
    if os.environ.get("BENCH_LOOSE"):
        seconds["hub_bundle_loose"] = round(timed(lambda: whole_bundle(spark, "hub", False)), 3)
    spark.stop()

    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
