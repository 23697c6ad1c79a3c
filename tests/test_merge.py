from __future__ import annotations

from conftest import day, rows_of

from paneltrend.operators import (
    dimension_drift,
    drift_counts,
    drift_report,
    has_drifted,
    in_key_set,
    lookup,
    merge_panels,
    repeated_keys,
    site_bridge,
)


def test_full_merge_coalesces_left_first(make_panel):
    left = make_panel([("a", 0, 1, 7), ("a", 1, 2, None)], ["x", "shared"])
    right = make_panel([("a", 1, 3, 9), ("b", 0, 4, 8)], ["y", "shared"])
    got = merge_panels(left, right)
    assert got.columns == ["Jurisdiction", "State", "Region", "GeoID", "Date", "x", "shared", "y"]
    assert rows_of(got, "GeoID", "Date", "x", "shared", "y", "Jurisdiction") == [
        ("a", day(0), 1, 7, None, "Ja"),
        ("a", day(1), 2, 9, 3, "Ja"),
        ("b", day(0), None, 8, 4, "Jb"),
    ]


def test_lookup_keeps_unmatched_rows(spark, make_panel):
    people = spark.createDataFrame([("a", 10)], "GeoID string, Population int")
    got = lookup(make_panel([("a", 0, 1), ("b", 0, 2)], ["x"]), people)
    assert rows_of(got, "GeoID", "Population") == [("a", 10), ("b", None)]


def test_key_set(spark, make_panel):
    sets = spark.createDataFrame([("s", "a"), ("s", "a"), ("t", "b")], "set_name string, GeoID string")
    got = in_key_set(make_panel([("a", 0, 1), ("b", 0, 2)], ["x"]), sets, "s")
    assert rows_of(got, "GeoID", "x") == [("a", 1)]


def test_site_bridge(spark):
    pretty = spark.createDataFrame([("A", "a", "Aa"), ("B", "b", "Bb")], "Site string, GeoID string, NiceName string")
    people = spark.createDataFrame([("a", 10)], "GeoID string, Population int")
    got = site_bridge(pretty, people, "A")
    assert got.columns == ["GeoID", "NiceName", "Population"]
    assert rows_of(got, *got.columns) == [("a", "Aa", 10)]


def test_repeated_keys(make_panel):
    df = make_panel([("a", 0, 1), ("a", 0, 2), ("a", 1, 3)], ["x"])
    assert rows_of(repeated_keys(df), "GeoID", "Date", "rows") == [("a", day(0), 2)]


def test_drift(spark):
    schema = "GeoID string, Population int"
    now = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    same = spark.createDataFrame([("b", 2), ("a", 1)], schema)
    changed = spark.createDataFrame([("a", 1), ("b", 3)], schema)
    extra = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], schema)
    fewer = spark.createDataFrame([("a", 1)], schema)
    assert not has_drifted(now, same)
    assert dimension_drift(now, same).count() == 0
    assert has_drifted(now, changed) and has_drifted(now, extra)
    assert rows_of(dimension_drift(now, changed), "GeoID", "Population", "n_current", "n_upstream") == [
        ("b", 2, 1, 0),
        ("b", 3, 0, 1),
    ]
    # Rows upstream dropped do not change the verdict; the listing shows them.
    assert not has_drifted(now, fewer)
    assert rows_of(dimension_drift(now, fewer), "GeoID") == [("b",)]
    assert drift_counts(now, extra).first()["n_distinct"] == 3


def test_drift_of_several_tables_has_one_verdict(spark):
    a = spark.createDataFrame([("a", 1), ("b", 2)], "GeoID string, n int")
    b = spark.createDataFrame([("a", 1), ("b", 3)], "GeoID string, n int")
    got = rows_of(drift_report({"x": (a, a), "y": (a, b)}), "dimension", "n_current", "n_distinct", "drifted", "any_drifted")
    assert got == [("x", 2, 2, False, True), ("y", 2, 3, True, True)]
    assert rows_of(drift_report({"x": (a, a)}), "any_drifted") == [(False,)]


def test_drift_is_located_by_digests(spark, monkeypatch):
    from paneltrend.operators import drift

    rows = [(f"k{i}", i % 7 if i % 5 else None) for i in range(300)]
    current = spark.createDataFrame(rows, "a string, b int").repartition(3)
    upstream = spark.createDataFrame([(a, b) if a != "k9" else (a, 99) for a, b in reversed(rows)] + [("new", None)], "a string, b int")
    got = drift.located_drift(current, upstream)
    want = drift.dimension_drift(current, upstream)
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns) and want.count() == 3
    # only the rows of differing buckets are compared
    compared = []
    monkeypatch.setattr(drift, "dimension_drift", lambda a, b: compared.append((a.count(), b.count())) or a)
    drift.located_drift(current, upstream)
    assert max(compared[0]) <= 10
    # equal tables in another order: nothing is read again
    compared.clear()
    drift.located_drift(current, current.orderBy("b").coalesce(1))
    assert compared == [(0, 0)]
    # digests of parts add up
    halves = [drift.bucket_digests(current.where(w)) for w in ("b < 3 or b is null", "b >= 3")]
    both = halves[0].unionByName(halves[1]).groupBy("bucket").sum("rows", "high", "low", "other")
    assert {tuple(r) for r in both.collect()} == {tuple(r) for r in drift.bucket_digests(current).collect()}
