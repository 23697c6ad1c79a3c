from __future__ import annotations

import datetime as dt
import json
from collections import Counter

import pytest
from conftest import day, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paneltrend.functions import local_time, utc_instant
from paneltrend.sources import (
    VersionConflict,
    dimension_paths,
    dimension_versions,
    export_bundle,
    latest_dimensions,
    read_bundle,
    read_dimensions,
    read_panel,
    refresh_dimensions,
    rejected_rows,
    split_panel,
)


def test_csv_round_trip(spark, tmp_path):
    rows = [("x", None, dt.date(2021, 3, 1)), ("", 2, None), ('a,"b"', 3, dt.date(2021, 3, 2))]
    table = spark.createDataFrame(rows, "name string, n int, d date")
    export_bundle({"t": table}, str(tmp_path))
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*.csv")))
    assert "name,n,d" in text and 'x,,2021-03-01' in text
    back = spark.read.csv(str(tmp_path / "t"), header=True, schema="name string, n int, d date", escape="\\")
    assert rows_of(back, "n", "d") == rows_of(table, "n", "d")


def test_export_replaces_only_its_own_tables(spark, tmp_path):
    export_bundle({"a": spark.range(3), "b": spark.range(2)}, str(tmp_path), "parquet")
    export_bundle({"a": spark.range(1)}, str(tmp_path), "parquet", single_file=True)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1
    assert spark.read.parquet(str(tmp_path / "b")).count() == 2
    with pytest.raises(ValueError):
        export_bundle({"a": spark.range(1)}, str(tmp_path), "xlsx")


def landed_json(folder, records):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records))
    return str(folder)


def report(key, date, **values):
    return {"Jurisdiction": f"J{key}", "Region": "R", "State": "S", "GeoID": key, "Date": date, **values}


def test_json_panel(spark, tmp_path):
    path = landed_json(
        tmp_path / "cdt",
        [
            report("a", "2021-03-01T00:00:00", CasesNew=5, LastUpdated="2021-03-01T18:00:00"),
            report("a", "2021-03-02", CasesNew=None, LastUpdated="2021-03-02T18:00:00Z"),
            report(None, "2021-03-02", CasesNew=1),
            report("a", None, CasesNew=1),
        ],
    )
    df = read_panel(spark, "CDT", path, "json")
    types = dict(df.dtypes)
    assert (types["Date"], types["LastUpdated"], types["CasesNew"]) == ("date", "timestamp", "bigint")
    assert rows_of(df, "GeoID", "Date", "CasesNew") == [("a", day(0), 5), ("a", day(1), None)]
    local = df.select(local_time(F.col("LastUpdated")).cast("string").alias("t"))
    assert rows_of(local, "t") == [("2021-03-01 12:00:00",), ("2021-03-02 12:00:00",)]


def test_zoneless_instants_are_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([("2021-07-01T12:00:00",), ("2021-07-01T12:00:00+02:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = [r[0] for r in df.select(F.unix_timestamp(utc_instant(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    noon = int(dt.datetime(2021, 7, 1, 12, tzinfo=dt.timezone.utc).timestamp())
    assert got == [noon, noon - 7200]


def test_csv_panel_goes_by_header_names(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "Date,GeoID,BedsUsed,Jurisdiction,Region,State,HospitalsReporting\n"
        "2021-03-01,a,7,Ja,R,S,3\n2021-03-02,a,,Ja,R,S,4\n"
    )
    df = read_panel(
        spark, "Hospital", str(tmp_path / "h.csv"), "csv", required=("BedsUsed", "HospitalsReporting")
    )
    assert rows_of(df, "Date", "BedsUsed", "HospitalsReporting") == [(day(0), 7, 3), (day(1), None, 4)]
    assert "LastUpdated" not in df.columns


def test_unknown_names_are_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        read_panel(spark, "Weather", str(tmp_path))
    with pytest.raises(ValueError):
        read_panel(spark, "CDT", str(tmp_path), "xlsx")


def test_bundle_cuts_case_and_hospital_data_only(spark, tmp_path):
    records = [report("a", "2021-03-01"), report("z", "2021-03-01")]
    names = ("CDT", "CDT_NewlyReported", "Hospital", "Vaccination", "VaccinationCDC")
    paths = {n: landed_json(tmp_path / n, records) for n in names}
    sets = spark.createDataFrame([("base", "a")], "set_name string, GeoID string")
    bundle = read_bundle(spark, paths, sets, "json")
    counts = {name: df.count() for name, df in bundle.items()}
    assert counts == {"cdtData": 1, "cdtNRData": 1, "hospData": 1, "vaccData": 2, "vaccCDCData": 2}


def test_bundle_rejects_repeated_days(spark, tmp_path):
    path = landed_json(tmp_path / "twice", [report("a", "2021-03-01"), report("a", "2021-03-01T09:00:00")])
    names = ("CDT", "CDT_NewlyReported", "Hospital", "Vaccination", "VaccinationCDC")
    sets = spark.createDataFrame([("base", "a")], "set_name string, GeoID string")
    bundle = read_bundle(spark, dict.fromkeys(names, path), sets, "json")
    with pytest.raises(PySparkException, match="CDT: several rows for a on 2021-03-01"):
        bundle["cdtData"].count()
    loose = read_bundle(spark, dict.fromkeys(names, path), sets, "json", check_days=False)
    assert loose["cdtData"].count() == 2
    # keys outside the set don't count
    none = spark.createDataFrame([("base", "z")], "set_name string, GeoID string")
    assert read_bundle(spark, dict.fromkeys(names, path), none, "json")["cdtData"].count() == 0


BAD_JSON = [
    '{"GeoID": "a", "Date": "2021-03-01", "CasesNew": 5.0, "DeathsNew": "12", "note": "x"}',
    '{"GeoID": "a", "Date": "2021-03-02", "CasesNew": "abc"}',
    '{"GeoID": "a", "Date": "2021-03-03", "CasesNew": 5.5}',
    '{"GeoID": "a", "Date": "2021-03-04", "CasesNew": 1',
    '{"GeoID": null, "Date": "2021-03-05", "CasesNew": 1}',
    '{"GeoID": "a", "Date": "soon", "CasesNew": 1}',
    '{"GeoID": "a", "Date": "2021-03-06", "CasesNew": 99999999999999999999}',
    '{"GeoID": "a", "Date": "2021-03-07", "LastUpdated": "2021-03-07"}',
    '{"GeoID": "a", "Date": "2021-03-08", "LastUpdated": "yesterday"}',
]
BAD_CSV = [
    "GeoID,Date,CasesNew,DeathsNew,note",
    "a,2021-03-01,5.0,12,x",
    "a,2021-03-02,abc,,",
    "a,2021-03-03,5.5,,",
    "a,2021-03-04,1,2,3,4,5",
    ",2021-03-05,1,,",
    "a,soon,1,,",
    "a,2021-03-06,99999999999999999999,,",
]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_no_record_is_lost_silently(spark, tmp_path, fmt):
    lines = BAD_JSON if fmt == "json" else BAD_CSV
    (tmp_path / f"x.{fmt}").write_text("\n".join(lines) + "\n")
    given = dict(path=str(tmp_path / f"x.{fmt}"), fmt=fmt, required=("CasesNew", "DeathsNew"), keep=("note",))
    good = read_panel(spark, "CDT", on_bad="reject", **given)
    first = rows_of(good, "GeoID", "Date", "CasesNew", "DeathsNew", "note")[0]
    assert first == ("a", day(0), 5, 12, "x")
    rejects = Counter(r["reason"] for r in rejected_rows(spark, "CDT", **given).collect())
    want = Counter({"bad CasesNew": 3, "malformed record": 1, "no key or date": 1, "bad Date": 1})
    if fmt == "json":
        want["bad LastUpdated"] = 1
    assert rejects == want
    assert good.count() + sum(want.values()) == len(lines) - (fmt == "csv")
    with pytest.raises(PySparkException, match="CDT: (bad|malformed)"):
        read_panel(spark, "CDT", **given).collect()


def test_lacking_and_unknown_columns_are_named(spark, tmp_path):
    (tmp_path / "x.csv").write_text("GeoID,Date,CasesNw\na,2021-03-01,1\n")
    path = str(tmp_path / "x.csv")
    with pytest.raises(ValueError, match="no column CasesNew"):
        read_panel(spark, "CDT", path, "csv", required=("CasesNew",))
    with pytest.raises(ValueError, match="unknown column CasesNw"):
        read_panel(spark, "CDT", path, "csv", required=())
    spark.createDataFrame([("a", day(0), 1.0)], "GeoID string, Date date, CasesNew double").write.parquet(
        str(tmp_path / "p")
    )
    with pytest.raises(ValueError, match="no column .*DeathsNew"):
        read_panel(spark, "CDT", str(tmp_path / "p"))
    df = read_panel(spark, "CDT", str(tmp_path / "p"), required=("CasesNew",))
    assert rows_of(df, "Date", "CasesNew") == [(day(0), 1)]


def test_dates_alone_are_instants(spark):
    df = spark.createDataFrame([("2021-07-01",), ("2021-07-01T00:00:00Z",), ("soon",)], "t string")
    got = [r[0] for r in df.select(F.unix_timestamp(utc_instant(F.col("t")))).collect()]
    assert got[0] == got[1] and got[2] is None


def test_single_file_and_sorted_output(spark, tmp_path):
    table = spark.range(100, numPartitions=5).select((-F.col("id")).alias("n"))
    export_bundle({"t": table}, str(tmp_path), "csv", single_file=True, sort_by={"t": ["n"]})
    (part,) = (tmp_path / "t").glob("part-*.csv")
    assert [int(x) for x in part.read_text().split()[1:]] == list(range(-99, 1))
    export_bundle({"t": table}, str(tmp_path), "parquet", sort_by={"t": ["n"]})
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "t")).collect()] == list(range(-99, 1))
    with pytest.raises(ValueError):
        export_bundle({"t": table}, str(tmp_path), sort_by={"u": ["n"]})


def test_dimensions_refresh_and_read(spark, tmp_path):
    upstream = spark.createDataFrame(
        [("Ja", "R", "S", "a", 10, "x")],
        "Jurisdiction string, Region string, State string, GeoID string, Population int, note string",
    )
    sets = spark.createDataFrame([("base", "a")], "set_name string, GeoID string")
    pretty = spark.createDataFrame(
        [("A", "a", "Aa", 1)], "Site string, GeoID string, NiceName string, DisplayOrder int"
    )
    refresh_dimensions(upstream.withColumn("Population", F.lit(9)), str(tmp_path), sets, pretty)
    paths = refresh_dimensions(upstream, str(tmp_path), sets, pretty)
    assert latest_dimensions(spark, str(tmp_path)) == paths
    dims = read_dimensions(spark, paths)
    assert dims.places.columns == ["Jurisdiction", "Region", "State", "GeoID"]
    assert rows_of(dims.population, "GeoID", "Population") == [("a", 10)]
    assert (dims.key_sets.count(), dims.pretty.count()) == (1, 1)
    # a version that was not finished is not in force
    upstream.write.parquet(f"{tmp_path}/version=unfinished/pop")
    assert latest_dimensions(spark, str(tmp_path)) == paths


def hospital_files(spark, folder):
    """Typed Parquet of all hospital columns, but for one that is stored as text."""
    from paneltrend.sources.schemas import HOSPITAL_MEASURES

    rows = spark.range(60).select(
        *(F.lit("x").alias(c) for c in ("Jurisdiction", "State", "Region")),
        F.concat(F.lit("k"), F.col("id") % 3).alias("GeoID"),
        F.date_add(F.lit(day(0)), (F.col("id") / 3).cast("int")).alias("Date"),
        *(F.col("id").alias(m) for m in HOSPITAL_MEASURES if m != "BedsUsed"),
        F.when(F.col("id") == 7, "many").otherwise(F.col("id").cast("string")).alias("BedsUsed"),
    )
    rows.write.parquet(folder)
    return folder


def test_a_plan_reads_and_checks_its_own_columns(spark, tmp_path):
    path = hospital_files(spark, str(tmp_path / "h"))
    panel = read_panel(spark, "Hospital", path)
    assert len(panel.columns) == 26
    few = panel.select("GeoID", "Date", "BedsTotal").where(F.col("Date") >= F.lit(day(5)))
    plan = few._jdf.queryExecution().executedPlan().toString()
    (read,) = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line}
    assert read.startswith("struct<GeoID:string,Date:date,BedsTotal:bigint>")
    assert "GreaterThanOrEqual(Date,2021-03-06)" in plan
    # the bad value is in a column that this plan doesn't use
    assert few.count() == 45
    with pytest.raises(PySparkException, match="Hospital: bad BedsUsed in many"):
        panel.select("GeoID", "BedsUsed").collect()
    (bad,) = rejected_rows(spark, "Hospital", path).collect()
    assert bad["reason"] == "bad BedsUsed" and '"BedsUsed":"many"' in bad["record"]
    # a rejected row is left out whatever the plan uses
    good = read_panel(spark, "Hospital", path, on_bad="reject")
    assert good.select("GeoID", "Date", "BedsTotal").count() == good.count() == 59


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_panel_rejects_and_counts_from_one_read(spark, tmp_path, fmt):
    lines = BAD_JSON if fmt == "json" else BAD_CSV
    (tmp_path / f"x.{fmt}").write_text("\n".join(lines) + "\n")
    given = dict(path=str(tmp_path / f"x.{fmt}"), fmt=fmt, required=("CasesNew", "DeathsNew"), keep=("note",))
    split = split_panel(spark, "CDT", folder=str(tmp_path / "out"), **given)
    panel = split.panel(spark)
    want = read_panel(spark, "CDT", on_bad="reject", **given)
    assert dict(panel.dtypes) == dict(want.dtypes)
    assert rows_of(panel, *want.columns) == rows_of(want, *want.columns)
    rejects = Counter((r["reason"], r["record"]) for r in split.rejects(spark).collect())
    assert rejects == Counter((r["reason"], r["record"]) for r in rejected_rows(spark, "CDT", **given).collect())
    reasons = Counter(reason for reason, _ in rejects.elements())
    assert split.counts == {"": panel.count(), **reasons}


def test_a_panel_without_rejects_or_rows(spark, tmp_path):
    path = landed_json(tmp_path / "cdt", [report("a", "2021-03-01", CasesNew=1)])
    split = split_panel(spark, "CDT", path, str(tmp_path / "out"), "json")
    assert split.counts == {"": 1} and split.rejects(spark).count() == 0
    nothing = landed_json(tmp_path / "none", [])
    split = split_panel(spark, "CDT", nothing, str(tmp_path / "out2"), "json")
    assert split.counts == {"": 0} and split.panel(spark).count() == 0
    assert split.panel(spark).columns == read_panel(spark, "CDT", nothing, "json").columns


@pytest.fixture
def upstream(spark):
    schema = "Jurisdiction string, Region string, State string, GeoID string, Population int"
    return lambda n: spark.createDataFrame([("Ja", "R", "S", "a", n)], schema)


def populations(spark, paths):
    return [r["Population"] for r in read_dimensions(spark, paths).population.collect()]


def test_versions_are_whole(spark, tmp_path, upstream):
    folder = str(tmp_path / "dims")
    sets = spark.createDataFrame([("base", "a")], "set_name string, GeoID string")
    pretty = spark.createDataFrame([("A", "a", "Aa", 1)], "Site string, GeoID string, NiceName string, DisplayOrder int")
    assert dimension_versions(spark, folder) == []
    with pytest.raises(ValueError, match="no version 0"):
        latest_dimensions(spark, folder)
    first = refresh_dimensions(upstream(1), folder, sets, pretty, follows=0)
    second = refresh_dimensions(upstream(2), folder)
    # tables that were not given are those of the version before
    assert second["key_sets"] == first["key_sets"] and second["pop"] != first["pop"]
    assert latest_dimensions(spark, folder) == second
    assert dimension_versions(spark, folder) == [1, 2]
    # an old version can be read
    assert dimension_paths(spark, folder, 1) == first
    assert populations(spark, dimension_paths(spark, folder, 1)) == [1]
    with pytest.raises(VersionConflict, match="version 2 is there, not 1"):
        refresh_dimensions(upstream(3), folder, follows=1)
    assert latest_dimensions(spark, folder) == second


def test_concurrent_refreshes_do_not_mix(spark, tmp_path, upstream, monkeypatch):
    from paneltrend.sources import landed

    folder, create, others = str(tmp_path / "dims"), landed._create, [12, 11]

    def interrupted(session, path, text):
        if others:  # another refresh commits first, twice
            n = others.pop()
            monkeypatch.setattr(landed, "_create", create)
            refresh_dimensions(upstream(n), folder, spark.createDataFrame([("s", f"k{n}")], "set_name string, GeoID string"))
            monkeypatch.setattr(landed, "_create", interrupted)
        return create(session, path, text)

    monkeypatch.setattr(landed, "_create", interrupted)
    mine = refresh_dimensions(upstream(9), folder)
    assert dimension_versions(spark, folder) == [1, 2, 3]
    versions = [dimension_paths(spark, folder, n) for n in (1, 2, 3)]
    assert versions[2] == mine == latest_dimensions(spark, folder)
    # each version has places and people of one refresh
    assert all(v["juris"].rsplit("/", 1)[0] == v["pop"].rsplit("/", 1)[0] for v in versions)
    assert len({v["pop"] for v in versions}) == 3
    assert mine["key_sets"] == versions[1]["key_sets"]
    assert not list((tmp_path / "dims" / "versions").glob("*.tmp"))


def test_simultaneous_refreshes_each_get_a_version(spark, tmp_path, upstream):
    from concurrent.futures import ThreadPoolExecutor

    folder = str(tmp_path / "dims")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: refresh_dimensions(upstream(n), folder), range(4)))
    versions = dimension_versions(spark, folder)
    assert versions == list(range(1, len(versions) + 1))
    assert all(len(dimension_paths(spark, folder, n)) == 2 for n in versions)
