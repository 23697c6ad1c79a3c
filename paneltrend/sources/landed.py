"""Readers for landed daily reports and dimension tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import utc_instant
from ..operators.derive import drop_unkeyed
from ..operators.merge import in_key_set
from .schemas import DIMENSIONS, PANELS

FORMATS = ("parquet", "json", "csv", "orc")

# Bundle name of each input and whether it is cut to the base
# key set (vaccination tables keep places outside it).
INPUTS = {
    "cdtData": ("CDT", True),
    "cdtNRData": ("CDT_NewlyReported", True),
    "hospData": ("Hospital", True),
    "vaccData": ("Vaccination", False),
    "vaccCDCData": ("VaccinationCDC", False),
}


# Columns every report must have.
REPORT_KEYS = ("GeoID", "Date")
CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables the bundles look things up in."""

    population: DataFrame
    key_sets: DataFrame
    pretty: DataFrame
    places: DataFrame | None = None


def conform(df: DataFrame) -> DataFrame:
    """Type dates and instants and drop rows that belong to no key or day.

    A zone-less ``LastUpdated`` is UTC.  It stays an instant; use
    :func:`paneltrend.functions.local_time` to show it in a zone.
    """
    df = df.withColumn("Date", F.to_date("Date"))
    if "LastUpdated" in df.columns and isinstance(df.schema["LastUpdated"].dataType, T.StringType):
        df = df.withColumn("LastUpdated", utc_instant(F.col("LastUpdated")))
    return drop_unkeyed(df)


def read_panel(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    on_bad: str = "raise",
    required: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """One named input from landed files.  Unknown names and formats are errors.

    Whole numbers may be written ``5``, ``5.0`` or ``"5"``.  A malformed record
    and a value that can't be typed fail the job that meets them.  Every column
    checks its own values, so a plan reads and checks the columns it uses and no
    others; what is stored in its type needs no check and takes pushed filters.
    Rows without key or date always leave the panel.

    With ``on_bad="reject"`` a row with any bad value leaves the panel too, for
    :func:`rejected_rows`; whether it does is the same for every plan, so the
    columns that could be bad are all read.  :func:`split_panel` reads the files
    once for both.

    A column of ``required`` (default: all of the dataset) that the files lack
    is an error at once; JSON records may leave out fields.  ``keep`` names
    further columns, kept as they are.
    """
    if on_bad not in ("raise", "reject"):
        raise ValueError(f"on_bad must be 'raise' or 'reject', not {on_bad!r}")
    landed = _landed(spark, name, path, fmt, required, keep, options)
    keyed = F.lit(True)
    for key in REPORT_KEYS:
        keyed = keyed & F.col(key).isNotNull()
    if on_bad == "reject":
        return landed.raw.where(landed.why().isNull()).select(*landed.typed()).where(keyed)
    rows = landed.raw
    if landed.malformed is not None:
        said = F.concat(F.lit(f"{name}: {MALFORMED} in "), F.col(CORRUPT))
        rows = rows.where(F.when(landed.malformed, F.raise_error(said).cast("boolean")).otherwise(True))
    return rows.select(*landed.typed(name)).where(keyed)


def rejected_rows(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    required: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """``dataset, reason, record`` of every row that :func:`read_panel` leaves out or fails on."""
    landed = _landed(spark, name, path, fmt, required, keep, options)
    told = landed.raw.select(F.lit(name).alias("dataset"), landed.reason().alias("reason"), landed.record().alias("record"))
    return told.where(F.col("reason").isNotNull())


@dataclass(frozen=True)
class SplitPanel:
    """What :func:`split_panel` has written: two folders, and rows by reason (``""``: the panel's)."""

    panel_path: str
    rejects_path: str
    counts: Mapping[str, int]

    def panel(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.panel_path).drop("reason", "record")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.rejects_path).select("reason", "record")


def split_panel(
    spark: SparkSession,
    name: str,
    path: str,
    folder: str,
    fmt: str = "parquet",
    required: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    **options: str,
) -> SplitPanel:
    """Typed rows, rejects and their counts from one read of the files, as Parquet below ``folder``.

    Each record is tagged once and written to one of two folders; the counts are
    observed on the way.  The panel's files are typed, so plans over them prune
    columns and push filters.
    """
    landed = _landed(spark, name, path, fmt, required, keep, options)
    typed = landed.raw.select(landed.reason().alias("reason"), landed.record().alias("record"), F.struct(*landed.typed()).alias("row"))
    good = F.col("reason").isNull()
    seen = Observation(f"split {name} {uuid.uuid4().hex}")
    reasons = landed.reasons()
    counted = typed.observe(
        seen,
        F.count_if(good).alias("n"),
        *(F.count_if(F.col("reason") == r).alias(f"r{i}") for i, r in enumerate(reasons)),
    )
    parts = counted.select(
        F.when(good, "panel").otherwise("rejects").alias("part"),
        "reason",
        F.when(~good, F.col("record")).alias("record"),
        *(F.when(good, F.col(f"row.{c}")).alias(c) for c in typed.schema["row"].dataType.names),
    )
    parts.write.partitionBy("part").parquet(folder)
    for part in ("panel", "rejects"):  # a part without rows has its schema all the same
        parts.drop("part").limit(0).write.mode("append").parquet(f"{folder}/part={part}")
    got = seen.get
    counts = {"": got["n"]} | {r: got[f"r{i}"] for i, r in enumerate(reasons) if got[f"r{i}"]}
    return SplitPanel(f"{folder}/part=panel", f"{folder}/part=rejects", counts)


def read_bundle(
    spark: SparkSession,
    paths: Mapping[str, str],
    key_sets: DataFrame,
    fmt: str = "parquet",
    base_set: str = "base",
    check_days: bool = True,
    **options: str,
) -> dict[str, DataFrame]:
    """All five inputs by bundle name; ``paths`` is keyed by dataset name.

    With ``check_days`` a key that an input reports twice on a day fails the
    job that meets it; keys outside the key set don't count.  That is what
    bounds every per-key window by the calendar.
    """
    bundle = {}
    for table, (name, to_base) in INPUTS.items():
        panel = read_panel(spark, name, paths[name], fmt, **options)
        if to_base:
            panel = in_key_set(panel, key_sets, base_set)
        bundle[table] = one_row_per_day(panel, name) if check_days else panel
    return bundle


def one_row_per_day(df: DataFrame, name: str) -> DataFrame:
    """``df``, failing on use where a key has several rows on a day.

    The check looks at the row before in the order of days, so it shares the
    shuffle and the sort of the per-key windows that follow.
    """
    before = F.lag("Date").over(Window.partitionBy("GeoID").orderBy("Date"))
    said = F.concat(F.lit(f"{name}: several rows for "), F.col("GeoID"), F.lit(" on "), F.col("Date").cast("string"))
    once = F.when(F.coalesce(F.col("_before") == F.col("Date"), F.lit(False)), F.raise_error(said).cast("boolean"))
    return df.withColumn("_before", before).where(once.otherwise(True)).drop("_before")


def read_dimensions(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", **options: str
) -> Dimensions:
    def read(name: str) -> DataFrame:
        return _read(spark, DIMENSIONS[name], paths[name], fmt, options)

    places = read("juris") if "juris" in paths else None
    return Dimensions(read("pop"), read("key_sets"), read("pretty"), places)


def dimension_tables(
    jurisdictions: DataFrame, key_sets: DataFrame | None = None, pretty: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The stored dimension tables, cut from an upstream place table and the given others."""
    tables = {
        "juris": jurisdictions.select("Jurisdiction", "Region", "State", "GeoID"),
        "pop": jurisdictions.select("GeoID", "Population"),
    }
    others = {"key_sets": key_sets, "pretty": pretty}
    return tables | {name: table for name, table in others.items() if table is not None}


class VersionConflict(RuntimeError):
    """Another refresh has committed a version since the one this refresh was to follow."""


def refresh_dimensions(
    jurisdictions: DataFrame,
    folder: str,
    key_sets: DataFrame | None = None,
    pretty: DataFrame | None = None,
    follows: int | None = None,
) -> dict[str, str]:
    """Store the dimension tables as one new version of ``folder``; gives the paths of all its tables.

    The tables are written to a folder of their own first.  Then the version's
    manifest, the list of all its tables, is created under the next number,
    which only one refresh can do: what the other has written comes as one
    later version or not at all, and a run that fails leaves the version before
    in force.  Tables that are not given are those of the version it follows.
    With ``follows`` (0: none) that must still be the newest one, else
    :class:`VersionConflict` is raised and nothing is committed.
    """
    tables = dimension_tables(jurisdictions, key_sets, pretty)
    spark = jurisdictions.sparkSession
    own = f"{folder}/tables={uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{own}/{name}")
    written = {name: f"{own}/{name}" for name in tables}
    while True:
        newest = max(dimension_versions(spark, folder), default=0)
        if follows is not None and newest != follows:
            raise VersionConflict(f"{folder}: version {newest} is there, not {follows}")
        paths = (dimension_paths(spark, folder, newest) if newest else {}) | written
        manifest = json.dumps({"version": newest + 1, "follows": newest, "tables": paths}, sort_keys=True)
        if _create(spark, _manifest_path(folder, newest + 1), manifest):
            return paths


def dimension_versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the committed versions, ascending."""
    path, files = _hadoop(spark, f"{folder}/versions")
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def dimension_paths(spark: SparkSession, folder: str, version: int) -> dict[str, str]:
    """The table paths of one version."""
    if version not in dimension_versions(spark, folder):
        raise ValueError(f"{folder}: no version {version}")
    (row,) = spark.read.text(_manifest_path(folder, version), wholetext=True).collect()
    return json.loads(row[0])["tables"]


def latest_dimensions(spark: SparkSession, folder: str) -> dict[str, str]:
    """The table paths of the newest version in ``folder``."""
    return dimension_paths(spark, folder, max(dimension_versions(spark, folder), default=0))


def _manifest_path(folder: str, version: int) -> str:
    return f"{folder}/versions/{version:08d}.json"


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself reaches them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, unless it is there: written aside, then renamed, which never replaces a file.

    The rename is what decides between two writers, so readers see no half
    manifests.  Stores without an atomic rename that keeps an existing target
    need one that has it for this folder.
    """
    final, files = _hadoop(spark, path)
    aside, _ = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, final, none)
        return True
    except Py4JJavaError as error:
        if not error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        files.delete(aside, False)
        return False


# -- typed reading --------------------------------------------------------------

UNKEYED = "no key or date"
MALFORMED = "malformed record"


@dataclass(frozen=True)
class _Landed:
    """Records as they are, with each column's typed value and, where it may fail, the test for a bad one."""

    raw: DataFrame
    values: Mapping[str, Column]
    bad: Mapping[str, Column]
    keep: tuple[str, ...]

    @property
    def malformed(self) -> Column | None:
        return F.col(CORRUPT).isNotNull() if CORRUPT in self.raw.columns else None

    def typed(self, fail_as: str | None = None) -> list[Column]:
        """The typed columns; with a dataset's name each fails on its own bad values."""
        out = []
        for name, value in self.values.items():
            if fail_as is not None and name in self.bad:
                said = F.concat(F.lit(f"{fail_as}: bad {name} in "), F.col(name).cast("string"))
                kind = self.raw.select(value).schema[0].dataType
                value = F.when(self.bad[name], F.raise_error(said).cast(kind)).otherwise(value)
            out.append(value.alias(name))
        return [*out, *(F.col(c) for c in self.keep)]

    def why(self) -> Column:
        """What is wrong with a record beyond a lacking key, else NULL."""
        found = F.when(F.lit(False) if self.malformed is None else self.malformed, F.lit(MALFORMED))
        for name, bad in self.bad.items():
            found = found.when(bad, F.lit(f"bad {name}"))
        return found

    def reason(self) -> Column:
        unkeyed = F.lit(False)
        for key in REPORT_KEYS:
            unkeyed = unkeyed | self.values[key].isNull()
        return F.coalesce(self.why(), F.when(unkeyed, F.lit(UNKEYED)))

    def reasons(self) -> list[str]:
        return [MALFORMED, *(f"bad {name}" for name in self.bad), UNKEYED]

    def record(self) -> Column:
        whole = F.to_json(F.struct(*[c for c in self.raw.columns if c != CORRUPT]))
        return whole if self.malformed is None else F.coalesce(F.col(CORRUPT), whole)


def _landed(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str,
    required: Sequence[str] | None,
    keep: Sequence[str],
    options: Mapping[str, str],
) -> _Landed:
    if name not in PANELS:
        raise ValueError(f"unknown dataset {name!r}; use one of {', '.join(PANELS)}")
    fields = T.StructType.fromDDL(PANELS[name]).fields
    raw = _raw(spark, [f.name for f in fields], path, fmt, keep, options)
    wanted = [f.name for f in fields] if required is None else [*REPORT_KEYS, *required]
    lacking = [c for c in (*wanted, *keep) if c not in raw.columns]
    if lacking:
        raise ValueError(f"{name}: no column {', '.join(dict.fromkeys(lacking))} in {path}")
    if fmt in ("csv", "json"):
        known = {f.name for f in fields} | {*keep, CORRUPT}
        strange = [c for c in raw.columns if c not in known]
        if strange:
            raise ValueError(f"{name}: unknown column {', '.join(strange)} in {path}; name it in keep")

    values, bad = {}, {}
    for field in fields:
        if field.name not in raw.columns:
            continue
        values[field.name] = _value(raw, field)
        if not _fits(raw, field):
            given = F.trim(F.col(field.name).cast("string"))
            bad[field.name] = values[field.name].isNull() & given.isNotNull() & (given != "")
    return _Landed(raw, values, bad, tuple(keep))


def _fits(raw: DataFrame, field: T.StructField) -> bool:
    """Whether every stored value can be typed."""
    stored = raw.schema[field.name].dataType
    if field.name in ("Date", "LastUpdated"):
        return _is_time(raw, field.name)
    return isinstance(field.dataType, T.StringType) or isinstance(stored, T.IntegralType)


def _value(raw: DataFrame, field: T.StructField) -> Column:
    """A field in its type; NULL where it can't be read."""
    value = F.col(field.name)
    if field.name == "Date":
        return value.cast("date") if _is_time(raw, field.name) else value.try_cast("date")
    if field.name == "LastUpdated":
        return value.cast("timestamp") if _is_time(raw, field.name) else utc_instant(value)
    if isinstance(field.dataType, T.StringType):
        return value.cast("string")
    if isinstance(raw.schema[field.name].dataType, T.IntegralType):
        return value.cast(field.dataType)
    # whole numbers arrive as 5, 5.0 or "5"
    number = F.trim(value.cast("string")).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number).try_cast(field.dataType)


def _is_time(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _raw(
    spark: SparkSession, names: Sequence[str], path: str, fmt: str, keep: Sequence[str], options: Mapping[str, str]
) -> DataFrame:
    """Records as they are: text formats as strings, with malformed ones in a column of their own."""
    _known_format(fmt)
    reader = spark.read.options(**options)
    if fmt == "csv":
        # Landed CSV files put columns in their own order: names come from the header.
        header = reader.option("header", True).csv(path).columns
        shape = ", ".join(f"`{c}` string" for c in (*header, CORRUPT))
        # a record is malformed by all its fields, whichever a query needs
        return (
            reader.option("header", True)
            .option("enforceSchema", False)
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .schema(shape)
            .csv(path)
        )
    if fmt == "json":
        shape = ", ".join(f"`{c}` string" for c in dict.fromkeys((*names, *keep, CORRUPT)))
        return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(shape).json(path)
    df = reader.format(fmt).load(path)
    return df.select(*[c for c in df.columns if c in {*names, *keep}])


def _known_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, not {fmt!r}")


def _read(
    spark: SparkSession, schema: str, path: str, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """A dimension table; malformed text fails the job."""
    _known_format(fmt)
    reader = spark.read.options(**options)
    if fmt == "csv":
        return _typed(reader.option("header", True).option("mode", "FAILFAST").csv(path), schema)
    if fmt == "json":
        return reader.option("mode", "FAILFAST").schema(schema).json(path)
    return _typed(reader.format(fmt).load(path), schema)


def _typed(df: DataFrame, schema: str) -> DataFrame:
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields if f.name in df.columns])
