"""Readers of trip files, JSON trip documents and zone tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..operators.normalize import check_schema, normalize
from ..operators.selection import filter_trips, keep_valid, pushable, rules_apply
from ..schemas import SchemaValidationError, TripKind, kind_of
from . import files
from .footers import probe_footers, probe_paths

ORIGIN = ("source_file", "source_row")
ZONE_SCHEMA = "zone_id int, lon double, lat double"


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def scan(
    spark: SparkSession, paths: str | Sequence[str], with_origin: bool = False, merge: bool = False
) -> DataFrame:
    """Parquet with the schema of the files themselves, nested folders included.

    All files are taken to have one schema, unless ``merge`` asks for the union of their columns; then
    columns of unlike types are an error. ``with_origin`` adds file path and row position, a row identity
    that no shuffle, retry or repartitioning changes.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge)
    df = reader.parquet(*_as_list(paths))
    if with_origin:
        position = (F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        df = df.select("*", *[c.alias(name) for c, name in zip(position, ORIGIN)])
    return df


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both: whole numbers become 64-bit, whole and floating ones doubles,
    which are exact up to 2**53. None where there is no such type."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return T.LongType()
    floating = (T.FloatType, T.DoubleType)
    return T.DoubleType() if isinstance(a, _WHOLE + floating) and isinstance(b, _WHOLE + floating) else None


def united(frames: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """The rows of all frames with the columns of all, null where a frame lacks one, of the wider type each.

    Columns go by name without regard to case. A column of types that nothing holds raises an error that gives
    the first of the two frames' ``names``.
    """
    first: dict[str, tuple[str, T.DataType, str]] = {}
    for frame, where in zip(frames, names, strict=True):
        for field in frame.schema:
            column, dtype, known = first.get(field.name.lower(), (field.name, field.dataType, where))
            wider = wider_type(dtype, field.dataType)
            if wider is None:
                raise SchemaValidationError(
                    f"column {column} is {dtype.simpleString()} in {known} and {field.dataType.simpleString()} in {where}"
                )
            first[field.name.lower()] = (column, wider, known)

    def aligned(frame: DataFrame) -> DataFrame:
        present = {c.lower(): c for c in frame.columns}
        return frame.select(
            *[
                (F.col(f"`{present[key]}`") if key in present else F.lit(None)).cast(dtype).alias(column)
                for key, (column, dtype, _) in first.items()
            ]
        )

    return reduce(DataFrame.unionByName, [aligned(f) for f in frames])


def read_any(spark: SparkSession, path: str | Sequence[str], with_origin: bool = False) -> DataFrame:
    """Rows of files of any kind, with the columns of all of them; a file set without rows is an error.

    Footers are looked at by tasks. Each distinct schema gets a scan of its own, and columns of unlike types are
    widened (see ``united``), or refused with the names of two files.
    """
    groups = _schema_groups(spark, _as_list(path))
    df = united([scan(spark, group, with_origin) for group in groups], [group[0] for group in groups])
    if df.select(df.columns[0]).isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def typed_trips(
    df: DataFrame,
    kind: str | TripKind,
    criteria: dict | None = None,
    strict: bool = True,
    keep: Sequence[str] = (),
    valid_only: bool = False,
    flag_narrowing: bool = False,
) -> DataFrame:
    """Typed trips from a frame of file columns: schema check, criteria, projection.

    ``valid_only`` keeps valid trips; the rules look at the file's own values where those have the types
    they need, so that they reach the scan, and at the typed ones otherwise.
    """
    kind, criteria = kind_of(kind), criteria or {}
    check_schema(df, kind)
    early_rules = valid_only and rules_apply(df, kind)
    if early_rules:
        df = keep_valid(df, kind)
    early = {k: v for k, v in criteria.items() if pushable(df, kind, k)}
    late = {k: v for k, v in criteria.items() if k not in early}
    df = filter_trips(df, kind, **early)
    trips = normalize(df, kind, strict=strict, keep=keep, flag_narrowing=flag_narrowing)
    if valid_only and not early_rules:
        trips = keep_valid(trips, kind)
    return filter_trips(trips, kind, **late)


def read_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    kind: str | TripKind,
    *,
    criteria: dict | None = None,
    with_origin: bool = False,
    mixed_schemas: bool = True,
    files_only: bool = False,
    strict: bool = True,
    valid_only: bool = False,
    flag_narrowing: bool = False,
) -> DataFrame:
    """Typed trips of one kind, from files and folders, nested ones included.

    ``criteria`` (see ``filter_trips``) are put on the file columns, below the type conversion,
    so that the scan can skip row groups; so is ``valid_only`` where it can be. Files may have different
    columns and column types, such as several years of monthly files: footers are looked at by tasks
    first, and each distinct schema gets a scan of its own. ``mixed_schemas=False`` saves that look for files
    that are known to be alike. ``flag_narrowing`` adds ``narrowed`` (see ``normalize``).
    """
    kind, paths = kind_of(kind), _as_list(paths)
    for path in paths:
        if not files.exists(spark, path):
            raise FileNotFoundError(f"there is no {path}")
        if files_only and not files.is_file(spark, path):
            raise IsADirectoryError(f"{path} is a folder, not a file")
    groups = _schema_groups(spark, paths) if mixed_schemas else [paths]
    keep = ORIGIN if with_origin else ()
    frames = [
        typed_trips(scan(spark, group, with_origin), kind, criteria, strict, keep, valid_only, flag_narrowing)
        for group in groups
    ]
    return reduce(DataFrame.unionByName, frames)


def read_listed(spark: SparkSession, paths: Sequence[str], kind: str | TripKind, **options) -> DataFrame:
    """Typed trips of listed files, whatever their schemas: footers by tasks, then a scan per schema.

    Meant for the files of a micro-batch; their names come to the driver. ``options`` as for ``typed_trips``.
    """
    groups: dict[str, list[str]] = {}
    for path, shape, error in probe_paths(spark, paths).select("path", "fingerprint", "error").collect():
        if error:
            raise OSError(f"unreadable Parquet file {path}: {error}")
        groups.setdefault(shape, []).append(files.literal(path))
    frames = [typed_trips(scan(spark, sorted(groups[shape])), kind, **options) for shape in sorted(groups)]
    return reduce(DataFrame.unionByName, frames)


def read_yellow(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    return read_trips(spark, paths, "yellow", **options)


def read_green(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    return read_trips(spark, paths, "green", **options)


def _schema_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The paths as they are if all their files have one schema, else file paths grouped by schema.

    Spark lists the folders and tasks read the footers. Paths come to the driver only where schemas differ.
    """
    if len(paths) == 1 and files.is_file(spark, paths[0]):
        return [paths]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    content = [] if all(files.is_arrow_path(p) for p in paths) else ["content"]
    probe = probe_footers(found.where("length > 0").select("path", *content)).select("path", "fingerprint", "error")
    shapes = probe.groupBy("fingerprint").agg(F.max(F.struct("error", "path")).alias("worst")).collect()
    for row in shapes:
        if row.worst.error:
            raise OSError(f"unreadable Parquet file {row.worst.path}: {row.worst.error}")
    if len(shapes) < 2:
        return [paths]
    groups: dict[str, list[str]] = {}
    for row in probe.collect():
        groups.setdefault(row.fingerprint, []).append(files.literal(row.path))
    return [sorted(groups[key]) for key in sorted(groups)]


def read_documents(spark: SparkSession, paths: str | Sequence[str], kind: str | TripKind) -> DataFrame:
    """Typed trips from JSON lines, one trip document per line."""
    from ..operators.documents import from_documents

    return from_documents(spark.read.text(_as_list(paths)), kind, "value")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup table: location id to coordinates."""
    zones = spark.read.parquet(path)
    return zones.select(
        F.col("zone_id").cast("int").alias("zone_id"),
        F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
    )
