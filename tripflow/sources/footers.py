"""Parquet footers: columns, types and row counts without reading any row."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import derive_table_name
from ..schemas import GREEN, YELLOW
from .files import FileInfo, arrow_file_system, file_frame, is_arrow_path, is_parquet_name, list_dirs, list_files, literal

PROBE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("columns", T.ArrayType(T.StringType()), True),
        T.StructField("fingerprint", T.StringType(), True),
        T.StructField("schema_json", T.StringType(), True),
        T.StructField("num_rows", T.LongType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)
_FILES_PER_TASK = 32


def _spark_type_name(arrow_type) -> str:
    """Arrow type to the Spark type name used in fingerprints."""
    import pyarrow as pa

    if pa.types.is_timestamp(arrow_type):
        return "timestamp" if arrow_type.tz else "timestamp_ntz"
    if pa.types.is_decimal(arrow_type):
        return f"decimal({arrow_type.precision},{arrow_type.scale})"
    names = {"int32": "int", "int64": "bigint", "int16": "smallint", "int8": "tinyint", "bool": "boolean"}
    names |= {"large_string": "string", "large_binary": "binary", "date32[day]": "date"}
    return names.get(str(arrow_type), str(arrow_type))


def _probe(path: str, source=None) -> dict:
    """The footer of one file, read from ``source`` if that is given. A file that isn't Parquet, or of which
    the footer is torn, is reported; whatever else goes wrong (no access, no connection) is raised."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    if source is None:
        filesystem, inner = arrow_file_system(path)
        source = filesystem.open_input_file(inner)
    try:
        with source as handle:
            footer = pq.ParquetFile(handle)
            fields = [
                {"name": f.name, "type": _spark_type_name(f.type), "nullable": f.nullable} for f in footer.schema_arrow
            ]
            rows = footer.metadata.num_rows
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
        return {"path": path, "error": f"{type(e).__name__}: {e}"}
    return {
        "path": path,
        "columns": [f["name"] for f in fields],
        "fingerprint": fingerprint([(f["name"], f["type"], f["nullable"]) for f in fields]),
        "schema_json": json.dumps({"type": "struct", "fields": fields}, indent=2),
        "num_rows": rows,
        "error": None,
    }


def _probe_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    schema = pa.schema(
        [
            ("path", pa.string()),
            ("columns", pa.list_(pa.string())),
            ("fingerprint", pa.string()),
            ("schema_json", pa.string()),
            ("num_rows", pa.int64()),
            ("error", pa.string()),
        ]
    )
    for batch in batches:
        sources = [None] * len(batch)
        if "content" in batch.schema.names:
            sources = [pa.BufferReader(c.as_buffer()) for c in batch.column("content")]
        rows = [_probe(path, source) for path, source in zip(batch.column("path").to_pylist(), sources)]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def probe_footers(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """Footer of every file in ``files.path``; a file that isn't Parquet gets nulls and an error text.

    Any other failure, such as missing rights, fails the job. ``n_files``, when the caller knows it, spreads
    the files over tasks. Where ``files`` has a ``content`` column (Spark's binary file reader), the footers
    are taken from there, for file systems that Arrow can't open.
    """
    paths = files.select("path", *(["content"] if "content" in files.columns else []))
    if n_files is not None:
        paths = paths.repartition(max(1, -(-n_files // _FILES_PER_TASK)))
    return paths.mapInArrow(_probe_batches, PROBE_SCHEMA)


def probe_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``probe_footers`` of listed paths on any file system that Spark can read.

    Where Arrow can't open the file system, Spark's own reader hands over the bytes of whole files.
    """
    if all(is_arrow_path(p) for p in paths):
        return probe_footers(file_frame(spark, [FileInfo(p, 0) for p in paths]), len(paths))
    content = spark.read.format("binaryFile").load([literal(p) for p in paths])
    return probe_footers(content.select("path", "content"))


def table_rows(spark: SparkSession, directory: str) -> DataFrame:
    """``table_name, n_rows`` of the Parquet tables in ``directory`` from their footers: files, and folders of files at
    any depth. The rows of a table with a torn footer are null.

    Names in ``directory`` itself come to the driver; Spark lists the folders, and tasks read the footers.
    """
    names = derive_table_name("path").alias("table_name")
    single = [FileInfo(f.path, f.length) for f in list_files(spark, directory) if is_parquet_name(f.path)]
    folders = [f for f in list_dirs(spark, directory) if is_parquet_name(f)]
    reader = spark.read.format("binaryFile")
    if is_arrow_path(directory) or not single:
        listed = file_frame(spark, single)
    else:
        listed = reader.load([literal(f.path) for f in single]).select("path", "content")
    counts = probe_footers(listed).select(names, F.col("num_rows").alias("n_rows"))
    if not folders:
        return counts
    content = [] if is_arrow_path(directory) else ["content"]
    inner = reader.option("recursiveFileLookup", True).load([literal(f) for f in folders]).where("length > 0")
    probe = probe_footers(inner.select("path", *content))
    # The part of the path behind the directory begins with the table's folder.
    start = len(folders[0].rsplit("/", 1)[0]) + 2
    table = F.substring_index(F.expr(f"substring(path, {start})"), "/", 1)
    known = F.count("num_rows") == F.count(F.lit(1))
    summed = probe.withColumn("path", table).groupBy(names).agg(F.when(known, F.sum("num_rows")).alias("n_rows"))
    return counts.unionByName(summed)


def fingerprint(fields: list[tuple[str, str, bool]]) -> str:
    """Ordered ``name:type:nullable`` list, the identity of a file schema."""
    return ",".join(f"{name}:{dtype}:{str(nullable).lower()}" for name, dtype, nullable in fields)


def schema_fingerprint(schema: T.StructType) -> str:
    return fingerprint([(f.name, f.dataType.simpleString(), f.nullable) for f in schema])


def kind_from_columns(columns: Column | str) -> Column:
    """Lenient detection by marker columns; green is tried first."""
    columns = F.col(columns) if isinstance(columns, str) else columns

    def has(name: str) -> Column:
        return F.array_contains(columns, name)

    green = has(GREEN.pickup) & has("trip_type")
    yellow = has(YELLOW.pickup) & has(YELLOW.dropoff) & ~has(GREEN.pickup)
    return F.when(green, F.lit("green")).when(yellow, F.lit("yellow")).otherwise(F.lit("unknown"))


def kind_from_fingerprint(value: Column | str) -> Column:
    """Strict detection: the whole ordered schema equals one of the two file schemas."""
    value = F.col(value) if isinstance(value, str) else value
    return (
        F.when(value == schema_fingerprint(YELLOW.file_schema), F.lit("yellow"))
        .when(value == schema_fingerprint(GREEN.file_schema), F.lit("green"))
        .otherwise(F.lit("unknown"))
    )


def detect_kind(probe: DataFrame, mode: str = "lenient") -> DataFrame:
    """Adds ``kind`` to a probe. A file without rows or without a readable footer is unknown."""
    detectors = {"lenient": kind_from_columns("columns"), "strict": kind_from_fingerprint("fingerprint")}
    if mode not in detectors:
        raise ValueError(f"mode is one of {sorted(detectors)}, not {mode!r}")
    has_rows = F.coalesce(F.col("num_rows") > 0, F.lit(False))
    return probe.withColumn("kind", F.when(has_rows, detectors[mode]).otherwise(F.lit("unknown")))
