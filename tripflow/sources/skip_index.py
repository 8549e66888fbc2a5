"""A skip index: what each row group of a Parquet table can hold, so that scans leave files out.

Minima and maxima come from the footers, Bloom filters from the values of the columns that want one. Tasks read
both; the index is a small table that is stored beside the data and pruned by Spark before a scan is planned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .files import arrow_file_system, is_arrow_path

SCHEMA = (
    "path string, row_group int, rows long, column string, kind string, low_whole long, high_whole long,"
    " low_real double, high_real double, low_text string, high_text string, nulls long, bloom array<long>"
)
# Bits of a Bloom filter per different value, their most (64 KB), and bits set per value.
BLOOM_BITS = 12
MOST_BLOOM_BITS = 1 << 19
PROBES = 5


def _canonical(value) -> tuple[str, object]:
    """A value's kind in the index and the value as it is compared there."""
    if isinstance(value, bool):
        return "whole", int(value)
    if isinstance(value, datetime):
        moment = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        whole = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return "whole", (whole.days * 86_400 + whole.seconds) * 1_000_000 + whole.microseconds
    if isinstance(value, date):
        return "whole", (value - date(1970, 1, 1)).days
    if isinstance(value, int):
        return "whole", value
    if isinstance(value, float):
        return "real", value
    return "text", str(value)


def _hashes(value) -> tuple[int, int]:
    """Two 31-bit hashes; equal numbers hash alike whatever their type."""
    kind, plain = _canonical(value)
    if kind == "real" and plain == plain and abs(plain) < 2**53 and plain == int(plain):
        plain = int(plain)
    digest = hashlib.blake2b(str(plain).encode(), digest_size=8).digest()
    return int.from_bytes(digest[:4], "little") >> 1, int.from_bytes(digest[4:], "little") >> 1 | 1


def _bloom(values: Sequence) -> list[int]:
    import numpy as np

    words = 1
    while words * 64 < min(MOST_BLOOM_BITS, BLOOM_BITS * len(values)):
        words *= 2
    bits = np.zeros(words * 64, np.uint8)
    for one, two in map(_hashes, values):
        bits[(one + two * np.arange(PROBES)) % len(bits)] = 1
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def _index_file(path: str, source, columns: Sequence[str], bloom: Sequence[str]) -> Iterator[dict]:
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    with source as handle:
        file = pq.ParquetFile(handle)
        at = {file.metadata.schema.column(i).path: i for i in range(file.metadata.num_columns)}
        for group in range(file.num_row_groups):
            meta = file.metadata.row_group(group)
            for name in columns:
                row = {"path": path, "row_group": group, "rows": meta.num_rows, "column": name}
                found = meta.column(at[name]).statistics if name in at else None
                if found is not None and found.has_min_max:
                    row["kind"], row[f"low_{_canonical(found.min)[0]}"] = _canonical(found.min)
                    row[f"high_{row['kind']}"] = _canonical(found.max)[1]
                if found is not None and found.has_null_count:
                    row["nulls"] = found.null_count
                elif name not in at:
                    row["nulls"] = meta.num_rows
                if name in bloom and name in at:
                    values = pc.unique(file.read_row_group(group, columns=[name]).column(0)).drop_null()
                    row["bloom"] = _bloom(values.to_pylist())
                yield row


def build_skip_index(
    spark: SparkSession, path: str, columns: Sequence[str], bloom: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """One row per row group of the files in ``path`` and column: bounds, nulls, and a Bloom filter for those in ``bloom``.

    Tasks open the files; only filtered columns are read, a row group at a time. Columns of nested type or without
    statistics have no bounds, and a file that lacks a column has only nulls in it.
    """
    import pyarrow as pa

    unknown = [c for c in bloom if c not in columns]
    if unknown:
        raise ValueError(f"no index columns: {unknown}")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    listed = reader.load(path).where("length > 0")
    content = [] if is_arrow_path(path) else ["content"]
    listed = listed.select("path", *content).repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole, real, text = pa.int64(), pa.float64(), pa.string()
    schema = pa.schema(
        [("path", text), ("row_group", pa.int32()), ("rows", whole), ("column", text), ("kind", text)]
        + [("low_whole", whole), ("high_whole", whole), ("low_real", real), ("high_real", real)]
        + [("low_text", text), ("high_text", text), ("nulls", whole), ("bloom", pa.list_(whole))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column("path").to_pylist()):
                if "content" in batch.schema.names:
                    source = pa.BufferReader(batch.column("content")[i].as_buffer())
                else:
                    system, inner = arrow_file_system(name)
                    source = system.open_input_file(inner)
                rows = list(_index_file(name, source, columns, bloom))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return listed.mapInArrow(run, SCHEMA)


def _may_equal(value) -> Column:
    one, two = _hashes(value)
    size = F.size("bloom") * 64
    hits = []
    for i in range(PROBES):
        bit = F.pmod(F.lit(one + two * i).cast("long"), size.cast("long"))
        word = F.element_at("bloom", F.shiftright(bit, 6).cast("int") + 1)
        hits.append(F.call_function("shiftrightunsigned", word, (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
    in_bloom = F.col("bloom").isNull() | reduce(Column.__and__, hits)
    return _may_lie(value, value) & in_bloom


def _may_lie(low, high) -> Column:
    """Whether the row group's bounds meet the closed range; unknown bounds meet any."""
    meets = F.lit(True)
    for bound, value in (("high", low), ("low", high)):
        if value is None:
            continue
        kind, plain = _canonical(value)
        if kind == "text":
            side = F.col(f"{bound}_text")
        else:  # whole bounds as they are against whole values, which doubles might round
            whole = F.col(f"{bound}_whole")
            side = F.coalesce(whole.cast("double"), f"{bound}_real") if kind == "real" else whole
            if kind == "whole":
                real = F.col(f"{bound}_real")
                test = real >= F.lit(plain) if bound == "high" else real <= F.lit(plain)
                meets = meets & F.coalesce(test, F.lit(True))
        meets = meets & F.coalesce(side >= F.lit(plain) if bound == "high" else side <= F.lit(plain), F.lit(True))
    return meets & F.coalesce(F.col("nulls") < F.col("rows"), F.lit(True))


def candidate_files(index: DataFrame, criteria: dict) -> DataFrame:
    """``path`` of the files that may hold a row that meets all ``criteria``.

    A criterion is a value, a list of values, or a closed range ``(low, high)`` with None for an open end, by column.
    Columns that the index doesn't know leave nothing out. One row group must pass every test.
    """
    tests = F.lit(True)
    for name, wanted in criteria.items():
        if isinstance(wanted, tuple):
            test = _may_lie(*wanted)
        else:
            test = reduce(Column.__or__, [_may_equal(v) for v in (wanted if isinstance(wanted, list) else [wanted])], F.lit(False))
        tests = tests & ((F.col("column") != name) | test)
    passed = index.groupBy("path", "row_group").agg(F.min(tests).alias("passed"))
    return passed.where("passed").select("path").distinct()


def pruned_scan(spark: SparkSession, path: str, index: DataFrame, criteria: dict) -> DataFrame:
    """The files' rows that meet ``criteria``, from the files that may hold some.

    Their names come to the driver, as many as the scan reads; Spark prunes row groups of those again.
    """
    listed = sorted(files.literal(r.path) for r in candidate_files(index, criteria).collect())
    df = spark.read.parquet(*listed) if listed else spark.read.schema(spark.read.parquet(path).schema).parquet(path).limit(0)
    for name, wanted in criteria.items():
        column = F.col(name)
        if isinstance(wanted, tuple):
            low, high = wanted
            df = df.where(column >= F.lit(low)) if low is not None else df
            df = df.where(column <= F.lit(high)) if high is not None else df
        else:
            df = df.where(column.isin(wanted if isinstance(wanted, list) else [wanted]))
    return df
