"""Space and time as one sort key: trips clustered by a Z-order key, boxes turned into ranges of it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import epoch_micros
from ..sources import files
from ..sources.skip_index import build_skip_index

KEY = "zkey"
# Bits per dimension, and the ranges that a box is cut into at most.
BITS = 12
MOST_RANGES = 256
# Bits of a cell that one look into a table sets apart.
_TABLE_BITS = 6


@dataclass(frozen=True)
class Extent:
    """What the key's cells divide. Values outside fall into the outermost cells, so no answer depends on it."""

    lon: tuple[float, float]
    lat: tuple[float, float]
    time: tuple[datetime, datetime]
    bits: int = BITS


def _micros(moment: datetime) -> int:
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    whole = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (whole.days * 86_400 + whole.seconds) * 1_000_000 + whole.microseconds


def _cell(value: Column, low: float, high: float, bits: int) -> Column:
    top = (1 << bits) - 1
    scaled = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << bits)))
    # Both of these pass over nulls.
    return F.when(scaled.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(top), scaled))).cast("long")


def _cell_of(value: float, low: float, high: float, bits: int) -> int:
    import math

    return max(0, min((1 << bits) - 1, math.floor((value - low) / (high - low) * float(1 << bits))))


def z_key(lon: Column, lat: Column, time: Column, extent: Extent) -> Column:
    """The bits of the three cells, interleaved from the highest on: one long. -1 where one of them is missing."""
    bits, (begin, end) = extent.bits, (_micros(t) for t in extent.time)
    cells = (
        _cell(lon, *extent.lon, bits),
        _cell(lat, *extent.lat, bits),
        _cell(epoch_micros(time).cast("double"), float(begin), float(end), bits),
    )
    # Bits are set apart by table, a few at a time: one expression per bit grows past what Spark compiles.
    apart = F.lit([sum((n >> bit & 1) << 3 * bit for bit in range(_TABLE_BITS)) for n in range(1 << _TABLE_BITS)]).cast("array<long>")
    spread = [
        F.shiftleft(F.get(apart, F.shiftright(cell, bit).bitwiseAND(F.lit((1 << _TABLE_BITS) - 1)).cast("int")), 3 * bit + 2 - i)
        for i, cell in enumerate(cells)
        for bit in range(0, bits, _TABLE_BITS)
    ]
    return F.coalesce(reduce(Column.bitwiseOR, spread), F.lit(-1).cast("long"))


def key_ranges(box: dict, extent: Extent, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Closed ranges of keys that hold every point of the box: ``lon``, ``lat`` and ``time`` as pairs, any of which may lack.

    Cubes of cells are halved in all dimensions while they are partly inside and their number stays within ``most``;
    what is still partly inside then counts as inside.
    """
    bits, (begin, end) = extent.bits, (_micros(t) for t in extent.time)
    time = box.get("time")
    spans = [
        (box.get("lon"), *extent.lon),
        (box.get("lat"), *extent.lat),
        (tuple(float(_micros(t)) for t in time) if time else None, float(begin), float(end)),
    ]
    top = (1 << bits) - 1
    want = [(0, top) if pair is None else (_cell_of(pair[0], a, b, bits), _cell_of(pair[1], a, b, bits)) for pair, a, b in spans]
    if any(low > high for low, high in want):
        return []
    whole: list[tuple[int, int]] = []
    partly = [(0, (0, 0, 0))]  # (level, cell of each dimension at that level)
    for level in range(bits + 1):
        size = bits - level
        deeper = []
        for _, corner in partly:
            low = [c << size for c in corner]
            high = [(c + 1 << size) - 1 for c in corner]
            if any(h < w[0] or l > w[1] for l, h, w in zip(low, high, want)):
                continue
            inside = all(w[0] <= l and h <= w[1] for l, h, w in zip(low, high, want))
            if inside or size == 0:
                whole.append(_range_of(corner, level, size))
            else:
                deeper.append((level, corner))
        if len(whole) + 8 * len(deeper) > most:
            whole += [_range_of(corner, level, size) for _, corner in deeper]
            break
        partly = [
            (level + 1, tuple(2 * c + (child >> (2 - i) & 1) for i, c in enumerate(corner)))
            for _, corner in deeper
            for child in range(8)
        ]
    merged: list[tuple[int, int]] = []
    for low, high in sorted(whole):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _range_of(corner: Sequence[int], level: int, size: int) -> tuple[int, int]:
    prefix = 0
    for bit in range(level - 1, -1, -1):
        for cell in corner:
            prefix = prefix << 1 | (cell >> bit & 1)
    return prefix << 3 * size, (prefix + 1 << 3 * size) - 1


def write_clustered(df: DataFrame, path: str, lon: str, lat: str, time: str, extent: Extent, n_files: int) -> DataFrame:
    """Write ``df`` with its key, range-partitioned and sorted by it, and the key's bounds per row group beside it.

    Rows that share a key are spread by hash, so a hot place and hour doesn't fill one file.
    """
    keyed = df.withColumn(KEY, z_key(F.col(lon), F.col(lat), F.col(time), extent))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    laid = keyed.repartitionByRange(n_files, F.col(KEY), spread).sortWithinPartitions(KEY)
    laid.write.parquet(path)
    build_skip_index(df.sparkSession, path, [KEY]).write.parquet(f"{path.rstrip('/')}-index")
    return df.sparkSession.read.parquet(f"{path.rstrip('/')}-index")


def box_files(index: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """``path`` of the files whose keys meet one of the ranges."""
    if not ranges:
        return index.select("path").limit(0)
    meets = [(F.col("high_whole") >= low) & (F.col("low_whole") <= high) for low, high in ranges]
    return index.where(reduce(Column.__or__, meets)).select("path").distinct()


def read_box(spark: SparkSession, path: str, lon: str, lat: str, time: str, extent: Extent, box: dict) -> DataFrame:
    """Rows inside the box (closed on all sides), from the files that its key ranges meet.

    The ranges reach the scan as well, so that it leaves out row groups. Names of the files that are read come to the
    driver.
    """
    ranges = key_ranges(box, extent)
    index = spark.read.parquet(f"{path.rstrip('/')}-index")
    listed = sorted(files.literal(r.path) for r in box_files(index, ranges).collect())
    df = spark.read.parquet(*listed) if listed else spark.read.parquet(path).limit(0)
    if ranges:
        df = df.where(reduce(Column.__or__, [F.col(KEY).between(low, high) for low, high in ranges]))
    for column, pair in ((lon, box.get("lon")), (lat, box.get("lat")), (time, box.get("time"))):
        if pair is not None:
            df = df.where(F.col(column).between(*[F.lit(v) for v in pair]))
    return df


