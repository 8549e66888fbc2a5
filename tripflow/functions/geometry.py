"""Well-known text of trip geometries (longitude, latitude; SRID 4326)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SRID = 4326


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coordinate(lon: Column | str, lat: Column | str) -> Column:
    return F.concat(_col(lon).cast("string"), F.lit(" "), _col(lat).cast("string"))


def point_through(at: Column | str) -> Column:
    return F.concat(F.lit("POINT ("), _col(at), F.lit(")"))


def line_through(start: Column | str, end: Column | str) -> Column:
    return F.concat(F.lit("LINESTRING ("), _col(start), F.lit(", "), _col(end), F.lit(")"))


def point_wkt(lon: Column | str, lat: Column | str) -> Column:
    """Null when a coordinate is missing."""
    return point_through(coordinate(lon, lat))


def segment_wkt(lon1, lat1, lon2, lat2) -> Column:
    """A two-point line; null when a coordinate is missing."""
    return line_through(coordinate(lon1, lat1), coordinate(lon2, lat2))


def line_of(coordinates: Column | str) -> Column:
    """A line through an ordered array of coordinate texts; null when one of them is missing."""
    coordinates = _col(coordinates)
    line = F.concat(F.lit("LINESTRING ("), F.array_join(coordinates, ", "), F.lit(")"))
    return F.when(F.size(coordinates) == F.size(F.array_compact(coordinates)), line)
