"""Geometry as column expressions: distances, WKT, grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radii in metres. Lookups use the rounded radius, the
# incident match uses the mean Earth radius.
LOOKUP_RADIUS_M = 6_371_000.0
MEAN_RADIUS_M = 6_371_008.8


def haversine_m(lat1, lon1, lat2, lon2, radius_m: float = LOOKUP_RADIUS_M) -> Column:
    """Great-circle distance in metres; null when any coordinate is null."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlam = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dphi), F.lit(2)) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlam), F.lit(2))
    # rounding can push a past 1 for antipodes; the guard keeps nulls null
    a = F.when(a > 1, F.lit(1.0)).otherwise(a)
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * (2 * radius_m)


def _wkt_vertices(wkt: Column) -> Column:
    body = F.regexp_extract(wkt, r"^(?:POINT|LINESTRING) \(([^()]*)\)", 1)
    return F.when(body != "", F.split(F.trim(body), r"\s*,\s*"))


def wkt_centroid(wkt: Column) -> Column:
    """struct(lat, lon): a point itself, or the plain mean of line vertices.

    Other geometry types, blanks and nulls give null coordinates.
    """
    vertices = _wkt_vertices(wkt)

    def mean_of(position: int) -> Column:
        ordinates = F.transform(
            vertices, lambda v: F.get(F.split(F.trim(v), r"\s+"), F.lit(position)).try_cast("double")
        )
        total = F.aggregate(ordinates, F.lit(0.0), lambda acc, x: acc + x)
        return total / F.size(ordinates)

    # WKT writes longitude first
    return F.struct(mean_of(1).alias("lat"), mean_of(0).alias("lon"))


def pick_wkt(geometry: Column) -> Column:
    """First of point, line and plain WKT that a geometry element carries."""
    return F.coalesce(geometry["Point"]["WGS84"], geometry["Line"]["WGS84"], geometry["WGS84"])


def linspace(index: Column, low, high, steps: int) -> Column:
    """The index-th of `steps` evenly spaced values from low to high, both included."""
    if steps < 2:
        raise ValueError("a grid axis needs at least two steps")
    return low + index * ((high - low) / (steps - 1))


def cell_ring(lat: Column, lon: Column, lat_step, lon_step) -> Column:
    """Closed [lon, lat] ring SW, SE, NE, NW, SW of the cell around a point."""
    south, north = lat - lat_step / 2, lat + lat_step / 2
    west, east = lon - lon_step / 2, lon + lon_step / 2
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.array(*[F.array(x, y) for x, y in corners])


def in_bounds(lat: Column, lon: Column, bounds: dict) -> Column:
    """Inclusive box test."""
    return lat.between(bounds["min_lat"], bounds["max_lat"]) & lon.between(
        bounds["min_lon"], bounds["max_lon"]
    )


def metres_rounded(distance: Column) -> Column:
    """Whole metres, halves to even."""
    return F.rint(distance).cast("bigint")
