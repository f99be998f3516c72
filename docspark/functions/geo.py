"""Geometry on lat/lon columns as plain expressions: distances, boxes, cells, polygons."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in metres, metres per unit, geohash digits.
EARTH_RADIUS = 6371008.7714
UNITS = {
    "m": 1.0, "km": 1000.0, "mi": 1609.344, "nmi": 1852.0, "yd": 0.9144, "ft": 0.3048,
    "in": 0.0254, "cm": 0.01, "mm": 0.001,
}
UNIT_NAMES = {
    "meters": "m", "kilometers": "km", "miles": "mi", "nauticalmiles": "nmi", "yards": "yd",
    "feet": "ft", "inch": "in", "centimeters": "cm", "millimeters": "mm", "NM": "nmi",
}
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


@dataclass(frozen=True)
class Point:
    lat: float
    lon: float


@dataclass(frozen=True)
class Distance:
    """A typed distance; only its whole units count."""

    value: float
    unit: str = "km"


@dataclass(frozen=True)
class Box:
    top_left: Point
    bottom_right: Point


@dataclass(frozen=True)
class Polygon:
    """A simple ring; the last point may repeat the first."""

    ring: tuple[Point, ...]


def unit_factor(unit: str) -> float:
    """Metres of one unit."""
    return UNITS[UNIT_NAMES.get(unit, unit)]


def metres(distance: Distance | str | float) -> float:
    if isinstance(distance, Distance):
        return int(distance.value) * unit_factor(distance.unit)
    if isinstance(distance, (int, float)):
        return float(distance)
    number, unit = re.fullmatch(r"\s*([0-9.]+)\s*([A-Za-z]*)\s*", distance).groups()
    return float(number) * unit_factor(unit or "m")


def point(value: Point | str | Sequence[float]) -> Point:
    """A point from ``Point``, ``"lat,lon"``, a geohash, or ``[lon, lat]``."""
    if isinstance(value, Point):
        return value
    if isinstance(value, str):
        if "," in value:
            lat, lon = value.split(",")
            return Point(float(lat), float(lon))
        return cell_centre(value)
    lon, lat = value
    return Point(float(lat), float(lon))


def make_point(lat: Column, lon: Column) -> Column:
    return F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"))


def parse_point(text: Column) -> Column:
    """``"lat,lon"`` strings."""
    parts = F.split(text, ",")
    return make_point(F.trim(parts[0]), F.trim(parts[1]))


# --- distances ----------------------------------------------------------------------------


def plane_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a plane that is scaled at the middle latitude."""
    x = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2.0))
    y = F.radians(lat2 - lat1)
    return F.sqrt(x * x + y * y) * EARTH_RADIUS


def arc_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres (haversine)."""
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), F.lit(2.0))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), F.lit(2.0)))
    return F.asin(F.least(F.lit(1.0), F.sqrt(a))) * (2.0 * EARTH_RADIUS)


def distance_to(location: Column, origin: Point, kind: str = "arc", unit: str = "m") -> Column:
    fn = arc_distance if kind == "arc" else plane_distance
    d = fn(location["lat"], location["lon"], F.lit(origin.lat), F.lit(origin.lon))
    factor = unit_factor(unit)
    return d / factor if factor != 1.0 else d


def within_distance(location: Column, origin: Point, metres_: float) -> Column:
    """Plane distance at most ``metres_``, behind a box that the scan can test."""
    dlat = math.degrees(metres_ / EARTH_RADIUS) * (1 + 1e-9) + 1e-12
    exact = distance_to(location, origin, "plane") <= metres_
    box = location["lat"].between(origin.lat - dlat, origin.lat + dlat)
    # the middle latitude is at most half the height away from the origin's
    cos = math.cos(math.radians(min(90.0, abs(origin.lat) + dlat / 2)))
    if cos > 1e-6:
        dlon = dlat / cos
        box = box & location["lon"].between(origin.lon - dlon, origin.lon + dlon)
    return box & exact


def in_box(location: Column, top_left: Point, bottom_right: Point) -> Column:
    lat = location["lat"].between(bottom_right.lat, top_left.lat)
    if top_left.lon <= bottom_right.lon:
        return lat & location["lon"].between(top_left.lon, bottom_right.lon)
    # across the antimeridian
    return lat & ((location["lon"] >= top_left.lon) | (location["lon"] <= bottom_right.lon))


def in_ring(location: Column, ring: Sequence[Point]) -> Column:
    """Even-odd rule: count the ring's edges to the right of the point."""
    pts = list(ring)
    if pts[0] != pts[-1]:
        pts.append(pts[0])
    lat, lon = location["lat"], location["lon"]
    crossings = F.lit(0)
    for a, b in zip(pts, pts[1:]):
        if a.lat == b.lat:
            continue
        spans = (F.lit(a.lat) > lat) != (F.lit(b.lat) > lat)
        at = (lat - a.lat) * ((b.lon - a.lon) / (b.lat - a.lat)) + a.lon
        crossings = crossings + (spans & (lon < at)).cast("int")
    box = in_box(location, Point(max(p.lat for p in pts), min(p.lon for p in pts)),
                 Point(min(p.lat for p in pts), max(p.lon for p in pts)))
    return box & (crossings % 2 == 1)


def in_ring_column(location: Column, ring: Column) -> Column:
    """As :func:`in_ring` where each row brings its own closed ring
    (``array<struct<lat,lon>>``)."""
    lat, lon = location["lat"], location["lon"]
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"]
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def shape_relation(stored: Column, relation: str, shape: Box | Polygon) -> Column:
    """Stored points against a box or polygon; stored boxes (``struct<top,left,bottom,right>``)
    against a box."""
    relation = relation.lower()
    if isinstance(shape, Polygon):
        inside = in_ring(stored, shape.ring)
        return {"intersects": inside, "within": inside, "disjoint": ~inside,
                "contains": F.lit(False)}[relation]
    tl, br = shape.top_left, shape.bottom_right
    if relation.startswith("point_"):
        inside = in_box(stored, tl, br)
        return ~inside if relation == "point_disjoint" else inside
    return box_relation(stored, relation, F.lit(tl.lat), F.lit(tl.lon), F.lit(br.lat), F.lit(br.lon))


def box_relation(box: Column, relation: str, top: Column, left: Column, bottom: Column,
                 right: Column) -> Column:
    touch = ((box["left"] <= right) & (box["right"] >= left)
             & (box["bottom"] <= top) & (box["top"] >= bottom))
    if relation == "intersects":
        return touch
    if relation == "disjoint":
        return ~touch
    if relation == "within":
        return ((box["left"] >= left) & (box["right"] <= right)
                & (box["bottom"] >= bottom) & (box["top"] <= top))
    if relation == "contains":
        return ((box["left"] <= left) & (box["right"] >= right)
                & (box["bottom"] <= bottom) & (box["top"] >= top))
    raise ValueError(f"unknown relation {relation!r}")


# --- geohash cells ---------------------------------------------------------------------------


def _bits(precision: int) -> tuple[int, int]:
    if not 1 <= precision <= 12:
        raise ValueError("geohash precision is 1 to 12")
    return (5 * precision + 1) // 2, 5 * precision // 2


def _grid(value: Column, low: float, span: float, bits: int) -> Column:
    cells = 1 << bits
    index = F.floor((value - low) / span * float(cells)).cast("long")
    return F.least(F.greatest(index, F.lit(0).cast("long")), F.lit(cells - 1).cast("long"))


def grid_indices(lat: Column, lon: Column, precision: int) -> tuple[Column, Column]:
    """Row and column of the geohash grid."""
    lon_bits, lat_bits = _bits(precision)
    return _grid(lat, -90.0, 180.0, lat_bits), _grid(lon, -180.0, 360.0, lon_bits)


def cell_of_indices(row: Column, col: Column, precision: int) -> Column:
    """Interleave the two indices, five bits to a digit, longitude first."""
    lon_bits, lat_bits = _bits(precision)
    digits = []
    for d in range(precision):
        value = F.lit(0)
        for bit in range(5 * d, 5 * d + 5):
            source, shift = ((col, lon_bits - 1 - bit // 2) if bit % 2 == 0
                             else (row, lat_bits - 1 - bit // 2))
            value = value * 2 + F.shiftright(source, shift).bitwiseAND(F.lit(1)).cast("int")
        digits.append(F.substring(F.lit(BASE32), value + 1, F.lit(1)))
    return F.concat(*digits)


def geohash(lat: Column, lon: Column, precision: int = 12) -> Column:
    return cell_of_indices(*grid_indices(lat, lon, precision), precision)


def cell_indices(cell: Column, precision: int) -> tuple[Column, Column]:
    """Row and column of a cell column (the inverse of :func:`cell_of_indices`)."""
    row, col = F.lit(0).cast("long"), F.lit(0).cast("long")
    for d in range(precision):
        value = F.position(F.substring(cell, d + 1, 1), F.lit(BASE32)) - 1
        for bit in range(5 * d, 5 * d + 5):
            b = F.shiftright(value, 4 - (bit - 5 * d)).bitwiseAND(F.lit(1)).cast("long")
            if bit % 2 == 0:
                col = col * 2 + b
            else:
                row = row * 2 + b
    return row, col


def bounds_of_indices(row: Column, col: Column, precision: int) -> Column:
    lon_bits, lat_bits = _bits(precision)
    height, width = 180.0 / (1 << lat_bits), 360.0 / (1 << lon_bits)
    return F.struct(
        ((row + 1) * height - 90.0).alias("top"), (col * width - 180.0).alias("left"),
        (row * height - 90.0).alias("bottom"), ((col + 1) * width - 180.0).alias("right"))


def cell_bounds(cell: Column, precision: int) -> Column:
    """``struct<top,left,bottom,right>`` of a cell."""
    return bounds_of_indices(*cell_indices(cell, precision), precision)


def cell_neighbors(cell: Column, precision: int) -> Column:
    """Array of the cells around a cell; columns wrap around, rows end at the poles.

    The indices of the cell are bound once as an array element, so that the eight
    neighbours do not decode it again.
    """
    lon_bits, lat_bits = _bits(precision)
    row, col = cell_indices(cell, precision)
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"))
                      for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c])
    here = F.array(F.struct(row.alias("row"), col.alias("col")))
    moved = F.flatten(F.transform(here, lambda h: F.transform(steps, lambda s: F.struct(
        (h["row"] + s["r"]).alias("row"), F.pmod(h["col"] + s["c"], F.lit(1 << lon_bits)).alias("col")))))
    inside = F.filter(moved, lambda m: m["row"].between(0, (1 << lat_bits) - 1))
    return F.array_distinct(F.transform(
        inside, lambda m: cell_of_indices(m["row"], m["col"], precision)))


def sub_cells(cell: Column) -> Column:
    """The 32 cells one digit finer."""
    return F.transform(F.array(*[F.lit(d) for d in BASE32]), lambda d: F.concat(cell, d))


def cell_centre(cell: str) -> Point:
    """The middle of one literal cell."""
    low_lat, high_lat, low_lon, high_lon = -90.0, 90.0, -180.0, 180.0
    even = True
    for ch in cell:
        value = BASE32.index(ch)
        for shift in range(4, -1, -1):
            upper = value >> shift & 1
            if even:
                mid = (low_lon + high_lon) / 2
                low_lon, high_lon = (mid, high_lon) if upper else (low_lon, mid)
            else:
                mid = (low_lat + high_lat) / 2
                low_lat, high_lat = (mid, high_lat) if upper else (low_lat, mid)
            even = not even
    return Point((low_lat + high_lat) / 2, (low_lon + high_lon) / 2)
