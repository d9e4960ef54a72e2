"""Geographic expressions on latitude and longitude columns in degrees. All but simplify are built-in functions; nulls give null."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Mean radii in use, in km.
EARTH_KM = 6371.0
EARTH_KM_IUGG = 6371.0088
KM_PER_DEGREE = math.pi * EARTH_KM / 180
SQFT_PER_SQM = 10.7639


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """Great-circle distance; null if any coordinate is."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2.0 * radius) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))  # least() would pass over nulls


def unit_xyz(lat: Column, lon: Column) -> Column:
    """The point on the unit sphere as a struct of x, y, z."""
    p, t = F.radians(lat), F.radians(lon)
    return F.struct((F.cos(p) * F.cos(t)).alias("x"), (F.cos(p) * F.sin(t)).alias("y"), F.sin(p).alias("z"))


def chord_to_km(chord: Column, radius: float = EARTH_KM) -> Column:
    return F.lit(2.0 * radius) * F.asin(F.when(chord > 2, F.lit(1.0)).otherwise(chord / 2))


def km_to_chord(km: Column, radius: float = EARTH_KM) -> Column:
    return F.lit(2.0) * F.sin(km / F.lit(2.0 * radius))


def bbox(lat: Column, lon: Column, km: float) -> Column:
    """A box around the point that holds every point within km: (south, north, west, east); west may pass -180."""
    d = F.lit(km / KM_PER_DEGREE)
    w = d / F.greatest(F.cos(F.radians(F.least(F.abs(lat) + d, F.lit(89.999)))), F.lit(1e-9))
    return F.struct((lat - d).alias("south"), (lat + d).alias("north"), (lon - w).alias("west"), (lon + w).alias("east"))


def grid_key(lat: Column, lon: Column, places: int = 4, bankers: bool = False) -> Column:
    """Rounded coordinates as text; halves go away from zero, or to the even digit if bankers."""
    r = F.bround if bankers else F.round
    return F.concat_ws(",", r(lat, places).cast("string"), r(lon, places).cast("string"))


def mercator(lat: Column, lon: Column) -> Column:
    """EPSG:4326 to EPSG:3857 in metres."""
    r = 6378137.0
    return F.struct((F.radians(lon) * r).alias("x"), (F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * r).alias("y"))


def from_mercator(x: Column, y: Column) -> Column:
    r = 6378137.0
    return F.struct(F.degrees(F.lit(2.0) * F.atan(F.exp(y / r)) - F.lit(math.pi / 2)).alias("lat"), F.degrees(x / r).alias("lon"))


def circle(lat: Column, lon: Column, km: float, corners: int = 48) -> Column:
    """A closed ring of corners + 1 points (lat, lon) around the point, by equirectangular offsets."""
    d = km / KM_PER_DEGREE

    def corner(i: Column) -> Column:
        a = i * F.lit(2 * math.pi / corners)
        return F.struct((lat + F.lit(d) * F.cos(a)).alias("lat"), (lon + F.lit(d) * F.sin(a) / F.cos(F.radians(lat))).alias("lon"))

    return F.transform(F.concat(F.sequence(F.lit(0), F.lit(corners - 1)), F.array(F.lit(0))), corner)


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring of (x, y) structs, closed or not, in its own square units."""
    n = F.size(ring)
    sides = F.transform(ring, lambda p, i: p["x"] * F.element_at(ring, (i + 1) % n + 1)["y"] - F.element_at(ring, (i + 1) % n + 1)["x"] * p["y"])
    twice = F.aggregate(sides, F.lit(0.0), lambda s, x: s + x)
    return F.when(n >= 3, F.abs(twice) / 2).otherwise(F.lit(0.0))


def ring_holds(ring: Column, x: Column, y: Column, edges: bool = False) -> Column:
    """Whether a point lies in a ring of (x, y) structs, by crossings; points on an edge count only if edges."""
    n = F.size(ring)
    ends = F.transform(ring, lambda p, i: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), F.element_at(ring, (i + 1) % n + 1)["x"].alias("x2"), F.element_at(ring, (i + 1) % n + 1)["y"].alias("y2")))
    crosses = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"])
    inside = F.size(F.filter(ends, crosses)) % 2 == 1
    cross = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    on = F.exists(ends, lambda e: (F.abs(cross(e)) <= 1e-12) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    return F.when(n >= 3, (inside | on) if edges else (inside & ~on)).otherwise(F.lit(False))


def raster_cell(lat: Column, lon: Column, side: int = 1201) -> Column:
    """The one-degree tile of a point, named by its south-west corner, and row and column in a side x side raster, halves to even."""
    south, west = F.floor(lat), F.floor(lon)
    tile = F.concat(F.when(south >= 0, F.lit("N")).otherwise(F.lit("S")), F.lpad(F.abs(south).cast("string"), 2, "0"), F.when(west >= 0, F.lit("E")).otherwise(F.lit("W")), F.lpad(F.abs(west).cast("string"), 3, "0"))
    return F.struct(tile.alias("tile"), F.rint((south + 1 - lat) * (side - 1)).cast("int").alias("row"), F.rint((lon - west) * (side - 1)).cast("int").alias("col"))


def simplify(line: Column, tolerance: float) -> Column:
    """A line or ring of (x, y) structs without the corners that lie within tolerance of what stays (Douglas-Peucker).

    Ends stay, so closed rings stay closed. A ring's first piece is cut at the corner farthest from its start, and a ring that
    would keep fewer than three corners keeps the three that span it most. Nulls give null, nothing is added or moved.
    """
    return _simplified(line, F.lit(float(tolerance)))


def simplified_corners(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """The places of the corners that stay, in order; pieces wait on a stack, so that depth is no limit."""
    n = len(x)
    keep = np.zeros(n, bool)
    if n <= 2:
        return np.arange(n)
    keep[[0, n - 1]] = True
    closed = x[0] == x[-1] and y[0] == y[-1]
    pieces = [(0, n - 1)]
    if closed:
        far = int(np.hypot(x - x[0], y - y[0]).argmax())
        keep[far] = True
        pieces = [(0, far), (far, n - 1)]
    gaps = np.zeros(n)
    while pieces:
        a, b = pieces.pop()
        if b - a < 2:
            continue
        d = _off_segment(x[a + 1 : b], y[a + 1 : b], x[a], y[a], x[b], y[b])
        at = int(d.argmax())
        gaps[a + 1 + at] = d[at]
        if d[at] > tolerance:
            keep[a + 1 + at] = True
            pieces += [(a, a + 1 + at), (a + 1 + at, b)]
    if closed and n >= 4 and keep.sum() < 4:
        gaps[keep] = -1
        keep[int(gaps.argmax())] = True
    return np.flatnonzero(keep)


def _off_segment(x: np.ndarray, y: np.ndarray, x1: float, y1: float, x2: float, y2: float) -> np.ndarray:
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = np.clip(((x - x1) * dx + (y - y1) * dy) / length, 0, 1) if length > 0 else np.zeros(len(x))
    return np.hypot(x - x1 - t * dx, y - y1 - t * dy)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
def _simplified(lines: pa.Array, tolerance: pa.Array) -> pa.Array:
    """Coordinates stay in columns, and equal lines of a batch are simplified once."""
    corners = lines.flatten()
    x, y = (corners.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    known, kept, sizes, at = {}, [], [], 0
    for n, most in zip(pc.list_value_length(lines).to_pylist(), tolerance.to_pylist(), strict=True):
        if n is not None:
            mine = (x[at : at + n], y[at : at + n])
            key = (mine[0].tobytes(), mine[1].tobytes(), most)
            if key not in known:
                known[key] = simplified_corners(*mine, most)
            kept.append(known[key] + at)
            at += n
        sizes.append(None if n is None else len(kept[-1]))
    places = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    ends = np.cumsum([0, *(k or 0 for k in sizes)])
    offsets = pa.array([None if k is None else o for o, k in zip(ends, sizes, strict=False)] + [ends[-1]], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x[places]), pa.array(y[places])], names=["x", "y"]))
