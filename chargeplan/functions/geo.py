"""Plane geometry and map projections as Column expressions.

A point is struct<x, y>; a line or ring is array<struct<x, y>>; a polygon is array<ring>, the first the shell, the others holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point from a segment; a segment of no length is its point."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length)))
    return distance(px, py, ax + t * dx, ay + t * dy)


def line_distance(px: Column, py: Column, line: Column) -> Column:
    """Distance of a point from a line of two points or more."""
    ends = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: segment_distance(px, py, a["x"], a["y"], b["x"], b["y"]))
    return F.array_min(ends)


def _edges(ring: Column, value) -> Column:
    """Values of all edges of a ring, which need not repeat its first point at its end."""
    n = F.size(ring)
    following = F.concat(F.slice(ring, 2, n - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, value)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def signed_area(ring: Column) -> Column:
    ox, oy = ring[0]["x"], ring[0]["y"]  # near the ring, so that far-off origins lose no digits
    return _total(_edges(ring, lambda a, b: (a["x"] - ox) * (b["y"] - oy) - (b["x"] - ox) * (a["y"] - oy))) / 2


def ring_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def polygon_area(polygon: Column) -> Column:
    """Shell less holes."""
    return ring_area(polygon[0]) - F.aggregate(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.lit(0.0), lambda s, r: s + ring_area(r))


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid, reckoned from the first point so that far-off origins lose no digits."""
    ox, oy = ring[0]["x"], ring[0]["y"]
    cross = lambda a, b: (a["x"] - ox) * (b["y"] - oy) - (b["x"] - ox) * (a["y"] - oy)
    area = _total(_edges(ring, cross))
    cx = _total(_edges(ring, lambda a, b: (a["x"] + b["x"] - 2 * ox) * cross(a, b)))
    cy = _total(_edges(ring, lambda a, b: (a["y"] + b["y"] - 2 * oy) * cross(a, b)))
    return point(ox + cx / (3 * area), oy + cy / (3 * area))


def on_ring(px: Column, py: Column, ring: Column) -> Column:
    """On one of the edges, ends included."""
    between = lambda v, a, b: (v >= F.least(a, b)) & (v <= F.greatest(a, b))
    touches = lambda a, b: between(px, a["x"], b["x"]) & between(py, a["y"], b["y"]) & ((b["x"] - a["x"]) * (py - a["y"]) == (b["y"] - a["y"]) * (px - a["x"]))
    return F.exists(_edges(ring, touches), lambda v: v)


def in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Ray casting: an odd number of edges crosses the ray to the right. A point on an edge is not inside."""
    crosses = lambda a, b: ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])
    return (F.size(F.filter(_edges(ring, crosses), lambda v: v)) % 2 == 1) & ~on_ring(px, py, ring)


def in_polygon(px: Column, py: Column, polygon: Column) -> Column:
    """In an odd number of rings: inside the shell and not inside a hole, whose edge still counts."""
    return F.size(F.filter(polygon, lambda r: in_ring(px, py, r))) % 2 == 1


def ring_distance(px: Column, py: Column, ring: Column) -> Column:
    """0 inside, else the distance from the nearest edge."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return F.when(in_ring(px, py, ring), F.lit(0.0)).otherwise(line_distance(px, py, closed))


def cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


# Ellipsoid GRS80 and the two grids in use (EPSG guidance note 7-2).
_A, _F = 6378137.0, 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def _q(phi, sin, log):
    s = sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - 1 / (2 * _E) * log((1 - _E * s) / (1 + _E * s)))


def to_laea(lon: Column, lat: Column) -> Column:
    """Degrees to the European equal-area grid (EPSG 3035)."""
    lat0, lon0, fe, fn = math.radians(52), math.radians(10), 4321000.0, 3210000.0
    qp = _q(math.pi / 2, math.sin, math.log)
    b0, rq = math.asin(_q(lat0, math.sin, math.log) / qp), _A * math.sqrt(qp / 2)
    d = _A * (math.cos(lat0) / math.sqrt(1 - _E2 * math.sin(lat0) ** 2)) / (rq * math.cos(b0))
    phi, lam = F.radians(lat), F.radians(lon) - F.lit(lon0)
    b = F.asin(_q(phi, F.sin, F.log) / F.lit(qp))
    big = F.lit(rq) * F.sqrt(F.lit(2.0) / (1 + math.sin(b0) * F.sin(b) + math.cos(b0) * F.cos(b) * F.cos(lam)))
    return point(fe + big * d * F.cos(b) * F.sin(lam), fn + big / d * (math.cos(b0) * F.sin(b) - math.sin(b0) * F.cos(b) * F.cos(lam)))


def from_laea(x: Column, y: Column) -> Column:
    """EPSG 3035 to degrees (x longitude, y latitude)."""
    lat0, lon0, fe, fn = math.radians(52), math.radians(10), 4321000.0, 3210000.0
    qp = _q(math.pi / 2, math.sin, math.log)
    b0, rq = math.asin(_q(lat0, math.sin, math.log) / qp), _A * math.sqrt(qp / 2)
    d = _A * (math.cos(lat0) / math.sqrt(1 - _E2 * math.sin(lat0) ** 2)) / (rq * math.cos(b0))
    px, py = (x - fe) / d, (y - fn) * d
    rho = F.sqrt(px * px + py * py)
    c = 2 * F.asin(rho / (2 * rq))
    b = F.when(rho == 0, F.lit(b0)).otherwise(F.asin(F.cos(c) * math.sin(b0) + py * F.sin(c) * math.cos(b0) / rho))
    e2, e4, e6 = _E2, _E2**2, _E2**3
    phi = b + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * b) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * b) + 761 * e6 / 45360 * F.sin(6 * b)
    lam = F.atan2(px * F.sin(c), rho * math.cos(b0) * F.cos(c) - py * math.sin(b0) * F.sin(c))
    return point(F.degrees(F.when(rho == 0, F.lit(0.0)).otherwise(lam) + lon0), F.degrees(phi))


_N = _F / (2 - _F)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm(lon: Column, lat: Column, zone: int = 33) -> Column:
    """Degrees to UTM on GRS80 (zone 33: EPSG 25833), by the transverse Mercator series in the third flattening."""
    k0, lam = 0.9996, F.radians(lon) - math.radians(6 * zone - 183)
    k = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north = xi + sum(a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    east = eta + sum(a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return point(500000.0 + k0 * _RECT * east, k0 * _RECT * north)


def to_utm_textbook(lon: Column, lat: Column, zone: int = 33) -> Column:
    """to_utm by the textbook's series in powers of the longitude (Snyder), which is some millimetres off six degrees from the meridian."""
    phi, lam = F.radians(lat), F.radians(lon) - math.radians(6 * zone - 183)
    e2, e4, e6, second = _E2, _E2**2, _E2**3, _E2 / (1 - _E2)
    s, t, c = F.sin(phi), F.pow(F.tan(phi), F.lit(2)), second * F.pow(F.cos(phi), F.lit(2))
    n, a = _A / F.sqrt(1 - e2 * s * s), lam * F.cos(phi)
    arc = _A * ((1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi - (3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi) + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi) - 35 * e6 / 3072 * F.sin(6 * phi))
    power = lambda k: F.pow(a, F.lit(k))
    east = n * (a + (1 - t + c) * power(3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * second) * power(5) / 120)
    north = arc + n * F.tan(phi) * (power(2) / 2 + (5 - t + 9 * c + 4 * c * c) * power(4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * second) * power(6) / 720)
    return point(500000.0 + 0.9996 * east, 0.9996 * north)


def from_utm(x: Column, y: Column, zone: int = 33) -> Column:
    xi, eta = y / (0.9996 * _RECT), (x - 500000.0) / (0.9996 * _RECT)
    a = xi - sum(b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    e = eta - sum(b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    chi = F.asin(F.sin(a) / F.cosh(e))
    phi = chi + sum(d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return point(F.degrees(F.atan2(F.sinh(e), F.cos(a))) + float(6 * zone - 183), F.degrees(phi))
