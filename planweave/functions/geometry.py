"""Planar and spatial geometry as column expressions.

A polygon is array<array<double>>: vertices (x, y), not closed.  Everything here
stays in the JVM; operations that need whole sets of polygons are in
planweave.operators.polygons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _next(p: Column, i: Column) -> Column:
    return F.element_at(p, (i % F.size(p) + 1).cast("int"))


def edges(poly) -> Column:
    """array<struct<x0,y0,x1,y1>>, the closing edge last; empty for fewer than two vertices."""
    p = _c(poly)
    edge = lambda a, b: F.struct(a[0].alias("x0"), a[1].alias("y0"), b[0].alias("x1"), b[1].alias("y1"))
    return F.when(F.size(p) >= 2, F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: edge(F.element_at(p, i), _next(p, i)))).otherwise(F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"))


def signed_area(poly) -> Column:
    """Shoelace, counter-clockwise positive; 0 for fewer than three vertices."""
    return F.when(F.size(_c(poly)) >= 3, F.aggregate(edges(poly), F.lit(0.0), lambda s, e: s + e.x0 * e.y1 - e.x1 * e.y0) / 2).otherwise(F.lit(0.0))


def area(poly) -> Column:
    return F.abs(signed_area(poly))


def counter_clockwise(poly) -> Column:
    return F.when(signed_area(poly) < 0, F.reverse(_c(poly))).otherwise(_c(poly))


def perimeter(poly) -> Column:
    return F.aggregate(edges(poly), F.lit(0.0), lambda s, e: s + F.hypot(e.x1 - e.x0, e.y1 - e.y0))


def envelope_area(poly, wall_height) -> Column:
    """Walls, roof and floor of an extruded footprint."""
    return perimeter(poly) * _c(wall_height) + 2 * area(poly)


def centroid(poly) -> Column:
    """struct(x, y) by shoelace; null where the area is 0."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(s, e):
        k = e.x0 * e.y1 - e.x1 * e.y0
        return F.struct((s.a + k).alias("a"), (s.x + (e.x0 + e.x1) * k).alias("x"), (s.y + (e.y0 + e.y1) * k).alias("y"))

    t = F.aggregate(edges(poly), zero, add)
    return F.when(F.abs(t.a) > 1e-12, F.struct((t.x / (3 * t.a)).alias("x"), (t.y / (3 * t.a)).alias("y")))


def bounds(poly) -> Column:
    """struct(x0, y0, x1, y1)."""
    xs, ys = F.transform(_c(poly), lambda v: v[0]), F.transform(_c(poly), lambda v: v[1])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def _segment_distance(x, y, e) -> Column:
    dx, dy = e.x1 - e.x0, e.y1 - e.y0
    n = dx * dx + dy * dy
    t = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e.x0) * dx + (y - e.y0) * dy) / n))).otherwise(F.lit(0.0))
    return F.hypot(x - (e.x0 + t * dx), y - (e.y0 + t * dy))


def distance_to_polygon(x, y, poly) -> Column:
    """The least distance to the boundary, inside or out."""
    return F.array_min(F.transform(edges(poly), lambda e: _segment_distance(_c(x), _c(y), e)))


def point_in_polygon(x, y, poly, boundary: str = "raw", tolerance: float = 1e-9) -> Column:
    """Even-odd ray cast.  boundary: raw leaves points on edges to the cast, include and strict decide them."""
    x, y = _c(x), _c(y)
    crosses = lambda e: ((e.y0 > y) != (e.y1 > y)) & (x < (e.x1 - e.x0) * (y - e.y0) / (e.y1 - e.y0) + e.x0)
    inside = F.aggregate(edges(poly), F.lit(False), lambda s, e: s != F.coalesce(crosses(e), F.lit(False)))
    if boundary == "raw":
        return inside
    on = distance_to_polygon(x, y, poly) <= tolerance
    return (inside | on) if boundary == "include" else (inside & ~on)


def in_polygon_with_holes(x, y, poly, holes, boundary: str = "raw") -> Column:
    """Inside the ring and inside none of its holes."""
    return point_in_polygon(x, y, poly, boundary) & ~F.exists(_c(holes), lambda h: point_in_polygon(_c(x), _c(y), h, "strict" if boundary == "include" else "raw"))


def interval_overlap(a0, a1, b0, b1) -> Column:
    return F.greatest(F.lit(0.0), F.least(_c(a1), _c(b1)) - F.greatest(_c(a0), _c(b0)))


def _box_area(b) -> Column:
    return (b.x1 - b.x0) * (b.y1 - b.y0)


def _shared(a, b) -> Column:
    return interval_overlap(a.x0, a.x1, b.x0, b.x1) * interval_overlap(a.y0, a.y1, b.y0, b.y1)


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two struct(x0, y0, x1, y1); 0 where both are empty."""
    union = _box_area(a) + _box_area(b) - _shared(a, b)
    return F.when(union > 0, _shared(a, b) / union).otherwise(F.lit(0.0))


def containment(inside: Column, outer: Column) -> Column:
    """The share of a box that lies in another."""
    return F.when(_box_area(inside) > 0, _shared(inside, outer) / _box_area(inside)).otherwise(F.lit(0.0))


def newell_normal(vertices) -> Column:
    """struct(x, y, z) of array<array<double>> in space; its length is twice the area."""
    p = _c(vertices)
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))

    def add(s, i):
        a, b = F.element_at(p, i), _next(p, i)
        return F.struct((s.x + (a[1] - b[1]) * (a[2] + b[2])).alias("x"), (s.y + (a[2] - b[2]) * (a[0] + b[0])).alias("y"), (s.z + (a[0] - b[0]) * (a[1] + b[1])).alias("z"))

    return F.aggregate(F.sequence(F.lit(1), F.size(p)), zero, add)


def plane_orientation(vertices) -> Column:
    """struct(tilt_deg, azimuth_deg, area): tilt from horizontal, azimuth clockwise from north (y), null when flat."""
    n = newell_normal(vertices)
    length = F.sqrt(n.x * n.x + n.y * n.y + n.z * n.z)
    tilt = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), n.z / F.nullif(length, F.lit(0.0))))))
    az = F.pmod(F.degrees(F.atan2(n.x, n.y)) + 360.0, F.lit(360.0))
    return F.struct(tilt.alias("tilt_deg"), F.when(F.hypot(n.x, n.y) > 1e-9 * length, az).alias("azimuth_deg"), (length / 2).alias("area"))


def shell_volume(faces) -> Column:
    """Signed volume of a closed shell, array of vertex loops, by the divergence theorem over fans of triangles."""

    def of_face(f):
        a = F.element_at(f, 1)
        cross = lambda b, c: a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])
        return F.aggregate(F.sequence(F.lit(2), F.size(f) - 1), F.lit(0.0), lambda s, i: s + cross(F.element_at(f, i), F.element_at(f, i + 1)))

    return F.aggregate(_c(faces), F.lit(0.0), lambda s, f: s + F.when(F.size(f) >= 3, of_face(f)).otherwise(F.lit(0.0))) / 6


def affine(x, y, m: tuple) -> tuple[Column, Column]:
    """(x', y') of a 2 x 3 matrix (a, b, c, d, e, f)."""
    a, b, c, d, e, f = m
    return a * _c(x) + b * _c(y) + c, d * _c(x) + e * _c(y) + f


COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")  # fixed values


def cardinal(degrees) -> Column:
    """Eight half-open sectors of 45 degrees around each direction; null and NaN are unknown."""
    d = _c(degrees).cast("double")
    at = F.floor(F.pmod(d + 22.5, F.lit(360.0)) / 45.0).cast("int") + 1
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit("unknown")).otherwise(F.element_at(F.array(*[F.lit(c) for c in COMPASS]), at))


def quadrant(azimuth) -> Column:
    """N, E, S or W; each from 45 degrees before its direction on."""
    return F.upper(F.substring(facing(azimuth), 1, 1))


def facing(azimuth) -> Column:
    """north, east, south or west; each from 45 degrees before its direction on."""
    at = F.floor(F.pmod(_c(azimuth) + 45.0, F.lit(360.0)) / 90.0)
    return F.when(at == 0, "north").when(at == 1, "east").when(at == 2, "south").when(at == 3, "west")


def orientation_bucket(tilt, azimuth) -> Column:
    """flat below half a degree of tilt (no tilt is none) or without an azimuth, else the quadrant."""
    return F.when((F.coalesce(_c(tilt), F.lit(0.0)) < 0.5) | _c(azimuth).isNull(), F.lit("flat")).otherwise(quadrant(azimuth))


def outward_azimuth(x0, y0, x1, y1) -> Column:
    """Azimuth of the outward normal of an edge of a counter-clockwise ring."""
    return F.pmod(F.degrees(F.atan2(_c(y1) - _c(y0), _c(x0) - _c(x1))) + 360.0, F.lit(360.0))


def plane_normal(tilt, azimuth) -> tuple[Column, Column, Column]:
    t, a = F.radians(_c(tilt)), F.radians(F.coalesce(_c(azimuth), F.lit(0.0)))
    return F.sin(t) * F.sin(a), F.sin(t) * F.cos(a), F.cos(t)
