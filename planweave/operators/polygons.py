"""Operations over whole polygons or sets of them, group by group, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_area(polygons: list) -> float:
    """The area covered by any of the polygons, overlaps once: slabs between all vertices and crossings.

    Edges that aren't upright lie in arrays; every slab looks at the edges that
    span it only.
    """
    rings = [np.asarray([list(map(float, v)) for v in p]) for p in polygons if p is not None and len(p) >= 3]
    if not rings:
        return 0.0
    a, b = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    owner = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    cuts = [np.unique(a[:, 0])]
    keep = a[:, 0] != b[:, 0]
    a, b, owner = a[keep], b[keep], owner[keep]
    swap = a[:, 0] > b[:, 0]
    a[swap], b[swap] = b[swap], a[swap].copy()
    order = np.argsort(a[:, 0], kind="stable")
    a, b, owner = a[order], b[order], owner[order]
    slope = (b[:, 1] - a[:, 1]) / (b[:, 0] - a[:, 0])
    for i in range(len(a)):
        j = np.arange(i + 1, np.searchsorted(a[:, 0], b[i, 0], "left"))
        j = j[np.abs(slope[j] - slope[i]) > 1e-15]
        x = (a[i, 1] - a[j, 1] + slope[j] * a[j, 0] - slope[i] * a[i, 0]) / (slope[j] - slope[i])
        cuts.append(x[(x > np.maximum(a[i, 0], a[j, 0])) & (x < np.minimum(b[i, 0], b[j, 0]))])
    xs = np.unique(np.concatenate(cuts))
    total = 0.0
    for x0, x1 in zip(xs, xs[1:]):
        mid = (x0 + x1) / 2
        at = np.flatnonzero((a[:, 0] < mid) & (b[:, 0] > mid))
        height = a[at, 1] + slope[at] * (mid - a[at, 0])
        at = at[np.lexsort((height, owner[at]))]
        height = a[at, 1] + slope[at] * (mid - a[at, 0])
        spans = np.stack([height[::2], height[1::2]], axis=1)
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        reach = np.maximum.accumulate(spans[:, 1]) if len(spans) else spans[:, 0]
        before = np.concatenate([[-np.inf], reach[:-1]]) if len(spans) else reach
        total += float(np.maximum(0.0, reach - np.maximum(before, spans[:, 0])).sum()) * (x1 - x0)
    return total


def convex_hull(points: list) -> list:
    """Counter-clockwise hull without the points on its edges."""
    pts = sorted({(float(x), float(y)) for x, y in points})
    if len(pts) < 3:
        return [list(p) for p in pts]
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def half(ps):
        out: list = []
        for p in ps:
            while len(out) >= 2 and cross(out[-2], out[-1], p) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return [list(p) for p in half(pts) + half(pts[::-1])]


def clip_convex(subject: list, clip: list) -> list:
    """The part of a polygon inside a convex one (counter-clockwise)."""
    out = [tuple(map(float, p)) for p in subject]
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1]):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        now, out = out, []
        for p, q in zip(now, now[1:] + now[:1]):
            s, t = side(p), side(q)
            if s >= 0:
                out.append(p)
            if (s < 0) != (t < 0):
                k = s / (s - t)
                out.append((p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])))
    return [list(p) for p in out]


def _area(p) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(p, p[1:] + p[:1])) / 2


def simplify_ring(ring: list, budget: float) -> list:
    """Vertices go one by one, that of the smallest triangle first, while the area they changed together stays within
    `budget` times the ring's and no edge crosses another."""
    pts = [tuple(map(float, p)) for p in ring]
    whole, spent = abs(_area(pts)), 0.0
    kept = True
    blocked: set = set()
    while kept and len(pts) > 3:
        kept = False
        tri = sorted((abs(_area([pts[i - 1], pts[i], pts[(i + 1) % len(pts)]])), i) for i in range(len(pts)) if pts[i] not in blocked)
        for a, i in tri:
            if spent + a > budget * whole:
                break
            p, q = pts[i - 1], pts[(i + 1) % len(pts)]
            if any(_crosses(p, q, pts[k - 1], pts[k]) for k in range(len(pts)) if len({p, q, pts[k - 1], pts[k]}) == 4):
                blocked.add(pts[i])
                continue
            pts.pop(i)
            spent += a
            kept = True
            break
    return [list(p) for p in pts]


def _crosses(a, b, c, d) -> bool:
    s = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    return s(a, b, c) * s(a, b, d) < 0 and s(c, d, a) * s(c, d, b) < 0


def split_polygon(ring: list, a: tuple, b: tuple) -> list:
    """A convex polygon's two parts on either side of the line from a to b; one part if the line misses it."""
    side = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    left, right = [], []
    for p, q in zip(ring, ring[1:] + ring[:1]):
        s, t = side(p), side(q)
        if s >= 0:
            left.append(list(p))
        if s <= 0:
            right.append(list(p))
        if s * t < 0:
            k = s / (s - t)
            m = [p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])]
            left.append(m)
            right.append(m)
    return [p for p in (left, right) if len(p) >= 3 and abs(_area(p)) > 1e-12]


def _convex(ring: list) -> bool:
    turns = [(q[0] - p[0]) * (r[1] - q[1]) - (q[1] - p[1]) * (r[0] - q[0]) for p, q, r in zip(ring, ring[1:] + ring[:1], ring[2:] + ring[:2])]
    return all(t >= -1e-9 for t in turns)


def _under(ring: list, f) -> list:
    """The part of a ring where a linear function is 0 or less."""
    out = []
    for p, q in zip(ring, ring[1:] + ring[:1]):
        s, t = f(p), f(q)
        if s <= 0:
            out.append(list(p))
        if (s < 0 < t) or (t < 0 < s):
            k = s / (s - t)
            out.append([p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])])
    return out


def perimeter_core(ring: list, depth: float) -> list:
    """(orientation, polygon) of a convex ring's zones: along each side what lies within `depth` of it and nearest to it, then the core.

    A ring that is narrower is all perimeter; one that isn't convex comes back whole as `unsplit`.
    """
    pts = [[float(x), float(y)] for x, y in ring]
    if _area(pts) < 0:
        pts.reverse()
    if not _convex(pts):
        return [("unsplit", pts)]
    sides = []
    for (ax, ay), (bx, by) in zip(pts, pts[1:] + pts[:1]):
        n = float(np.hypot(bx - ax, by - ay))
        if n > 1e-12:
            # Distance inside the side, and the quarter that it faces.
            sides.append(((-(by - ay) / n, (bx - ax) / n, ((by - ay) * ax - (bx - ax) * ay) / n), ("north", "east", "south", "west")[int((np.degrees(np.arctan2(by - ay, ax - bx)) % 360 + 45) % 360 // 90)]))
    inside = lambda s: lambda p: s[0] * p[0] + s[1] * p[1] + s[2]
    zones, core = [], pts
    for i, (s, facing) in enumerate(sides):
        d = inside(s)
        zone = _under(pts, lambda p: d(p) - depth)  # noqa: B023
        for j, (o, _) in enumerate(sides):
            if j != i and zone:
                e = inside(o)
                zone = _under(zone, lambda p: d(p) - e(p))  # noqa: B023
        if len(zone) >= 3 and abs(_area(zone)) > 1e-9:
            zones.append((facing, zone))
        core = _under(core, lambda p: depth - d(p)) if core else core  # noqa: B023
    return zones + ([("core", core)] if len(core) >= 3 and abs(_area(core)) > 1e-9 else [])


def joined_ring(rings: list) -> list:
    """The outline of rings that touch along their edges and don't overlap: edges used both ways go, the others make one ring.

    Edges are cut at the corners that lie on them first.  Of several outlines
    the one with the largest area is the outline; without any, the first ring.
    """
    rings = [[(round(float(x), 6), round(float(y), 6)) for x, y in r] for r in rings if r is not None and len(r) >= 3]
    rings = [r if _area(r) > 0 else r[::-1] for r in rings]
    corners = {p for r in rings for p in r}
    edges: dict[tuple, int] = {}
    for r in rings:
        for p, q in zip(r, r[1:] + r[:1]):
            dx, dy = q[0] - p[0], q[1] - p[1]
            n = dx * dx + dy * dy
            on = sorted((t, c) for c in corners if n > 0 and abs(dx * (c[1] - p[1]) - dy * (c[0] - p[0])) <= 1e-6 * n**0.5 and 0 < (t := (dx * (c[0] - p[0]) + dy * (c[1] - p[1])) / n) < 1)
            for a, b in zip([p, *(c for _, c in on)], [*(c for _, c in on), q]):
                if a == b:
                    continue
                if edges.get((b, a)):
                    edges[b, a] -= 1
                else:
                    edges[a, b] = edges.get((a, b), 0) + 1
    after: dict[tuple, list] = {}
    for (a, b), n in edges.items():
        after.setdefault(a, []).extend([b] * n)
    best: list = []
    while any(after.values()):
        start = min(a for a, b in after.items() if b)
        loop, at = [start], after[start].pop()
        while at != start and after.get(at):
            loop.append(at)
            at = after[at].pop()
        straight = [q for p, q, r in zip(loop[-1:] + loop[:-1], loop, loop[1:] + loop[:1]) if abs((q[0] - p[0]) * (r[1] - q[1]) - (q[1] - p[1]) * (r[0] - q[0])) > 1e-9]
        if len(straight) >= 3 and (not best or abs(_area(straight)) > abs(_area(best))):
            best = straight
    return [list(p) for p in best or (rings[0] if rings else [])]


def union_areas(rows: DataFrame, by: list[str], polygon: str = "polygon") -> DataFrame:
    """by, n, union_area: the area each group's polygons cover, overlaps once."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*by).schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[*(pdf[c].iloc[0] for c in by), len(pdf), union_area([list(p) for p in pdf[polygon]])]], columns=[*by, "n", "union_area"])

    return rows.select(*by, polygon).groupBy(*by).applyInPandas(run, f"{fields}, n bigint, union_area double")


def mapped(rows: DataFrame, function, polygon: str = "polygon", out: str = "out") -> DataFrame:
    """rows with a ring that `function` makes of each row's."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda p: None if p is None else function([list(map(float, v)) for v in p]))

    return rows.withColumn(out, F.pandas_udf(run, "array<array<double>>")(polygon))


def non_max(rows: DataFrame, by: list[str], id: str, score: str, boxes: tuple = ("x0", "y0", "x1", "y1"), iou: float = 0.5) -> DataFrame:
    """by, id of the boxes that greedy suppression keeps in each group, best score first, ties by id."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*by, id).schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, id], ascending=[False, True], kind="stable")
        b = pdf[list(boxes)].to_numpy(float)
        size = (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])
        keep: list[int] = []
        for i in range(len(b)):
            k = np.array(keep, int)
            w = np.minimum(b[i, 2], b[k, 2]) - np.maximum(b[i, 0], b[k, 0])
            h = np.minimum(b[i, 3], b[k, 3]) - np.maximum(b[i, 1], b[k, 1])
            shared = np.clip(w, 0, None) * np.clip(h, 0, None)
            if not len(k) or (shared < iou * (size[i] + size[k] - shared)).all():
                keep.append(i)
        return pdf.iloc[keep][[*by, id]]

    return rows.groupBy(*by).applyInPandas(run, fields)


# The year's days, by the sun's declination in degrees: both solstices and an equinox (fixed values).
DECLINATIONS = (-23.45, 0.0, 23.45)


def sun_vectors(latitude_deg: float) -> list[tuple[float, float, float]]:
    """Unit vectors (east, north, up) to the sun at each hour of the solstices and an equinox, above the horizon only.

    The sun's place relative to the equator and the meridian is turned into the
    horizon's axes by one rotation about the east-west axis.
    """
    if not -90 <= latitude_deg <= 90:
        raise ValueError("latitude must lie between -90 and 90")
    turn, day = np.meshgrid(np.arange(24) * 2 * np.pi / 24 - np.pi, np.radians(DECLINATIONS))
    equatorial = np.stack([np.cos(day) * np.cos(turn), -np.cos(day) * np.sin(turn), np.sin(day)]).reshape(3, -1)  # to the meridian, east, to the pole
    phi = np.radians(latitude_deg)
    horizon = np.array([[0.0, 1.0, 0.0], [-np.sin(phi), 0.0, np.cos(phi)], [np.cos(phi), 0.0, np.sin(phi)]]) @ equatorial
    return [tuple(v) for v in horizon.T[horizon[2] > 1e-9].tolist()]


def solar_aperture(planes: DataFrame, latitude_deg: float, tilt: str = "tilt_deg", azimuth: str = "azimuth_deg", area: str = "area_m2") -> DataFrame:
    """orientation, aperture: area times the cosines to all sun positions, none below 0."""
    from planweave.functions.geometry import orientation_bucket, plane_normal

    x, y, z = plane_normal(tilt, azimuth)
    suns = F.expr(f"array({', '.join(f"named_struct('x', {a!r}D, 'y', {b!r}D, 'z', {c!r}D)" for a, b, c in sun_vectors(latitude_deg))})")
    each = F.aggregate(suns, F.lit(0.0), lambda s, v: s + F.greatest(F.lit(0.0), v.x * x + v.y * y + v.z * z))
    return planes.groupBy(orientation_bucket(tilt, azimuth).alias("orientation")).agg(F.sum(F.col(area) * each).alias("aperture"))
