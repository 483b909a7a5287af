"""Rooms next to, above and inside each other, from shared wall segments and overlapping outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.operators.linking import pairwise_boundary
from planweave.operators.ordered import guarded_best


def wall_segments(spaces: DataFrame, by: list[str], id: str = "id", polygon: str = "polygon_m", digits: int = 3) -> DataFrame:
    """by, id, line, lo, hi: every edge on its (rounded) carrier line, as an interval along it."""
    e = spaces.select(*by, F.col(id).alias("id"), F.explode(G.edges(polygon)).alias("e")).select(*by, "id", "e.*")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = F.hypot(dx, dy)
    flip = F.when((dx < -1e-9) | ((F.abs(dx) <= 1e-9) & (dy < 0)), -1.0).otherwise(1.0)
    ux, uy = dx / n * flip, dy / n * flip
    e = e.where(n > 1e-9).withColumn("ux", F.round(ux, digits) + 0.0).withColumn("uy", F.round(uy, digits) + 0.0).withColumn("off", F.round(F.col("x0") * uy - F.col("y0") * ux, digits) + 0.0)
    s, t = F.col("x0") * ux + F.col("y0") * uy, F.col("x1") * ux + F.col("y1") * uy
    return e.select(*by, "id", F.concat_ws("|", F.col("ux").cast("string"), F.col("uy").cast("string"), F.col("off").cast("string")).alias("line"), F.least(s, t).alias("lo"), F.greatest(s, t).alias("hi"))


def shared_walls(spaces: DataFrame, by: list[str], id: str = "id", polygon: str = "polygon_m", least: float = 1e-3) -> DataFrame:
    """by, a, b, length: how much wall two rooms of a level share, each pair once."""
    w = wall_segments(spaces, by, id, polygon)
    c = lambda s: w.select(*by, "line", *[F.col(x).alias(f"{x}_{s}") for x in ("id", "lo", "hi")])
    j = c("a").join(c("b"), [*by, "line"]).where("id_a < id_b")
    return j.groupBy(*by, F.col("id_a").alias("a"), F.col("id_b").alias("b")).agg(F.sum(G.interval_overlap("lo_a", "hi_a", "lo_b", "hi_b")).alias("length")).where(F.col("length") > least)


def semi_exterior_boundaries(spaces: DataFrame, by: list[str], category: str = "category", id: str = "id", polygon: str = "polygon_m") -> DataFrame:
    """by, a, b, length, kind, reason: walls between conditioned and other rooms, and those that can't be told."""
    s = shared_walls(spaces, by, id, polygon)
    c = lambda x: spaces.select(F.col(id).alias(x), F.col(category).alias(f"c_{x}"))
    j = s.join(c("a"), "a").join(c("b"), "b")
    return j.select(*by, "a", "b", "length", pairwise_boundary(F.col("c_a"), F.col("c_b")).alias("k")).select(*by, "a", "b", "length", "k.*").where("kind is not null")


def merge_targets(spaces: DataFrame, small: DataFrame, by: list[str], id: str = "id", polygon: str = "polygon_m", guard: float = 0.005) -> DataFrame:
    """id, target, share, reason: the room that shares most of a shaft's or closet's wall, unless another comes within the guard."""
    s = shared_walls(spaces, by, id, polygon)
    both = s.select("a", "b", "length").unionByName(s.select(F.col("b").alias("a"), F.col("a").alias("b"), "length"))
    mine = both.join(small.select(F.col(id).alias("a")), "a", "left_semi").join(small.select(F.col(id).alias("b")), "b", "left_anti")
    around = spaces.select(F.col(id).alias("a"), G.perimeter(polygon).alias("p"))
    shares = mine.join(around, "a").select("a", F.col("b").alias("target"), (F.col("length") / F.nullif("p", F.lit(0.0))).alias("share"))
    best = guarded_best(shares, ["a"], "share", "target", guard)
    return small.select(F.col(id).alias("a")).join(best, "a", "left").select(F.col("a").alias(id), "target", "share", F.when(F.col("share").isNull(), F.lit("no neighbour")).otherwise(F.col("reason")).alias("reason"))


def merged(spaces: DataFrame, small: DataFrame, by: list[str], id: str = "id", polygon: str = "polygon_m", guard: float = 0.005) -> tuple[DataFrame, DataFrame]:
    """(by, id, outline, area_m2 and absorbed ids of the rooms left; the small ones that stay, with why).

    A shaft or closet goes into the room that shares most of its wall, the two outlines becoming one.
    """
    from planweave.operators.polygons import joined_ring

    to = merge_targets(spaces, small, by, id, polygon, guard)
    gone = to.where("target is not null").select(F.col(id), "target")
    taken = spaces.join(gone, id).groupBy(F.col("target").alias(id)).agg(F.collect_list(polygon).alias("_rings"), F.array_sort(F.collect_list(id)).alias("absorbed"))

    @F.pandas_udf("array<array<double>>")
    def outline(own, others):
        return own.combine(others, lambda p, o: joined_ring([p, *o]))

    left = spaces.join(gone.select(id), id, "left_anti").join(taken, id, "left")
    ring = F.when(F.col("_rings").isNotNull(), outline(polygon, F.coalesce("_rings", F.array().cast(spaces.schema[polygon].dataType.simpleString().join(("array<", ">")))))).otherwise(F.col(polygon))
    left = left.withColumn(polygon, ring)
    kind = spaces.schema[id].dataType.simpleString()
    return left.select(*by, id, polygon, G.area(polygon).alias("area_m2"), F.coalesce("absorbed", F.array().cast(f"array<{kind}>")).alias("absorbed")), to.where("target is null").select(id, "reason")


def overlaps(a: DataFrame, b: DataFrame, by: list[str], cell: float, id: str = "id", polygon: str = "polygon_m") -> DataFrame:
    """by, a, b, area, area_a, area_b of pairs of convex outlines that overlap, found over grid cells."""
    from planweave.operators.polygons import _area, clip_convex

    def side(t: DataFrame, s: str) -> DataFrame:
        x = G.bounds(polygon)
        t = t.select(*by, F.col(id).alias(s), G.counter_clockwise(polygon).alias(f"p_{s}"), x.alias("x"))
        return t.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x.x0") / cell), F.floor(F.col("x.x1") / cell)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("x.y0") / cell), F.floor(F.col("x.y1") / cell)))).drop("x")

    j = side(a, "a").join(side(b, "b"), [*by, "cx", "cy"]).drop("cx", "cy").dropDuplicates([*by, "a", "b"])

    @F.pandas_udf("double")
    def shared(x, y):
        clean = lambda p: [list(map(float, v)) for v in p]
        return x.combine(y, lambda p, q: abs(_area(c)) if len(c := clip_convex(clean(p), clean(q))) >= 3 else 0.0)

    return j.withColumn("area", shared("p_a", "p_b")).where("area > 1e-9").select(*by, "a", "b", "area", G.area("p_a").alias("area_a"), G.area("p_b").alias("area_b"))


def interstory(spaces: DataFrame, levels: DataFrame, cell: float = 10.0, id: str = "id") -> DataFrame:
    """below, above, area, kind: floors over rooms of the level below (interior), what of a room has nothing above (roof)
    and what of a room has nothing below (exposed floor, or ground on the lowest level)."""
    rank = levels.withColumn("rank", F.row_number().over(Window.orderBy("elevation_z_m", "id"))).select(F.col("id").alias("level_id"), "rank")
    s = spaces.join(rank, "level_id")
    up = s.withColumn("rank", F.col("rank") + 1)
    o = overlaps(up, s, ["rank"], cell, id)
    inside = o.select(F.col("a").alias("below"), F.col("b").alias("above"), "area", F.lit("interior").alias("kind"))
    area = s.select(F.col(id).alias("s"), "rank", G.area("polygon_m").alias("whole"))
    covered = o.groupBy(F.col("a").alias("s")).agg(F.sum("area").alias("c"))
    borne = o.groupBy(F.col("b").alias("s")).agg(F.sum("area").alias("c"))
    left = lambda x: (F.col("whole") - F.coalesce("c", F.lit(0.0))).alias("area")  # noqa: E731, ARG005
    roof = area.join(covered, "s", "left").select(F.col("s").alias("below"), F.lit(None).cast("string").alias("above"), left("c"), F.lit("roof").alias("kind"))
    floor = area.join(borne, "s", "left").select(F.lit(None).cast("string").alias("below"), F.col("s").alias("above"), left("c"), F.when(F.col("rank") == 1, "ground").otherwise("exposed_floor").alias("kind"))
    return inside.unionByName(roof.where("area > 1e-6")).unionByName(floor.where("area > 1e-6"))


def shaft_stacks(shafts: DataFrame, levels: DataFrame, least: float = 0.8, cell: float = 10.0, id: str = "id") -> DataFrame:
    """id, stack: shafts of adjacent levels whose outlines agree, chained; ids must be numbers."""
    from planweave.operators.components import connected_components

    rank = levels.withColumn("rank", F.row_number().over(Window.orderBy("elevation_z_m", "id"))).select(F.col("id").alias("level_id"), "rank")
    s = shafts.join(rank, "level_id")
    o = overlaps(s.withColumn("rank", F.col("rank") + 1), s, ["rank"], cell, id)
    links = o.where(F.col("area") >= least * (F.col("area_a") + F.col("area_b") - F.col("area"))).select("a", "b")
    labels = connected_components(links)
    return shafts.select(F.col(id)).join(labels.withColumnRenamed("node", id), id, "left").select(id, F.coalesce("component", id).alias("stack"))


def majority_blocks(spaces: DataFrame, blocks: DataFrame, by: list[str], cell: float = 10.0, id: str = "id") -> DataFrame:
    """space, block, share: the block that most of a space lies in."""
    o = overlaps(spaces, blocks, by, cell, id)
    return o.groupBy(F.col("a").alias("space")).agg(F.max_by("b", F.struct("area", "b")).alias("block"), F.max(F.col("area") / F.col("area_a")).alias("share"))


def glazing_ratio(walls: DataFrame, openings: DataFrame, roofs: DataFrame | None = None) -> DataFrame:
    """wwr_pct, srr_pct, rounded; null where walls or roofs aren't known; interior openings don't count."""
    a = F.coalesce("area_m2", F.col("width_m") * F.col("height_m"))
    o = openings.where("coalesce(interior, false) = false").agg(F.sum(F.when(F.col("category") == "window", a)).alias("w"), F.sum(F.when(F.col("category") == "skylight", a)).alias("s"))
    t = walls.agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("a"))
    r = (roofs.agg(F.sum("area_m2").alias("r")) if roofs is not None else walls.sparkSession.range(1).select(F.lit(None).cast("double").alias("r")))
    pct = lambda n, d: F.round(100 * F.coalesce(F.col(n), F.lit(0.0)) / F.nullif(F.col(d), F.lit(0.0)), 2)
    return o.crossJoin(t).crossJoin(r).select(pct("w", "a").alias("wwr_pct"), pct("s", "r").alias("srr_pct"))


def facade_takeoff(pixels: DataFrame, by: str, kind: str = "kind", x: str = "x", width_m: str | None = None, height_m: str | None = None, y: str = "y") -> DataFrame:
    """by, wwr, door_share, m_per_px, window_m2, warning: shares of the wall plane; metres only with a stated width.

    A stated height only checks the width's scale: off by over 5 % is a warning.
    """
    plane = F.count_if(F.col(kind).isin("wall", "window", "door"))
    n = lambda k: F.count_if(F.col(kind) == k)
    w = F.max(width_m) if width_m else F.lit(None).cast("double")
    h = F.max(height_m) if height_m else F.lit(None).cast("double")
    g = pixels.groupBy(by).agg(plane.alias("plane"), n("window").alias("win"), n("door").alias("door"), (F.max(x) - F.min(x) + 1).alias("bw"), (F.max(y) - F.min(y) + 1).alias("bh"), w.alias("w"), h.alias("h"))
    m = F.col("w") / F.nullif("bw", F.lit(0))
    off = F.abs(F.col("h") / F.nullif("bh", F.lit(0)) / m - 1) > 0.05
    return g.select(by, (F.col("win") / F.nullif("plane", F.lit(0))).alias("wwr"), (F.col("door") / F.nullif("plane", F.lit(0))).alias("door_share"), m.alias("m_per_px"), (F.col("win") * m * m).alias("window_m2"), F.when(off, F.lit("height disagrees")).alias("warning"))


def ground_at(points: DataFrame, triangles: DataFrame, cell: float = 10.0) -> DataFrame:
    """id, z: the highest triangle's height at each point, null where none covers it.

    triangles: corners as x0, y0, z0 ... x2, y2, z2; points: id, x, y.
    """
    t = triangles.withColumn("det", F.expr("(y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2)")).where("abs(det) > 1e-12")
    lo, hi = (lambda a: F.floor(F.least(*[f"{a}{i}" for i in range(3)]) / cell)), (lambda a: F.floor(F.greatest(*[f"{a}{i}" for i in range(3)]) / cell))
    t = t.withColumn("cx", F.explode(F.sequence(lo("x"), hi("x")))).withColumn("cy", F.explode(F.sequence(lo("y"), hi("y"))))
    q = points.select("id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    j = q.join(t, ["cx", "cy"]).withColumn("a", F.expr("((y1 - y2) * (x - x2) + (x2 - x1) * (y - y2)) / det")).withColumn("b", F.expr("((y2 - y0) * (x - x2) + (x0 - x2) * (y - y2)) / det"))
    z = j.where("a >= -1e-9 and b >= -1e-9 and a + b <= 1 + 1e-9").groupBy("id").agg(F.max(F.expr("a * z0 + b * z1 + (1 - a - b) * z2")).alias("z"))
    return points.select("id").join(z, "id", "left")


def wall_by_grade(profile: DataFrame, walls: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """id, kind: UndergroundWall where the ground is nowhere under a wall's top, ExteriorWall where it is nowhere over its base, else Split; null without a profile.

    profile: wall, z; walls: id, z0, z1.
    """
    p = profile.groupBy(F.col("wall").alias("id")).agg(F.min("z").alias("lo"), F.max("z").alias("hi"), F.count_if(F.col("z").isNull()).alias("gaps"))
    kind = F.when(F.col("lo") >= F.col("z1") - tolerance, "UndergroundWall").when(F.col("hi") <= F.col("z0") + tolerance, "ExteriorWall").otherwise("Split")
    return walls.join(p, "id", "left").select("id", F.when(F.col("lo").isNotNull() & (F.col("gaps") == 0), kind).alias("kind"))


def skylit_areas(spaces: DataFrame, skylights: DataFrame, spread: float = 0.7) -> DataFrame:
    """space_id, skylight, area_m2 of the rectangle under each skylight, wider by the ceiling's height times `spread`, inside its room's outline; null where it can't be placed.

    spaces: id, polygon_m (convex), ceiling_m; skylights: id, space_id, cx, cy, width_m, height_m.
    """
    from planweave.functions.geometry import area as area_of
    from planweave.operators.polygons import clip_convex

    s = spaces.select(F.col("id").alias("space_id"), G.counter_clockwise("polygon_m").alias("room"), "ceiling_m")
    j = skylights.select(F.col("id").alias("skylight"), "space_id", "cx", "cy", "width_m", "height_m").join(s, "space_id", "left")
    hw, hh = F.col("width_m") / 2 + spread * F.col("ceiling_m"), F.col("height_m") / 2 + spread * F.col("ceiling_m")
    v = lambda x, y: F.array(F.col("cx") + x, F.col("cy") + y)
    ok = (F.col("ceiling_m") > 0) & (F.col("width_m") > 0) & (F.col("height_m") > 0) & F.col("cx").isNotNull() & F.col("cy").isNotNull() & (F.size("room") >= 3)

    @F.pandas_udf("array<array<double>>")
    def clipped(zone, room):
        return zone.combine(room, lambda z, r: None if z is None or r is None else clip_convex([list(map(float, p)) for p in z], [list(map(float, p)) for p in r]))

    lit = j.withColumn("zone", F.when(ok, F.array(v(-hw, -hh), v(hw, -hh), v(hw, hh), v(-hw, hh)))).withColumn("zone", clipped("zone", "room"))
    area = area_of("zone")
    return lit.select("space_id", "skylight", F.when(F.col("zone").isNotNull() & (area > 0), F.round(area, 4)).alias("area_m2"))


def open_borders(spaces: DataFrame, by: list[str], walls: DataFrame, id: str = "id", polygon: str = "polygon_m", least: float = 0.3) -> DataFrame:
    """by, a, b, length: edges that two rooms share where no wall lies along them, at least `least` long.

    walls: by, line, lo, hi, on the same carrier lines as wall_segments().
    """
    w = wall_segments(spaces, by, id, polygon)
    c = lambda s: w.select(*by, "line", *[F.col(x).alias(f"{x}_{s}") for x in ("id", "lo", "hi")])
    j = c("a").join(c("b"), [*by, "line"]).where("id_a < id_b").withColumn("lo", F.greatest("lo_a", "lo_b")).withColumn("hi", F.least("hi_a", "hi_b")).where("hi > lo")
    blocked = j.join(walls.select(*by, "line", F.col("lo").alias("w0"), F.col("hi").alias("w1")), [*by, "line"], "left")
    cover = F.sum(F.when(F.col("w0").isNotNull(), F.greatest(F.lit(0.0), F.least("hi", "w1") - F.greatest("lo", "w0"))))
    g = blocked.groupBy(*by, F.col("id_a").alias("a"), F.col("id_b").alias("b"), "line", "lo", "hi").agg(F.coalesce(cover, F.lit(0.0)).alias("covered"))
    return g.withColumn("length", F.col("hi") - F.col("lo") - F.col("covered")).where(F.col("length") >= least).groupBy(*by, "a", "b").agg(F.sum("length").alias("length"))
