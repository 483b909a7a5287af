"""Spatial and interval joins over buckets: nothing here is a cross join of rows.

Polygons and intervals are dealt to the grid cells that their bounds touch,
points to theirs, and the exact test runs on rows of one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions import geometry as G


SMALL_SCHEDULE = 10_000


def _cells(x0: Column, x1: Column, size: float) -> Column:
    return F.sequence(F.floor(x0 / size), F.floor(x1 / size))


def points_in_polygons(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, x: str = "x", y: str = "y", polygon: str = "polygon", cell: float = 10.0, boundary: str = "raw", prefer: str = "first", single: bool = False) -> DataFrame:
    """point_id, polygon_id: every point once, null where no polygon holds it.

    prefer: `first` by polygon id or `smallest` by area then id.  With single,
    a point that several polygons hold is null as well.
    """
    b = G.bounds(polygon)
    p = polygons.select(F.col(polygon_id).alias("pid"), F.col(polygon).alias("ring"), b.alias("b"), G.area(polygon).alias("size"))
    p = p.withColumn("cx", F.explode(_cells(F.col("b.x0"), F.col("b.x1"), cell))).withColumn("cy", F.explode(_cells(F.col("b.y0"), F.col("b.y1"), cell)))
    q = points.select(F.col(point_id).alias("qid"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    hit = q.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell)).join(p, ["cx", "cy"]).where(G.point_in_polygon("x", "y", "ring", boundary))
    order = F.struct("pid") if prefer == "first" else F.struct("size", "pid")
    best = hit.groupBy("qid").agg(F.min_by("pid", order).alias("pid"), F.count("*").alias("n"))
    if single:
        best = best.where("n = 1")
    return q.select("qid").join(best.select("qid", "pid"), "qid", "left").select(F.col("qid").alias(point_id), F.col("pid").alias(polygon_id))


def nearest_polygon(points: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, within: float, x: str = "x", y: str = "y", polygon: str = "polygon") -> DataFrame:
    """point_id, polygon_id, distance of the polygon whose boundary is nearest, if within reach; ties by polygon id."""
    b = G.bounds(polygon)
    p = polygons.select(F.col(polygon_id).alias("pid"), F.col(polygon).alias("ring"), b.alias("b"))
    p = p.withColumn("cx", F.explode(_cells(F.col("b.x0") - within, F.col("b.x1") + within, within))).withColumn("cy", F.explode(_cells(F.col("b.y0") - within, F.col("b.y1") + within, within)))
    q = points.select(F.col(point_id).alias("qid"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    met = q.withColumn("cx", F.floor(F.col("x") / within)).withColumn("cy", F.floor(F.col("y") / within)).join(p, ["cx", "cy"]).withColumn("distance", G.distance_to_polygon("x", "y", "ring")).where(F.col("distance") <= within)
    best = met.groupBy("qid").agg(F.min(F.struct("distance", "pid")).alias("m"))
    return best.select(F.col("qid").alias(point_id), F.col("m.pid").alias(polygon_id), F.col("m.distance").alias("distance"))


def label_spaces(spaces: DataFrame, labels: DataFrame, space_id: str, label_id: str, within: float, x: str = "x", y: str = "y", polygon: str = "polygon") -> DataFrame:
    """label_id, space_id, confidence: the smallest space that holds the label (1.0), else the nearest within reach,
    surer the nearer it is (0.7 down to 0.4); null and 0 beyond."""
    inside = points_in_polygons(labels, spaces, label_id, space_id, x, y, polygon, prefer="smallest")
    missed = labels.join(inside.where(F.col(space_id).isNull()).select(label_id), label_id, "left_semi")
    near = nearest_polygon(missed, spaces, label_id, space_id, within, x, y, polygon).select(label_id, F.col(space_id).alias("near"), "distance")
    out = inside.join(near, label_id, "left")
    conf = F.when(F.col(space_id).isNotNull(), 1.0).when(F.col("near").isNotNull(), 0.7 - 0.3 * F.col("distance") / within).otherwise(0.0)
    return out.select(label_id, F.coalesce(F.col(space_id), F.col("near")).alias(space_id), conf.alias("confidence"))


def match_intervals(spans: DataFrame, segments: DataFrame, span_id: str, segment_id: str, bucket: float, by: list[str] = (), lo: str = "s0", hi: str = "s1") -> DataFrame:
    """span_id, segment_id, fraction, ambiguous: the segment that covers most of each span.

    Every span once; no overlap gives a null segment and fraction 0.  The match
    is ambiguous if it covers under half of the span or leads the next by under a fifth.
    """
    by = list(by)
    s = segments.select(*by, F.col(segment_id).alias("sid"), F.col(lo).alias("t0"), F.col(hi).alias("t1")).withColumn("cell", F.explode(_cells(F.col("t0"), F.col("t1"), bucket)))
    q = spans.select(*by, F.col(span_id).alias("qid"), F.col(lo).alias("q0"), F.col(hi).alias("q1"))
    met = q.withColumn("cell", F.explode(_cells(F.col("q0"), F.col("q1"), bucket))).join(s, [*by, "cell"]).dropDuplicates(["qid", "sid"])
    met = met.withColumn("fraction", F.when(F.col("q1") > F.col("q0"), G.interval_overlap("q0", "q1", "t0", "t1") / (F.col("q1") - F.col("q0"))).otherwise(0.0)).where("fraction > 0")
    w = Window.partitionBy("qid").orderBy(F.desc("fraction"), "sid")
    top = met.withColumn("r", F.row_number().over(w)).withColumn("second", F.lead("fraction", 1, 0.0).over(w)).where("r = 1")
    out = q.select("qid").join(top.select("qid", "sid", "fraction", "second"), "qid", "left")
    sure = (F.col("fraction") >= 0.5) & (F.col("fraction") - F.col("second") >= 0.2)
    return out.select(F.col("qid").alias(span_id), F.col("sid").alias(segment_id), F.coalesce("fraction", F.lit(0.0)).alias("fraction"), F.coalesce(~sure, F.lit(True)).alias("ambiguous"))


def size_candidates(items: DataFrame, schedule: DataFrame, item_id: str, within: float = 0.15, w: str = "width_m", h: str = "height_m", tag: str = "tag") -> DataFrame:
    """item_id, tag, distance, rank: schedule rows whose width and height lie within a distance, nearest first.

    A schedule's rows go to nine cells, an item to one.  A schedule of up to SMALL_SCHEDULE rows is broadcast; beyond,
    both sides are sorted.  Items are never broadcast: their files tell Spark little of their size.
    """
    cells = lambda c, d: F.explode(F.array(*[F.floor(F.col(c) / within) + k for k in d]))
    s = schedule.select(F.col(tag).alias("tag"), F.col(w).alias("sw"), F.col(h).alias("sh"))
    how = "broadcast" if s.limit(SMALL_SCHEDULE + 1).count() <= SMALL_SCHEDULE else "merge"
    s = s.withColumn("cw", cells("sw", (-1, 0, 1))).withColumn("ch", cells("sh", (-1, 0, 1)))
    i = items.select(F.col(item_id), F.col(w).alias("w"), F.col(h).alias("h")).withColumn("cw", F.floor(F.col("w") / within)).withColumn("ch", F.floor(F.col("h") / within))
    met = i.join(s.hint(how), ["cw", "ch"]).withColumn("distance", F.hypot(F.col("w") - F.col("sw"), F.col("h") - F.col("sh"))).where(F.col("distance") <= within)
    return met.withColumn("rank", F.row_number().over(Window.partitionBy(item_id).orderBy("distance", "tag"))).select(item_id, "tag", "distance", "rank")


def adjudicate(candidates: DataFrame, item_id: str, policy: str = "nearest", source: str = "method", preferred: str | None = None) -> DataFrame:
    """One tag for each item: the nearest, that of the preferred method first, or (keep_both) all tags joined by commas."""
    if policy == "keep_both":
        return candidates.groupBy(item_id).agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tag"))
    first = [F.col(source) != preferred] if preferred else []
    w = Window.partitionBy(item_id).orderBy(*first, "distance", "tag")
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(item_id, "tag")


def met_boxes(a: DataFrame, b: DataFrame, by: list[str], cell: float, id: str = "id", box: str = "box") -> DataFrame:
    """by, a, b, a_box, b_box: the boxes (structs of x0, y0, x1, y1) of one group that touch a common grid cell.

    Every pair whose boxes overlap is there once: in the cell where their common part begins.
    """

    def side(t: DataFrame, s: str) -> DataFrame:
        x = F.col(f"{s}_box")
        t = t.select(*by, F.col(id).alias(s), F.col(box).alias(f"{s}_box"))
        return t.withColumn("cx", F.explode(_cells(x.x0, x.x1, cell))).withColumn("cy", F.explode(_cells(x.y0, x.y1, cell)))

    j = side(a, "a").join(side(b, "b"), [*by, "cx", "cy"])
    begin = lambda c: F.floor(F.greatest(F.col(f"a_box.{c}"), F.col(f"b_box.{c}")) / cell)
    return j.where((F.col("cx") == begin("x0")) & (F.col("cy") == begin("y0"))).drop("cx", "cy")


def box_pairs(rows: DataFrame, by: list[str], cell: float, least: float, id: str = "id", box: str = "box") -> DataFrame:
    """by, a, b, iou: the pairs of boxes of one group whose intersection is at least that share of their union."""
    j = met_boxes(rows, rows, by, cell, id, box).where("a < b")
    return j.withColumn("iou", G.box_iou(F.col("a_box"), F.col("b_box"))).where(F.col("iou") >= least).select(*by, "a", "b", "iou")


def overlapping_pairs(rows: DataFrame, by: list[str], id: str, bucket: float, lo: str = "s0", hi: str = "s1") -> DataFrame:
    """by, a, b, overlap: pairs of intervals of one group that overlap."""
    r = rows.select(*by, F.col(id).alias("id"), F.col(lo).alias("lo"), F.col(hi).alias("hi")).withColumn("cell", F.explode(_cells(F.col("lo"), F.col("hi"), bucket)))
    a, b = r.alias("a"), r.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*by, "cell"]]
    overlap = G.interval_overlap("a.lo", "a.hi", "b.lo", "b.hi")
    # Each pair in the first cell that both touch only.
    first = F.col("a.cell") == F.floor(F.greatest("a.lo", "b.lo") / bucket)
    return a.join(b, same).where((F.col("a.id") < F.col("b.id")) & first & (overlap > 0)).select(*[F.col(f"a.{c}").alias(c) for c in by], F.col("a.id").alias("a"), F.col("b.id").alias("b"), overlap.alias("overlap"))
