"""Spatial, interval and geometry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.operators import ordered as W
from planweave.operators import polygons as P
from planweave.operators import spatial as S
from planweave.plans.registry import query

# Points: two components of each vector, scaled.  Rooms: three polygons that overlap in places.
_ROOMS = {"A": [[0.0, 0.0], [3.0, 0.0], [3.0, 3.0], [0.0, 3.0]], "B": [[-3.0, -3.0], [1.0, -3.0], [1.0, 1.0], [-1.0, 2.0]], "C": [[1.5, -2.5], [3.5, -0.5], [1.5, 0.5]]}
_POINT_SQL = "p AS (SELECT vec_id, round(embedding[1]::DOUBLE * 16, 3) AS x, round(embedding[2]::DOUBLE * 16, 3) AS y FROM embeddings)"
_EDGE_SQL = "e(room, x0, y0, x1, y1) AS (VALUES " + ", ".join(f"('{r}', {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for r, ring in _ROOMS.items() for a, b in zip(ring, ring[1:] + ring[:1])) + ")"
_INSIDE_SQL = f"{_POINT_SQL}, {_EDGE_SQL}, h AS (SELECT vec_id, room FROM p, e WHERE (y0 > y) <> (y1 > y) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0 GROUP BY 1, 2 HAVING count(*) % 2 = 1)"


def _points(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.round(e[0].cast("double") * 16, 3).alias("x"), F.round(e[1].cast("double") * 16, 3).alias("y"))


def _rooms(t):
    return t.spark.createDataFrame(list(_ROOMS.items()), "room string, polygon array<array<double>>")


@query(f"WITH {_INSIDE_SQL} SELECT p.vec_id, min(room) AS room FROM p LEFT JOIN h ON p.vec_id = h.vec_id GROUP BY 1")
def pip_join(t):
    """Points to the first polygon that holds them; misses stay."""
    return S.points_in_polygons(_points(t), _rooms(t), "vec_id", "room", cell=2.0)


@query(f"WITH {_INSIDE_SQL} SELECT p.vec_id, CASE WHEN count(room) = 1 THEN min(room) END AS room FROM p LEFT JOIN h ON p.vec_id = h.vec_id GROUP BY 1")
def room_of(t):
    """The only polygon that holds a point."""
    return S.points_in_polygons(_points(t), _rooms(t), "vec_id", "room", cell=2.0, single=True)


_SEGMENT_SQL = "sqrt(pow(x - (x0 + k * (x1 - x0)), 2) + pow(y - (y0 + k * (y1 - y0)), 2))"


@query(f"""WITH {_INSIDE_SQL}, m AS (SELECT * FROM p WHERE vec_id NOT IN (SELECT vec_id FROM h)),
d AS (SELECT vec_id, room, x, y, x0, y0, x1, y1, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS k FROM m, e),
n AS (SELECT vec_id, room, min({_SEGMENT_SQL}) AS d FROM d GROUP BY 1, 2), b AS (SELECT vec_id, room, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, room) AS r FROM n WHERE d <= 1.5)
SELECT vec_id, room, round(d, 5) AS distance FROM b WHERE r = 1""")
def nearest_label(t):
    """Points outside all polygons to the nearest one within reach."""
    inside = S.points_in_polygons(_points(t), _rooms(t), "vec_id", "room", cell=2.0)
    missed = _points(t).join(inside.where("room is null").select("vec_id"), "vec_id", "left_semi")
    return S.nearest_polygon(missed, _rooms(t), "vec_id", "room", 1.5).withColumn("distance", F.round("distance", 5))


@query(f"""WITH {_INSIDE_SQL}, a(room, size) AS (VALUES ('A', 9.0), ('B', 11.0), ('C', 3.0)), i AS (SELECT vec_id, room FROM (SELECT h.vec_id, h.room, row_number() OVER (PARTITION BY vec_id ORDER BY size, h.room) AS r FROM h JOIN a ON h.room = a.room) WHERE r = 1),
m AS (SELECT * FROM p WHERE vec_id NOT IN (SELECT vec_id FROM h)),
d AS (SELECT vec_id, room, x, y, x0, y0, x1, y1, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) AS k FROM m, e),
n AS (SELECT vec_id, room, min({_SEGMENT_SQL}) AS d FROM d GROUP BY 1, 2), b AS (SELECT vec_id, room, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, room) AS r FROM n WHERE d <= 1.5)
SELECT p.vec_id, coalesce(i.room, b.room) AS room, CASE WHEN i.room IS NOT NULL THEN 1.0 WHEN b.room IS NOT NULL THEN round(0.7 - 0.3 * b.d / 1.5, 5) ELSE 0.0 END::DOUBLE AS confidence FROM p LEFT JOIN i ON p.vec_id = i.vec_id LEFT JOIN b ON p.vec_id = b.vec_id AND b.r = 1""")
def label_rooms(t):
    """Labels to the smallest polygon that holds them, else to the nearest, less surely."""
    return S.label_spaces(_rooms(t), _points(t), "room", "vec_id", 1.5).withColumn("confidence", F.round("confidence", 5))


@query("""WITH q AS (SELECT o_orderkey, o_orderdate::DATE - DATE '1992-01-01' AS a, o_totalprice / 3000 AS w FROM orders), s AS (SELECT range AS k, range * 91 AS t0, range * 91 + 91 AS t1 FROM range(0, 40)),
m AS (SELECT o_orderkey, k, (least(a + w, t1) - greatest(a, t0)) / w AS f FROM q JOIN s ON least(a + w, t1) > greatest(a, t0)),
r AS (SELECT *, row_number() OVER x AS r, coalesce(lead(f) OVER x, 0) AS g FROM m WINDOW x AS (PARTITION BY o_orderkey ORDER BY f DESC, k))
SELECT q.o_orderkey, k AS quarter, round(coalesce(f, 0), 6) AS fraction, coalesce(NOT (f >= 0.5 AND f - g >= 0.2), true) AS ambiguous FROM q LEFT JOIN r ON q.o_orderkey = r.o_orderkey AND r.r = 1""")
def interval_match(t):
    """Date spans to the quarter that covers most of them."""
    days = F.datediff("o_orderdate", F.lit("1992-01-01")).cast("double")
    spans = t.orders.select("o_orderkey", days.alias("s0"), (days + F.col("o_totalprice") / 3000).alias("s1"))
    quarters = t.spark.range(40).select(F.col("id").alias("quarter"), (F.col("id") * 91.0).alias("s0"), (F.col("id") * 91.0 + 91).alias("s1"))
    return S.match_intervals(spans, quarters, "o_orderkey", "quarter", 91.0).withColumn("fraction", F.round("fraction", 6))


@query("""WITH s(tag, sw, sh) AS (VALUES ('W1', 10::DOUBLE, 12::DOUBLE), ('W2', 12, 12), ('W3', 30, 10), ('W4', 31, 11)), m AS (SELECT p_partkey, tag, sqrt(pow(p_size - sw, 2) + pow(p_retailprice / 100 - sh, 2)) AS d FROM part, s)
SELECT p_partkey, tag, round(d, 5) AS distance, row_number() OVER (PARTITION BY p_partkey ORDER BY d, tag)::INT AS rank FROM m WHERE d <= 2.5""")
def size_tag_candidates(t):
    """Schedule rows near each item in width and height."""
    s = t.spark.createDataFrame([("W1", 10.0, 12.0), ("W2", 12.0, 12.0), ("W3", 30.0, 10.0), ("W4", 31.0, 11.0)], "tag string, width_m double, height_m double")
    items = t.part.select("p_partkey", F.col("p_size").cast("double").alias("width_m"), (F.col("p_retailprice") / 100).alias("height_m"))
    return S.size_candidates(items, s, "p_partkey", 2.5).withColumn("distance", F.round("distance", 5))


_BOX_SQL = "b AS (SELECT p_partkey AS id, p_brand, (p_partkey % 20)::DOUBLE AS x0, (p_partkey % 13)::DOUBLE AS y0, (p_partkey % 20 + 5 + p_size % 3)::DOUBLE AS x1, (p_partkey % 13 + 5 + p_size % 4)::DOUBLE AS y1, p_partkey // 300 AS sheet FROM part)"


# A sheet bears 300 boxes.
def _boxes(t):
    k, s = F.col("p_partkey"), F.col("p_size")
    return t.part.select(k.alias("id"), "p_brand", F.floor(k / 300).alias("sheet"), (k % 20).cast("double").alias("x0"), (k % 13).cast("double").alias("y0"), (k % 20 + 5 + s % 3).cast("double").alias("x1"), (k % 13 + 5 + s % 4).cast("double").alias("y1"))


@query(f"""WITH {_BOX_SQL}, p AS (SELECT a.id AS a, b.id AS b, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS s, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS t FROM b a JOIN b ON a.sheet = b.sheet AND a.p_brand = b.p_brand AND a.id < b.id)
SELECT a, b, round(s / (t - s), 6) AS iou FROM p WHERE s / (t - s) >= 0.3""")
def bbox_iou(t):
    """Pairs of boxes of one group that overlap well."""
    b = _boxes(t).select("id", "sheet", "p_brand", F.struct("x0", "y0", "x1", "y1").alias("box"))
    return S.box_pairs(b, ["sheet", "p_brand"], 8.0, 0.3).select("a", "b", F.round("iou", 6).alias("iou"))


@query(f"""WITH RECURSIVE {_BOX_SQL}, o AS (SELECT *, p_brand || '/' || sheet AS g, row_number() OVER (PARTITION BY p_brand, sheet ORDER BY y1 DESC, id) AS r FROM b),
p AS (SELECT a.g, a.r AS ra, b.r AS rb, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS s, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS t FROM o a JOIN o b ON a.g = b.g AND a.r < b.r),
z AS (SELECT g, rb, list(ra) AS over FROM p WHERE s >= 0.5 * (t - s) GROUP BY 1, 2),
k(g, r, kept) AS (SELECT g, 1::BIGINT, [1::BIGINT] FROM o WHERE r = 1 UNION ALL SELECT k.g, o.r, CASE WHEN len(list_intersect(k.kept, coalesce(z.over, []::BIGINT[]))) = 0 THEN list_append(k.kept, o.r) ELSE k.kept END FROM k JOIN o ON o.g = k.g AND o.r = k.r + 1 LEFT JOIN z ON z.g = o.g AND z.rb = o.r)
SELECT o.p_brand, o.id FROM o JOIN (SELECT g, max_by(kept, r) AS kept FROM k GROUP BY 1) f ON o.g = f.g WHERE list_contains(f.kept, o.r)""")
def non_max(t):
    """Greedy suppression of overlapping boxes by group."""
    return P.non_max(_boxes(t).withColumn("score", F.col("y1")), ["sheet", "p_brand"], "id", "score").select("p_brand", "id")


@query("""SELECT CASE WHEN value IS NULL THEN 'unknown' ELSE ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][(floor(((value * 37 + 22.5) % 360) / 45) + 1)::INT] END AS direction, count(*) AS n FROM events GROUP BY 1""")
def compass(t):
    """Bearings in eight sectors."""
    return t.events.groupBy(G.cardinal(F.col("value") * 37).alias("direction")).agg(F.count("*").alias("n"))


def _ring(k):
    s, h = (F.col("p_size") + 1).cast("double"), (F.col("p_size") % 7 + 2).cast("double")
    v = lambda x, y: F.array(F.lit(x) if isinstance(x, float) else x, F.lit(y) if isinstance(y, float) else y)
    return F.array(v(0.0, 0.0), v(s, 0.0), v(s + 1, h), v(s / 2, h + 1), v(0.0, h))


_RING_SQL = "WITH q AS (SELECT p_partkey, (p_size + 1)::DOUBLE AS s, (p_size % 7 + 2)::DOUBLE AS h FROM part), r AS (SELECT p_partkey, [0, s, s + 1, s / 2, 0]::DOUBLE[] AS xs, [0, 0, h, h + 1, h]::DOUBLE[] AS ys FROM q), e AS (SELECT p_partkey, xs[i] AS x0, ys[i] AS y0, xs[i % 5 + 1] AS x1, ys[i % 5 + 1] AS y1 FROM r, unnest(range(1, 6)) AS t(i))"


@query(f"{_RING_SQL} SELECT p_partkey, round(sum(x0 * y1 - x1 * y0) / 2, 6) AS area, round(sum(sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2))), 6) AS perimeter, round(sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 6) AS cx, round(sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 6) AS cy FROM e GROUP BY 1")
def ring_measures(t):
    """Shoelace area, perimeter and centroid."""
    r = t.part.select("p_partkey", _ring(F.col("p_size")).alias("ring"))
    c = G.centroid("ring")
    return r.select("p_partkey", F.round(G.signed_area("ring"), 6).alias("area"), F.round(G.perimeter("ring"), 6).alias("perimeter"), F.round(c.x, 6).alias("cx"), F.round(c.y, 6).alias("cy"))


@query("""SELECT p_partkey, round(sqrt(s * s * s * s / 4 + s * s * h * h), 6) AS area, round(degrees(atan2(h, s / 2)), 4) AS tilt_deg FROM (SELECT p_partkey, (p_size + 1)::DOUBLE AS s, (p_size % 7 + 2)::DOUBLE AS h FROM part)""")
def newell(t):
    """Area and tilt of a sloped plane by Newell's normal."""
    s, h = (F.col("p_size") + 1).cast("double"), (F.col("p_size") % 7 + 2).cast("double")
    zero = F.lit(0.0)
    plane = F.array(F.array(zero, zero, zero), F.array(s, zero, zero), F.array(s, s / 2, h), F.array(zero, s / 2, h))
    o = G.plane_orientation(plane)
    return t.part.select("p_partkey", F.round(o.area, 6).alias("area"), F.round(o.tilt_deg, 4).alias("tilt_deg"))


@query("""WITH c AS (SELECT p_brand, p_partkey // 300 AS sheet, p_partkey % 20 + i AS x, p_partkey % 13 + j AS y FROM part, unnest(range(0, 6)) AS a(i), unnest(range(0, 4)) AS b(j))
SELECT p_brand, sheet, count(DISTINCT (x, y))::DOUBLE AS union_area, (SELECT count(*) FROM part p WHERE p.p_brand = c.p_brand AND p_partkey // 300 = sheet) AS n FROM c GROUP BY 1, 2""")
def union_area(t):
    """The area that overlapping rectangles cover, overlaps once (unit cells in SQL)."""
    k = F.col("p_partkey")
    x, y = (k % 20).cast("double"), (k % 13).cast("double")
    ring = F.array(F.array(x, y), F.array(x + 6, y), F.array(x + 6, y + 4), F.array(x, y + 4))
    return P.union_areas(t.part.select("p_brand", F.floor(k / 300).alias("sheet"), ring.alias("polygon")), ["p_brand", "sheet"]).withColumn("union_area", F.round("union_area", 4))


@query("""WITH s AS (SELECT l_suppkey, l_orderkey % 100 AS lo, l_orderkey % 100 + l_quantity AS hi, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice) AS id FROM lineitem)
SELECT a.l_suppkey, count(*) AS pairs, round(sum(least(a.hi, b.hi) - greatest(a.lo, b.lo)), 2) AS overlap FROM s a JOIN s b ON a.l_suppkey = b.l_suppkey AND a.id < b.id AND least(a.hi, b.hi) > greatest(a.lo, b.lo) GROUP BY 1""")
def overlapping_pairs(t):
    """Overlapping placements on one wall."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    r = t.lineitem.select("l_suppkey", (F.col("l_orderkey") % 100).cast("double").alias("s0"), (F.col("l_orderkey") % 100 + F.col("l_quantity")).alias("s1"), F.row_number().over(w).alias("id"))
    return S.overlapping_pairs(r, ["l_suppkey"], "id", 25.0).groupBy("l_suppkey").agg(F.count("*").alias("pairs"), F.round(F.sum("overlap"), 2).alias("overlap"))


@query("""SELECT user_id, count(*) AS n_islands, max(n) AS longest FROM (SELECT user_id, island, count(*) AS n FROM (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY h, event_id ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT user_id, event_id, epoch(ts) / 3600 AS h, CASE WHEN coalesce(epoch(ts) / 3600 - lag(epoch(ts) / 3600) OVER (PARTITION BY user_id ORDER BY ts, event_id), 1e9) > 6 THEN 1 ELSE 0 END AS new FROM events)) GROUP BY 1, 2) GROUP BY 1""")
def gaps_islands(t):
    """Runs of events without a gap of over six hours."""
    e = t.events.select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 3600).alias("h"))
    runs = W.islands(e, ["user_id"], "h", 6, ["event_id"]).groupBy("user_id", "island").agg(F.count("*").alias("n"))
    return runs.groupBy("user_id").agg(F.count("*").alias("n_islands"), F.max("n").alias("longest"))


@query("""WITH e AS (SELECT event_type, user_id, event_id * 7 % 400 AS lo, event_id * 7 % 400 + floor(value) % 5 AS hi FROM events), r AS (SELECT *, max(hi) OVER (PARTITION BY event_type, user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type, user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM r)
SELECT event_type, user_id, min(lo)::DOUBLE AS lo, max(hi)::DOUBLE AS hi, count(*) AS n FROM g GROUP BY event_type, user_id, g""")
def interval_self_merge(t):
    """Intervals joined where they touch, with slack."""
    lo = (F.col("event_id") * 7 % 400).cast("double")
    e = t.events.select("event_type", "user_id", lo.alias("lo"), (lo + F.floor("value") % 5).alias("hi"))
    return W.merged_intervals(e, ["event_type", "user_id"], "lo", "hi", 1.0)


@query("""WITH d AS (SELECT n_regionkey, length(n_name) AS v, min(n_name) AS name FROM nation GROUP BY 1, 2), s AS (SELECT n_regionkey, name, lead(v) OVER (PARTITION BY n_regionkey ORDER BY v) - v AS step FROM d) SELECT n_regionkey, name, step::INT AS step FROM s WHERE step IS NOT NULL""")
def lead_steps(t):
    """How far each mark lies below the next."""
    return W.steps(t.nation.withColumn("v", F.length("n_name")).withColumnRenamed("n_name", "name"), ["n_regionkey"], "v", "name")


@query("""WITH q AS (SELECT n_regionkey, n_name, n_nationkey + 1 AS w, 17.0::DOUBLE * (n_nationkey + 1) / sum(n_nationkey + 1) OVER (PARTITION BY n_regionkey) AS q FROM nation), b AS (SELECT *, floor(q) AS b, 17 - sum(floor(q)) OVER (PARTITION BY n_regionkey) AS l, row_number() OVER (PARTITION BY n_regionkey ORDER BY q - floor(q) DESC, w DESC, n_name) AS r FROM q)
SELECT n_regionkey, n_name, (b + CASE WHEN r <= l THEN 1 ELSE 0 END)::BIGINT AS units FROM b""")
def largest_remainder(t):
    """Whole units shared by weight."""
    rows = t.nation.select("n_regionkey", "n_name", (F.col("n_nationkey") + 1).alias("w"))
    return W.apportion(rows, ["n_regionkey"], "w", F.lit(17.0), ["n_name"]).select("n_regionkey", "n_name", "units")


@query("""WITH r AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER w AS r, lead(c_acctbal) OVER w AS nx FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey))
SELECT c_nationkey, CASE WHEN coalesce(c_acctbal - nx < 50, false) THEN NULL ELSE c_custkey END AS c_custkey, c_acctbal, CASE WHEN coalesce(c_acctbal - nx < 50, false) THEN 'tie' END AS reason FROM r WHERE r = 1""")
def top_with_guard(t):
    """The best of each group unless the next comes too near."""
    return W.guarded_best(t.customer, ["c_nationkey"], "c_acctbal", "c_custkey", 50.0)


@query("""SELECT l_partkey, l_suppkey, CASE WHEN count(DISTINCT l_orderkey) = 2 THEN min(l_orderkey) END AS a, CASE WHEN count(DISTINCT l_orderkey) = 2 THEN max(l_orderkey) END AS b, CASE count(DISTINCT l_orderkey) WHEN 2 THEN 'paired' WHEN 1 THEN 'unpaired' ELSE 'conflict' END AS status FROM lineitem GROUP BY 1, 2""")
def sheet_key_pairs(t):
    """Keys on exactly two sheets pair them."""
    return W.match_pairs(t.lineitem, ["l_partkey", "l_suppkey"], "l_orderkey")


@query("""WITH RECURSIVE p AS (SELECT DISTINCT s_suppkey AS a, c_custkey AS b, (s_suppkey * 31 + c_custkey * 17) % 101 AS score FROM supplier JOIN customer ON s_nationkey = c_nationkey AND s_suppkey // 10 = c_custkey // 150),
o AS (SELECT *, row_number() OVER (ORDER BY score DESC, a, b) AS r FROM p),
g(r, ua, ub, hit) AS (SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], false UNION ALL SELECT o.r, CASE WHEN list_contains(g.ua, o.a) OR list_contains(g.ub, o.b) THEN g.ua ELSE list_append(g.ua, o.a) END, CASE WHEN list_contains(g.ua, o.a) OR list_contains(g.ub, o.b) THEN g.ub ELSE list_append(g.ub, o.b) END, NOT (list_contains(g.ua, o.a) OR list_contains(g.ub, o.b)) FROM g JOIN o ON o.r = g.r + 1)
SELECT o.a, o.b, o.score FROM g JOIN o ON g.r = o.r WHERE g.hit""")
def greedy_pairs(t):
    """One-to-one matching, best pairs first; candidates share a nation and a district of 10 suppliers and 150 customers."""
    near = (F.col("s_nationkey") == F.col("c_nationkey")) & (F.floor(F.col("s_suppkey") / 10) == F.floor(F.col("c_custkey") / 150))
    p = t.supplier.join(t.customer, near).select(F.col("s_suppkey").alias("a"), F.col("c_custkey").alias("b"), ((F.col("s_suppkey") * 31 + F.col("c_custkey") * 17) % 101).alias("score"))
    return W.best_pairs(p, "a", "b", "score")
