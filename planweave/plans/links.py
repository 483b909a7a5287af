"""Linking and adjacency queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.operators import adjacency as J
from planweave.operators import linking as N
from planweave.plans.registry import query


@query("""WITH k AS (SELECT DISTINCT upper(replace(p_brand, ' ', '')) AS tag FROM part), s AS (SELECT l_orderkey AS id, CASE l_orderkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || ' typ' ELSE 'see ' || p_brand END AS t FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT id, coalesce(a.tag, b.tag) AS tag FROM s LEFT JOIN k a ON upper(replace(t, ' ', '')) = a.tag LEFT JOIN k b ON upper(string_split(t, ' ')[1]) = b.tag WHERE coalesce(a.tag, b.tag) IS NOT NULL""")
def find_tags(t):
    """Text spans whose whole text, else first word, is a known tag."""
    known = t.part.select(F.col("p_brand").alias("tag"))
    k = F.col("l_orderkey") % 3
    text = F.when(k == 0, F.col("p_brand")).when(k == 1, F.concat("p_brand", F.lit(" typ"))).otherwise(F.concat(F.lit("see "), "p_brand"))
    s = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("id"), text.alias("text"))
    return N.find_tags(s, known).select("id", "tag")




def _boxes(t, shift):
    k = F.col("p_partkey")
    x, y = (k * 7 % 60).cast("double") + shift, (k * 11 % 40).cast("double")
    return t.part.select(k.alias("id"), F.concat_ws("/", "p_type", F.floor(k / 300)).alias("sheet"), F.when(k % 3 == 0, F.col("p_brand")).alias("tag"), F.struct(x.alias("x0"), y.alias("y0"), (x + 6).alias("x1"), (y + 5).alias("y1")).alias("box"))


@query("""WITH RECURSIVE o AS (SELECT p_partkey AS id, p_type || '/' || (p_partkey // 300) AS sheet, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS tag, p_partkey * 7 % 60 AS x, p_partkey * 11 % 40 AS y FROM part), u AS (SELECT sheet, tag, min(id) AS id FROM o WHERE tag IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1),
f AS (SELECT * FROM o WHERE id NOT IN (SELECT id FROM u)),
q AS (SELECT a.sheet, a.id AS a, b.id AS b, greatest(0, 6 - abs(a.x - (b.x + 1))) * greatest(0, 5 - abs(a.y - b.y)) AS i FROM f a JOIN f b ON a.sheet = b.sheet),
p AS (SELECT sheet, a, b, row_number() OVER (PARTITION BY sheet ORDER BY i DESC, a, b) AS r FROM q WHERE i >= 0.5 * (60 - i)),
g(sheet, r, ua, ub, hit) AS (SELECT sheet, 0::BIGINT, []::BIGINT[], []::BIGINT[], false FROM p GROUP BY 1 UNION ALL SELECT g.sheet, p.r, CASE WHEN list_contains(g.ua, p.a) OR list_contains(g.ub, p.b) THEN g.ua ELSE list_append(g.ua, p.a) END, CASE WHEN list_contains(g.ua, p.a) OR list_contains(g.ub, p.b) THEN g.ub ELSE list_append(g.ub, p.b) END, NOT (list_contains(g.ua, p.a) OR list_contains(g.ub, p.b)) FROM g JOIN p ON p.sheet = g.sheet AND p.r = g.r + 1)
SELECT id AS old_id, id + 1000000000 AS new_id, 'tag' AS how FROM u UNION ALL SELECT p.a, p.b + 1000000000, 'box' FROM g JOIN p ON g.sheet = p.sheet AND g.r = p.r WHERE g.hit""")
def moved_openings(t):
    """Openings of two revisions paired by tags that are unique on both sides, the others by their boxes."""
    new = _boxes(t, 1.0).withColumn("id", F.col("id") + 1000000000)
    return N.moved_openings(_boxes(t, 0.0), new, ["sheet"])


@query("""WITH v AS (SELECT l_partkey AS p, l_suppkey AS s, l_quantity AS q FROM lineitem) SELECT p, s, CASE WHEN count(DISTINCT q) = 1 THEN min(q) END AS value, CASE WHEN count(DISTINCT q) = 1 THEN 'high' ELSE 'low' END AS confidence FROM v GROUP BY 1, 2""")
def slots_agree(t):
    """A slot stated several times keeps its value only if all agree."""
    v = t.lineitem.select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"), F.lit("cfm").alias("unit"))
    return N.same_rows_agree(v, ["p", "s"], "q", "unit")


@query("""WITH a AS (SELECT p_partkey AS id, p_brand || '/' || (p_partkey // 300) AS g, upper(p_name || ' plan ' || p_partkey % 300) AS t FROM part), b AS (SELECT id + 1000000000 AS id, g, replace(replace(t, 'R', 'N'), 'PLAN', 'PLN') AS t FROM a),
j AS (SELECT a.id AS a_id, b.id AS b_id, 1 - levenshtein(a.t, b.t)::DOUBLE / greatest(length(a.t), length(b.t), 1) AS ratio FROM a JOIN b ON a.g = b.g)
SELECT a_id, b_id, round(ratio, 6) AS ratio FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY ratio DESC, b_id) AS r FROM j WHERE ratio >= 0.8) WHERE r = 1""")
def title_matches(t):
    """Titles most alike by edit distance, within a brand and set of 300."""
    k = F.col("p_partkey")
    a = t.part.select(k.alias("id"), F.concat_ws("/", "p_brand", F.floor(k / 300)).alias("g"), F.upper(F.concat("p_name", F.lit(" plan "), k % 300)).alias("title"))
    b = a.select((F.col("id") + 1000000000).alias("id"), "g", F.replace(F.replace("title", F.lit("R"), F.lit("N")), F.lit("PLAN"), F.lit("PLN")).alias("title"))
    return N.title_matches(a, b, ["g"], least=0.8).withColumn("ratio", F.round("ratio", 6))


@query("""WITH e AS (SELECT l_orderkey AS k, CASE l_linenumber % 3 WHEN 0 THEN 'note' WHEN 1 THEN 'dimension' ELSE 'bar' END AS kind, 50 + l_quantity % 2 AS scale, l_discount > 0.09 AS nts FROM lineitem),
g AS (SELECT k, median(CASE WHEN kind = 'note' AND NOT nts THEN scale END) AS note, median(CASE WHEN kind = 'bar' AND NOT nts THEN scale END) AS bar, CASE WHEN count(*) FILTER (WHERE kind = 'dimension' AND NOT nts) >= 3 THEN median(CASE WHEN kind = 'dimension' AND NOT nts THEN scale END) END AS dim, count(*) FILTER (WHERE nts) AS n FROM e GROUP BY 1)
SELECT k, CASE WHEN n = 0 AND coalesce(note, bar, dim) IS NOT NULL AND NOT greatest(note, bar, dim) > 1.01 * least(note, bar, dim) THEN coalesce(note, bar, dim) END AS scale, CASE WHEN n > 0 THEN 'not to scale' WHEN coalesce(note, bar, dim) IS NULL THEN 'no evidence' WHEN greatest(note, bar, dim) > 1.01 * least(note, bar, dim) THEN 'disagree' END AS reason FROM g""")
def scale_votes(t):
    """Evidence for a sheet's scale must agree."""
    kind = F.when(F.col("l_discount") > 0.09, "nts").when(F.col("l_linenumber") % 3 == 0, "note").when(F.col("l_linenumber") % 3 == 1, "dimension").otherwise("bar")
    e = t.lineitem.select(F.col("l_orderkey").alias("k"), kind.alias("kind"), (50 + F.col("l_quantity") % 2).alias("scale"))
    return N.scale_votes(e, ["k"])


@query("""WITH m AS (SELECT event_type, user_id, event_id, value - event_id % 3 AS off FROM events), l AS (SELECT event_type, user_id, list_sort(list(off)) AS o FROM m GROUP BY 1, 2), k AS (SELECT m.event_type, m.user_id, m.event_id FROM m JOIN l ON m.event_type = l.event_type AND m.user_id = l.user_id WHERE abs(off - o[len(o) // 2 + 1]) <= 0.5)
SELECT event_type, event_id FROM (SELECT *, count(*) OVER (PARTITION BY event_type, user_id) AS n FROM k) WHERE n >= 2""")
def level_marks(t):
    """Marks that lie off their drawn height as the median one does."""
    m = t.events.select("event_type", "user_id", "event_id", "value", (F.col("event_id") % 3).alias("drawn"))
    return N.level_marks(m, ["event_type", "user_id"], within=0.5).select("event_type", "event_id")


# Rooms on a grid of 4 x 3 m, 63 to a level; a customer's number says where.
def _rooms(t):
    k = F.col("c_custkey")
    x, y = (k % 7).cast("double") * 4, (F.floor(k / 7) % 9).cast("double") * 3
    ring = F.array(F.array(x, y), F.array(x + 4, y), F.array(x + 4, y + 3), F.array(x, y + 3))
    return t.customer.select(k.alias("id"), (F.floor(k / 315) * 5 + k % 5).alias("level_id"), ring.alias("polygon_m"), F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit("unconditioned")).otherwise(F.lit("conditioned")).alias("category"))


_ROOM_SQL = "r AS (SELECT c_custkey AS id, c_custkey // 315 * 5 + c_custkey % 5 AS level_id, c_custkey % 7 AS i, (c_custkey // 7) % 9 AS j, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'unconditioned' ELSE 'conditioned' END AS category FROM customer), w AS (SELECT a.level_id, a.id AS a, b.id AS b, a.category AS ca, b.category AS cb, CASE WHEN a.i = b.i AND a.j = b.j THEN 14 WHEN a.i = b.i AND abs(a.j - b.j) = 1 THEN 4 WHEN a.j = b.j AND abs(a.i - b.i) = 1 THEN 3 END::DOUBLE AS length FROM r a JOIN r b ON a.level_id = b.level_id AND a.id < b.id WHERE (a.i = b.i AND abs(a.j - b.j) <= 1) OR (a.j = b.j AND abs(a.i - b.i) = 1))"


@query(f"WITH {_ROOM_SQL} SELECT level_id, a, b, length FROM w")
def shared_walls(t):
    """How much wall two rooms share."""
    return J.shared_walls(_rooms(t), ["level_id"]).withColumn("length", F.round("length", 6))


@query(f"WITH {_ROOM_SQL} SELECT level_id, a, b, length, CASE WHEN ca IS NULL OR cb IS NULL THEN 'review' ELSE 'semi_exterior' END AS kind, CASE WHEN ca IS NULL OR cb IS NULL THEN 'category not known' END AS reason FROM w WHERE ca IS NULL OR cb IS NULL OR ca <> cb")
def semi_exterior(t):
    """Walls between conditioned and other rooms."""
    return J.semi_exterior_boundaries(_rooms(t), ["level_id"]).withColumn("length", F.round("length", 6))


@query("""WITH r AS (SELECT c_custkey AS id, c_custkey // 105 * 3 + c_custkey % 3 + 1 AS rank, (c_custkey % 7) * 4 + c_custkey % 2 AS x, ((c_custkey // 7) % 5) * 3 AS y FROM customer),
o AS (SELECT a.id AS a, b.id AS b, greatest(0, least(a.x, b.x) + 4 - greatest(a.x, b.x)) * greatest(0, least(a.y, b.y) + 3 - greatest(a.y, b.y)) AS area FROM r a JOIN r b ON a.rank + 1 = b.rank),
i AS (SELECT a::VARCHAR AS below, b::VARCHAR AS above, area::DOUBLE AS area, 'interior' AS kind FROM o WHERE area > 0),
t AS (SELECT id::VARCHAR AS below, NULL AS above, 12.0 - coalesce((SELECT sum(area) FROM o WHERE o.a = r.id), 0) AS area, 'roof' AS kind FROM r),
f AS (SELECT NULL AS below, id::VARCHAR AS above, 12.0 - coalesce((SELECT sum(area) FROM o WHERE o.b = r.id), 0) AS area, CASE WHEN rank = 1 THEN 'ground' ELSE 'exposed_floor' END AS kind FROM r)
SELECT below, above, area::DOUBLE AS area, kind FROM (SELECT * FROM i UNION ALL SELECT * FROM t UNION ALL SELECT * FROM f) WHERE area > 0""")
def interstory(t):
    """What lies over and under each room."""
    k = F.col("c_custkey")
    x, y = ((k % 7) * 4 + k % 2).cast("double"), ((F.floor(k / 7) % 5) * 3).cast("double")
    ring = F.array(F.array(x, y), F.array(x + 4, y), F.array(x + 4, y + 3), F.array(x, y + 3))
    level = F.floor(k / 105) * 3 + k % 3
    rooms = t.customer.select(k.cast("string").alias("id"), level.cast("string").alias("level_id"), ring.alias("polygon_m"))
    levels = t.customer.select(level.cast("string").alias("id"), (level * 3.0).alias("elevation_z_m")).distinct()
    return J.interstory(rooms, levels).withColumn("area", F.round("area", 6))


@query("""SELECT o_orderpriority AS facade, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS wwr, round(10.0::DOUBLE / (max(o_orderkey % 97) - min(o_orderkey % 97) + 1), 6) AS m_per_px FROM orders GROUP BY 1""")
def facade_shares(t):
    """Shares of the wall plane and the scale from a stated width."""
    p = t.orders.select(F.col("o_orderpriority").alias("facade"), F.when(F.col("o_orderstatus") == "F", F.lit("window")).otherwise(F.lit("wall")).alias("kind"), (F.col("o_orderkey") % 97).alias("x"), (F.col("o_orderkey") % 89).alias("y"), F.lit(10.0).alias("w"))
    return J.facade_takeoff(p, "facade", width_m="w").select("facade", F.round("wwr", 6).alias("wwr"), F.round("m_per_px", 6).alias("m_per_px"))


@query("""SELECT round(100 * (SELECT sum(l_quantity) FROM lineitem WHERE l_returnflag = 'R') / (SELECT sum(o_totalprice) FROM orders), 2) AS wwr_pct, round(100 * (SELECT sum(l_quantity) FROM lineitem WHERE l_returnflag = 'A') / (SELECT sum(p_size) FROM part), 2) AS srr_pct""")
def glazing_ratio(t):
    """Windows over walls and skylights over roofs, in per cent."""
    walls = t.orders.select(F.col("o_totalprice").alias("area_m2"), F.lit(0.0).alias("length_m"), F.lit(0.0).alias("height_m"))
    kind = F.when(F.col("l_returnflag") == "R", "window").when(F.col("l_returnflag") == "A", "skylight").otherwise("door")
    openings = t.lineitem.select(kind.alias("category"), F.col("l_quantity").alias("area_m2"), F.lit(0.0).alias("width_m"), F.lit(0.0).alias("height_m"), F.lit(False).alias("interior"))
    return J.glazing_ratio(walls, openings, t.part.select(F.col("p_size").cast("double").alias("area_m2")))
