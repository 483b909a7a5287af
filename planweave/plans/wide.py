"""Operators on sheets, systems, revisions and shapes that the other modules leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.operators import adjacency as J
from planweave.operators import classify as C
from planweave.operators import hvac as H
from planweave.operators import linking as N
from planweave.operators import ordered as W
from planweave.operators import polygons as P
from planweave.operators import registration as R
from planweave.operators import revisions as V
from planweave.operators import spatial as S
from planweave.plans import battery
from planweave.plans.registry import query
from planweave.query.engine import Engine
from planweave.session import shared_folder
from planweave.streaming import events as E


def _ring(x0, y0, x1, y1):
    v = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    return F.array(v(x0, y0), v(x1, y0), v(x1, y1), v(x0, y1))


@query("""WITH s(tag, sw, sh) AS (VALUES ('W1', 10::DOUBLE, 12::DOUBLE), ('W2', 12, 12), ('W3', 30, 10), ('W4', 31, 11)), m AS (SELECT p_partkey, tag, sqrt(pow(p_size - sw, 2) + pow(p_retailprice / 100 - sh, 2)) AS d FROM part, s), c AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, tag) AS r FROM m WHERE d <= 2.5)
SELECT p_partkey, max(CASE WHEN r = 1 THEN tag END) AS nearest, string_agg(tag, ',' ORDER BY tag) AS every FROM c GROUP BY 1""")
def adjudicated_tags(t):
    """One tag for each item: the nearest, and all that come into question."""
    s = t.spark.createDataFrame([("W1", 10.0, 12.0), ("W2", 12.0, 12.0), ("W3", 30.0, 10.0), ("W4", 31.0, 11.0)], "tag string, width_m double, height_m double")
    c = S.size_candidates(t.part.select("p_partkey", F.col("p_size").cast("double").alias("width_m"), (F.col("p_retailprice") / 100).alias("height_m")), s, "p_partkey", 2.5)
    return S.adjudicate(c, "p_partkey").withColumnRenamed("tag", "nearest").join(S.adjudicate(c, "p_partkey", "keep_both").withColumnRenamed("tag", "every"), "p_partkey")


_SEEN = "s AS (SELECT o_orderkey AS id, o_custkey AS k, o_orderstatus AS sheet, (o_orderdate::DATE - DATE '1992-01-01')::BIGINT AS d FROM orders)"


@query(f"""WITH RECURSIVE {_SEEN}, e AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.k = b.k AND a.sheet <> b.sheet AND abs(a.d - b.d) <= 5),
c(a, b) AS (SELECT id, id FROM s UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a), g AS (SELECT a AS id, min(b) AS grp FROM c GROUP BY 1)
SELECT s.k, grp, round(sum(d * (1.0 + id % 3)) / sum(1.0 + id % 3), 6) AS lo, count(*) AS n, string_agg(DISTINCT sheet, ',' ORDER BY sheet) AS tag FROM s JOIN g USING (id) GROUP BY 1, 2""")
def merged_views(t):
    """Observations on several sheets that are one, and their weighted means."""
    d = F.datediff("o_orderdate", F.lit("1992-01-01")).cast("double")
    v = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("sheet"), d.alias("lo"), (d + 10).alias("hi"), (1.0 + F.col("o_orderkey") % 3).alias("confidence"), F.col("o_orderstatus").alias("tag"))
    g = N.group_means(N.merged_observations(v, ["k"], within=6.0), ["k"])
    return g.select("k", F.col("group").alias("grp"), F.round("lo", 6).alias("lo"), "n", "tag")


@query(f"""WITH RECURSIVE {_SEEN}, e AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.k = b.k AND a.id % 2 = b.id % 2 AND a.id <> b.id AND abs(a.d - b.d) <= 1),
c(a, b) AS (SELECT id, id FROM s UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a), g AS (SELECT a AS id, min(b) AS g FROM c GROUP BY 1)
SELECT id, n FROM (SELECT id, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (PARTITION BY g ORDER BY id % 10 DESC, id) AS r FROM g) WHERE r = 1""")
def deduped_openings(t):
    """One opening of each cluster over adjacent levels: the surest."""
    o = F.col("o_orderkey")
    rows = t.orders.select(o.alias("id"), F.when(o % 2 == 0, "L1").otherwise("L2").alias("level_id"), F.col("o_custkey").cast("string").alias("host_facade"), F.lit(None).cast("string").alias("tag"), F.lit("window").alias("category"), (F.datediff("o_orderdate", F.lit("1992-01-01")) * 0.04).alias("s_center_m"), F.lit(1.0).alias("width_m"), F.lit(0.0).alias("sill_m"), F.lit(2.9).alias("head_m"), (o % 10 / 10).alias("confidence"), F.lit("A").alias("sheet_id"))
    levels = t.spark.createDataFrame([("L1", 0.0), ("L2", 3.0)], "id string, elevation_z_m double")
    return R.dedupe_openings(rows, levels)[0].select("id", "n")


@query("""SELECT s_suppkey AS tag, CASE WHEN s_suppkey % 7 < 5 AND (s_suppkey % 5 <> 0 OR s_suppkey % 7 = 1) THEN 'AHU-' || s_suppkey % 7 WHEN s_suppkey % 7 >= 5 AND s_suppkey % 5 = 0 THEN 'AHU-1' END AS unit,
CASE WHEN s_suppkey % 7 < 5 AND s_suppkey % 5 = 0 AND s_suppkey % 7 <> 1 THEN 'several: ' || CASE WHEN s_suppkey % 7 = 0 THEN 'AHU-0,AHU-1' ELSE 'AHU-1,AHU-' || s_suppkey % 7 END WHEN s_suppkey % 7 >= 5 AND s_suppkey % 5 <> 0 THEN 'not scheduled: AHU-' || s_suppkey % 7 END AS note FROM supplier""")
def served_units(t):
    """The one scheduled unit that a row's serving cells name."""
    s = F.col("s_suppkey")
    cells = F.map_filter(F.create_map(F.lit("Served by"), F.concat(F.lit("ahu-"), s % 7), F.lit("Unit"), F.when(s % 5 == 0, "AHU-1"), F.lit("Note"), F.lit("AHU-3")), lambda k, v: v.isNotNull())
    units = t.spark.range(5).select(F.concat(F.lit("AHU-"), "id").alias("unit"))
    return N.served_by(t.supplier.select(s.alias("tag"), cells.alias("values")), units)


@query("""WITH b AS (SELECT l_orderkey AS zone, l_suppkey AS unit, l_quantity AS f, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS w FROM lineitem), c AS (SELECT s_suppkey, CASE WHEN s_suppkey % 6 <> 0 THEN s_acctbal END AS cap FROM supplier)
SELECT zone, CASE WHEN count(*) = count(cap) THEN round(sum(f / w * cap), 6) END AS capacity FROM b LEFT JOIN c ON unit = s_suppkey GROUP BY 1""")
def zone_capacities(t):
    """Zones' shares of their units' capacities, unknown where a part is."""
    boxes = t.lineitem.select(F.col("l_orderkey").alias("zone"), F.col("l_suppkey").alias("unit"), F.col("l_quantity").alias("flow"), F.col("l_partkey").alias("box"))
    units = t.supplier.select(F.col("s_suppkey").alias("unit"), F.lit(None).cast("double").alias("fan_flow"), F.when(F.col("s_suppkey") % 6 != 0, F.col("s_acctbal")).alias("capacity"))
    known = units.unionByName(boxes.select("unit").distinct().join(units, "unit", "left_anti").select("unit", F.lit(None).cast("double").alias("fan_flow"), F.lit(None).cast("double").alias("capacity")))
    return H.zone_capacities(H.box_shares(boxes, known), known).withColumn("capacity", F.round("capacity", 6))


@query("""SELECT o_orderkey AS tag, CASE o_orderkey % 3 WHEN 2 THEN '' ELSE 'R' || o_custkey END AS rooms FROM orders""")
def linked_rooms(t):
    """Rooms that references name, by number or name."""
    k, o = F.col("o_custkey"), F.col("o_orderkey")
    rooms = t.customer.select(F.concat(F.lit("R"), "c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("number"), F.col("c_name").alias("name"))
    name = F.lower(F.concat(F.lit(" Customer#"), F.lpad(k.cast("string"), 9, "0")))
    refs = t.orders.select(o.alias("tag"), F.when(o % 3 == 0, k.cast("string")).when(o % 3 == 1, name).otherwise("nowhere").alias("room"))
    return N.link_rooms(refs, rooms).select("tag", F.array_join("rooms", ",").alias("rooms"))


_PLANS = "b AS (SELECT p_partkey AS id, p_partkey // 300 AS g, p_partkey * 7 % 60 AS x0, p_partkey * 11 % 40 AS y0, p_partkey * 7 % 60 + 3 + p_partkey % 9 * 5 AS x1, p_partkey * 11 % 40 + 3 + p_partkey % 9 * 4 AS y1 FROM part)"


@query(f"""WITH {_PLANS}, j AS (SELECT a.id AS plan, b.id AS base, (b.x1 - b.x0) * (b.y1 - b.y0) AS area, (a.x1 - a.x0) * (a.y1 - a.y0) AS own, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS s FROM b a JOIN b ON a.g = b.g AND a.id <> b.id),
r AS (SELECT *, row_number() OVER w AS r, lead(area) OVER w AS nx FROM j WHERE s >= 0.8 * own AND own <= 0.6 * area WINDOW w AS (PARTITION BY plan ORDER BY area, base))
SELECT b.id AS plan, CASE WHEN NOT coalesce(nx <= 1.1 * area, false) THEN base END AS base, CASE WHEN base IS NULL THEN 'none' WHEN coalesce(nx <= 1.1 * area, false) THEN 'ambiguous' END AS reason FROM b LEFT JOIN r ON b.id = r.plan AND r.r = 1""")
def enlarged_plans(t):
    """The smallest plan that holds most of an enlarged one."""
    k = F.col("p_partkey")
    x, y = (k * 7 % 60).cast("double"), (k * 11 % 40).cast("double")
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + 3 + k % 9 * 5).alias("x1"), (y + 3 + k % 9 * 4).alias("y1"))
    plans = t.part.select(k.alias("id"), F.floor(k / 300).alias("g"), box.alias("box"))
    return N.enlarged_plans(plans, plans, ["g"], cell=20.0)


@query("""WITH r AS (SELECT c_custkey AS id, c_custkey // 100 AS g, c_custkey % 10 * 4 AS x, c_custkey // 10 % 10 * 3 AS y FROM customer), b AS (SELECT g, i AS block, i * 13 AS x0, i * 13 + 13 AS x1 FROM (SELECT DISTINCT g FROM r), unnest(range(0, 4)) AS u(i)),
o AS (SELECT id, block, (least(x + 4, x1) - greatest(x, x0)) * 3 AS a FROM r JOIN b ON r.g = b.g WHERE least(x + 4, x1) > greatest(x, x0))
SELECT id AS space, arg_max(block, a * 100 + block)::BIGINT AS block, round(max(a) / 12.0, 6)::DOUBLE AS share FROM o GROUP BY 1""")
def majority_blocks(t):
    """The block that most of a space lies in."""
    k = F.col("c_custkey")
    x, y, g = k % 10 * 4, F.floor(k / 10) % 10 * 3, F.floor(k / 100)
    rooms = t.customer.select(k.alias("id"), g.alias("g"), _ring(x, y, x + 4, y + 3).alias("polygon_m"))
    blocks = rooms.select("g").distinct().crossJoin(t.spark.range(4)).select("g", "id", _ring(F.col("id") * 13, F.lit(-1), F.col("id") * 13 + 13, F.lit(99)).alias("polygon_m"))
    return J.majority_blocks(rooms, blocks, ["g"]).withColumn("share", F.round("share", 6))


@query("""WITH r AS (SELECT c_custkey AS id, c_custkey % 3 = 0 AS lobby, c_custkey % 20 + 5 AS area FROM customer), d AS (SELECT o_custkey AS room, CASE WHEN o_orderkey % 2 = 1 THEN (o_custkey + o_orderkey) % (SELECT count(*) FROM customer) END AS other FROM orders),
x AS (SELECT room, other FROM d WHERE other IS NOT NULL UNION SELECT other, room FROM d WHERE other IS NOT NULL)
SELECT r.id FROM r WHERE area <= 15 AND id IN (SELECT room FROM d WHERE other IS NULL) AND id IN (SELECT x.room FROM x JOIN r q ON x.other = q.id WHERE q.lobby)""")
def exterior_vestibules(t):
    """Small rooms between an outer door and a lobby."""
    k = F.col("c_custkey")
    n = t.customer.agg(F.count("*").alias("n"))
    rooms = t.customer.select(k.alias("id"), F.when(k % 3 == 0, "Main lobby").otherwise("office").alias("name"), (k % 20 + 5.0).alias("area_m2"))
    doors = t.orders.crossJoin(n).select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("room"), F.when(F.col("o_orderkey") % 2 == 1, (F.col("o_custkey") + F.col("o_orderkey")) % F.col("n")).alias("other"), F.col("o_orderkey").alias("place"))
    return C.exterior_vestibules(rooms, doors)


@query("""SELECT p_partkey AS plan_id, p_partkey + 1000000000 AS seen_id, CASE p_partkey % 2 WHEN 0 THEN 0.125 ELSE 0.25 END::DOUBLE AS distance FROM part WHERE p_partkey % 5 <> 0""")
def nearest_untaken(t):
    """Openings of a plan and an elevation paired one to one, nearest first."""
    k = F.col("p_partkey")
    plan = t.part.select(F.col("p_type").alias("g"), k.alias("plan_id"), (k * 2.0).alias("s"))
    seen = t.part.select(F.col("p_type").alias("g"), (k + 1000000000).alias("seen_id"), (k * 2.0 + F.when(k % 5 == 0, 0.9).when(k % 2 == 0, 0.125).otherwise(0.25)).alias("s"))
    return N.nearest_untaken(plan, seen, ["g"], "plan_id", "seen_id")


@query("""WITH p AS (SELECT p_partkey % 60 AS tilt, p_partkey * 7 % 360 AS az, p_size::DOUBLE AS a FROM part), n AS (SELECT *, sin(radians(tilt)) * sin(radians(az)) AS x, sin(radians(tilt)) * cos(radians(az)) AS y, cos(radians(tilt)) AS z FROM p),
s AS (SELECT -cos(radians(d)) * sin(radians(15 * (h - 12))) AS e, cos(radians(45)) * sin(radians(d)) - sin(radians(45)) * cos(radians(d)) * cos(radians(15 * (h - 12))) AS n, sin(radians(45)) * sin(radians(d)) + cos(radians(45)) * cos(radians(d)) * cos(radians(15 * (h - 12))) AS u FROM (VALUES (-23.45), (0.0), (23.45)) v(d), unnest(range(0, 24)) AS w(h))
SELECT CASE WHEN tilt < 0.5 THEN 'flat' ELSE ['N', 'E', 'S', 'W'][(floor((az + 45) % 360 / 90) + 1)::INT] END AS orientation, round(sum(a * greatest(0, x * e + y * s.n + z * u)), 3) AS aperture FROM n, s WHERE u > 1e-9 GROUP BY 1""")
def solar_aperture(t):
    """Area times the cosines to the sun, by orientation."""
    k = F.col("p_partkey")
    planes = t.part.select((k % 60).cast("double").alias("tilt_deg"), (k * 7 % 360).cast("double").alias("azimuth_deg"), F.col("p_size").cast("double").alias("area_m2"))
    return P.solar_aperture(planes, 45.0).withColumn("aperture", F.round("aperture", 3))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 2.5 WHEN c_custkey % 3 = 0 THEN NULL ELSE 0.1 END::DOUBLE AS start_m, CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 3 = 0 THEN 'no room' END AS reason FROM customer""")
def placed_openings(t):
    """Openings on their walls: where they are stated to be, else in the first free stretch."""
    k = F.col("c_custkey")
    rows = t.customer.select(k.alias("wall"), k.alias("id"), F.lit(1.0).alias("width_m"), F.when(k % 4 == 0, 3.0).alias("s_m"), F.when(k % 3 == 0, 1.1).otherwise(8.0).alias("wall_m"))
    return R.place_openings(rows, ["wall"]).select("id", "start_m", "reason")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def revision_numbers(t):
    """The log of each item, numbered in order."""
    return W.ranked(t.events, [F.col("ts"), F.col("event_id")], ["user_id"]).select("user_id", "event_id", F.col("seq").cast("bigint").alias("seq"))


@query("SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS seq FROM events")
def numbered_events(t):
    """A number over the whole table in a total order."""
    return W.numbered(t.events.select("event_id", "value"), ["value", "event_id"]).select("event_id", "seq")


@query("""WITH p AS (SELECT n_regionkey AS g, s_suppkey % 10 AS x, s_suppkey // 10 % 10 AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey), g AS (SELECT g, count(*) AS n, count(*) >= 3 AND var_pop(x) * var_pop(y) - pow(covar_pop(x, y), 2) > 1e-9 AS ok FROM p GROUP BY 1)
SELECT g, CASE WHEN ok THEN 2.0 END AS a, CASE WHEN ok THEN -3.0 END AS b, CASE WHEN ok THEN 5.0 END AS c, CASE WHEN ok THEN 1.0 END AS d, CASE WHEN ok THEN 4.0 END AS e, CASE WHEN ok THEN -1.0 END AS f, n FROM g""")
def affine_ties(t):
    """The plane map through tie points; none through too few or through those on one line."""
    x, y = (F.col("s_suppkey") % 10).cast("double"), (F.floor(F.col("s_suppkey") / 10) % 10).cast("double")
    ties = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("g"), x.alias("x"), y.alias("y"), (2 * x - 3 * y + 5).alias("tx"), (x + 4 * y - 1).alias("ty"))
    return R.fit_affine(ties, ["g"]).select("g", *[F.round(c, 6).alias(c) for c in "abcdef"], "n")


@query("""WITH b AS (SELECT s_nationkey AS g, s_suppkey AS label, s_suppkey * 100.0 AS u, s_suppkey + CASE WHEN s_suppkey % 10 = 0 THEN 0.5 ELSE 0 END AS s FROM supplier), f AS (SELECT g, regr_slope(s, u) AS k, regr_intercept(s, u) AS o, count(*) AS n FROM b GROUP BY 1)
SELECT b.g, round(k, 6) AS scale, round(o, 4) AS offset_m, round(max(abs(s - k * u - o)), 4) AS residual_m, CASE WHEN max(abs(s - k * u - o)) <= 0.05 THEN 0.95 ELSE 0.85 END::DOUBLE AS confidence FROM b JOIN f ON b.g = f.g WHERE n >= 2 AND k IS NOT NULL GROUP BY b.g, k, o""")
def grid_registration(t):
    """Elevation sheets laid on the building by the grid labels that both have."""
    s = F.col("s_suppkey")
    bubbles = t.supplier.select(F.col("s_nationkey").alias("g"), s.alias("label"), (s * 100.0).alias("u"))
    grid = t.supplier.select(s.alias("label"), (s + F.when(s % 10 == 0, 0.5).otherwise(0.0)).alias("s"))
    return R.register_grid(bubbles, grid, ["g"]).select("g", F.round("scale", 6).alias("scale"), F.round("offset", 4).alias("offset_m"), F.round("residual_m", 4).alias("residual_m"), "confidence")


@query("""SELECT n_nationkey, round(CASE WHEN n_nationkey % 4 IN (0, 1) THEN -1 ELSE 1 END / (n_nationkey + 1.0)::DOUBLE, 9) AS scale, round(CASE WHEN n_nationkey % 4 IN (0, 1) THEN 20.0 + 50.0 / (n_nationkey + 1.0) ELSE -50.0 / (n_nationkey + 1.0) END::DOUBLE, 9) AS offset_m FROM nation""")
def wall_registration(t):
    """Elevation sheets laid on the building by the drawn wall's start; north and east run backwards."""
    n = F.col("n_nationkey")
    sheets = t.nation.select(n, F.element_at(F.array(*map(F.lit, ("North", "East", "South", "West"))), (n % 4 + 1).cast("int")).alias("facade"), (n + 1.0).alias("px_per_m"), F.lit(50.0).alias("wall_u0_px"), F.lit(20.0).alias("facade_length_m"))
    return R.register_by_wall(sheets).select("n_nationkey", F.round("scale", 9).alias("scale"), F.round("offset", 9).alias("offset_m"))


@query("SELECT c_custkey AS id, min(c_custkey) OVER (PARTITION BY c_custkey // 21, c_custkey % 7) AS stack FROM customer")
def shaft_stacks(t):
    """Shafts of adjacent levels that are one."""
    k = F.col("c_custkey")
    x = F.floor(k / 21) * 1000 + k % 7 * 10
    shafts = t.customer.select(k.alias("id"), (F.floor(k / 7) % 3).alias("level_id"), _ring(x, F.lit(0), x + 2, F.lit(2)).alias("polygon_m"))
    levels = t.spark.createDataFrame([(0, 0.0), (1, 3.0), (2, 6.0)], "id bigint, elevation_z_m double")
    return J.shaft_stacks(shafts, levels)


@query("""WITH d AS (SELECT o_custkey AS id, arg_max(['confirm', 'reject', 'edit', 'revert'][o_orderkey % 4 + 1], o_orderkey) AS a, max(o_orderkey)::VARCHAR AS v FROM orders GROUP BY 1)
SELECT c_custkey AS id, CASE WHEN a IS NULL OR a = 'revert' THEN 'open' ELSE a END AS status, CASE WHEN a <> 'revert' THEN v END AS resolution FROM customer LEFT JOIN d ON c_custkey = id""")
def applied_decisions(t):
    """Review items with the last decision on each."""
    items = t.customer.select(F.col("c_custkey").alias("id"), F.lit("open").alias("status"))
    action = F.element_at(F.array(*map(F.lit, ("confirm", "reject", "edit", "revert"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    decisions = t.orders.select(F.col("o_custkey").alias("id"), action.alias("action"), F.col("o_orderkey").cast("string").alias("value"), F.col("o_orderkey").alias("seq"))
    return V.apply_decisions(items, decisions, "id", ["seq"])


_S = "s AS (SELECT r_name || '-' || c_custkey AS id, CASE WHEN c_custkey % 71 = 0 THEN -1 ELSE 1 END * (round(abs(c_acctbal), 0) + 10) AS a, 'Z' || c_nationkey AS z, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


@query(f"""WITH {_S}, z AS (SELECT z, '["' || string_agg(id, '","' ORDER BY id) || '"]' AS l FROM s WHERE k % 10 <> 0 GROUP BY 1)
SELECT 'count_spaces' AS method, count(*)::VARCHAR AS answer FROM s UNION ALL SELECT 'total_floor_area', round(sum(a), 3)::VARCHAR FROM s UNION ALL SELECT 'building_orientation', 'SE' UNION ALL SELECT 'zone_list', '{{' || (SELECT string_agg('"' || z || '":' || l, ',' ORDER BY z) FROM z) || '}}' UNION ALL SELECT 'query_dispatch', NULL""")
def asked_engine(t):
    """Questions answered over a building made of the tables."""
    e = Engine(battery.model(t), bearing_deg=140.0)
    out = None
    for q in ("How many spaces?", "total floor area", "which direction does it face", "list the zones", "who built it"):
        out = e.query(q).select("method", "answer") if out is None else out.unionByName(e.query(q).select("method", "answer"))
    return out


@query(f"""WITH {_S} SELECT (SELECT count(*) FROM s WHERE id = 'ASIA-7') AS by_number, (SELECT z FROM s WHERE id = 'ASIA-7' AND k % 10 <> 0) AS zone, (SELECT count(*) FROM s WHERE z = 'Z3' AND k % 10 <> 0) AS of_zone""")
def engine_lookups(t):
    """A space by its number, the zones of a space and the spaces of a zone."""
    e = Engine(battery.model(t))
    n = e.space_by_number("7", "ASIA").agg(F.count("*").alias("by_number"))
    return n.crossJoin(e.zones_of_space("ASIA-7").agg(F.max("zone_id").alias("zone"))).crossJoin(e.spaces_of_zone("Z3").agg(F.count("*").alias("of_zone")))


@query("SELECT user_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1")
def stream_history(t):
    """Every state that a stream brings, kept by batch."""
    import uuid

    path = f"{shared_folder(t.spark)}/history-{uuid.uuid4().hex}"
    q = E.keep_history(E.parquet_stream(t.spark, t.folder, "events"), f"{path}/rows", "user_id", "event_id", f"{path}/state")
    q.awaitTermination()
    return t.spark.read.parquet(f"{path}/rows").groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query("SELECT DISTINCT user_id FROM events")
def stream_new_items(t):
    """Items that come again in a stream change nothing."""
    return E.collect_stream(E.new_items(E.parquet_stream(t.spark, t.folder, "events"), "user_id", "ts", "3650 days"), "new", "append").select("user_id")


@query("""SELECT user_id, count(*) AS sessions, sum(n)::BIGINT AS n FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY 1, 2) GROUP BY 1""")
def stream_sessions(t):
    """Sessions of a stream that a gap of six hours ends."""
    got = E.collect_stream(E.session_counts(E.parquet_stream(t.spark, t.folder, "events"), "ts", "user_id", "6 hours"), "sessions", "complete")
    return got.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


@query("""SELECT p_partkey, (p_size + 1.0) * (p_size % 7 + 2) AS area, 2 * (p_size + 1.0 + p_size % 7 + 2) * 3 + 2 * (p_size + 1.0) * (p_size % 7 + 2) AS envelope, (p_size + 1.0) * (p_size % 7 + 2) AS hull, (p_size + 1.0) * (p_size % 7 + 2) * 3 AS volume, 4::BIGINT AS n_simple, 1.0 - 2 * (p_size + 1.0) AS ax, 3 * (p_size + 1.0) + 2.0 AS ay FROM part""")
def shapes(t):
    """Turned rings, envelopes, hulls, volumes, simplified rings and affine maps of rectangles."""
    w, h = (F.col("p_size") + 1).cast("double"), (F.col("p_size") % 7 + 2).cast("double")
    z, three = F.lit(0.0), F.lit(3.0)
    clockwise = F.array(F.array(z, z), F.array(z, h), F.array(w, h), F.array(w, z))
    v = lambda x, y, u: F.array(x, y, u)
    faces = F.array(
        F.array(v(z, z, z), v(z, h, z), v(w, h, z), v(w, z, z)), F.array(v(z, z, three), v(w, z, three), v(w, h, three), v(z, h, three)), F.array(v(z, z, z), v(w, z, z), v(w, z, three), v(z, z, three)),
        F.array(v(w, z, z), v(w, h, z), v(w, h, three), v(w, z, three)), F.array(v(w, h, z), v(z, h, z), v(z, h, three), v(w, h, three)), F.array(v(z, h, z), v(z, z, z), v(z, z, three), v(z, h, three)),
    )
    dotted = F.array(F.array(z, z), F.array(w / 2, F.lit(0.001)), F.array(w, z), F.array(w, h), F.array(z, h), F.array(w / 3, h / 3))
    bumpy = F.array(F.array(z, z), F.array(w / 2, F.lit(0.0001)), F.array(w, z), F.array(w, h), F.array(z, h))
    rows = t.part.select("p_partkey", clockwise.alias("ring"), faces.alias("faces"), dotted.alias("points"), bumpy.alias("bumpy"), w.alias("w"))
    rows = P.mapped(P.mapped(rows, P.convex_hull, "points", "hulled"), lambda r: P.simplify_ring(r, 0.01), "bumpy", "simple")
    ax, ay = G.affine("w", F.lit(1.0), (-2.0, 0.0, 1.0, 3.0, 2.0, 0.0))
    return rows.select("p_partkey", F.round(G.signed_area(G.counter_clockwise("ring")), 6).alias("area"), F.round(G.envelope_area("ring", three), 6).alias("envelope"), F.round(G.area("hulled"), 6).alias("hull"), F.round(G.shell_volume("faces"), 6).alias("volume"), F.size("simple").cast("bigint").alias("n_simple"), ax.alias("ax"), ay.alias("ay"))
