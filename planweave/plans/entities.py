"""Schedules out of drawings, value slots, room classes, sizing, heights, ground, daylight and borders."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.operators import adjacency as J
from planweave.operators import classify as C
from planweave.operators import entities as N
from planweave.operators import hvac as H
from planweave.operators import registration as R
from planweave.operators import revisions as V
from planweave.operators import takeoff as K
from planweave.plans.cases import cases
from planweave.plans.registry import query
from planweave.plans.wide import _ring
from planweave.plans.written import _text_files
from planweave.sources import readers


def _drawings(t):
    """A drawing for each 20 parts: three tables of parts by size, a block for each fourth part, an embedded sheet."""
    k = F.col("p_partkey")
    p = t.part.select(F.floor(k / 20).alias("file"), (k % 3).alias("e"), k.alias("k"), F.col("p_name").alias("name"))
    row = F.when(F.col("k") % 7 == 0, F.to_json(F.struct(F.col("name").alias("x")))).otherwise(F.to_json(F.array("name", F.col("k").cast("string"))))
    tables = p.groupBy("file", "e").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", row.alias("r")))), lambda s: s.r).alias("rows"))
    entity = F.concat(F.lit('{"layer":"A","handle":"H'), F.col("e"), F.lit('","type":"'), F.when(F.col("e") == 2, "LINE").otherwise("TABLE"), F.lit('","data":{"name":"T'), F.col("e"), F.lit('","headers":["name","key"],"rows":['), F.array_join("rows", ","), F.lit("]}}"))
    entities = tables.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("e", entity.alias("j")))), lambda s: s.j), ",").alias("entities"))
    block = F.concat(F.lit('{"block_name":"SCHEDULE","handle":"B","owner":"'), F.when(F.col("k") % 8 == 0, "H1").otherwise("H9"), F.lit('","x":'), F.when(F.col("k") % 12 == 0, '"far"').otherwise("1.5"), F.lit(',"y":2,"attributes":[{"tag":"key","value":"'), F.col("k"), F.lit('"},{"tag":"kind","value":"block"}]}'))
    blocks = p.where("k % 4 = 0").groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", block.alias("j")))), lambda s: s.j), ",").alias("blocks"))
    body = F.concat(F.lit('{"table_entities":['), "entities", F.lit('],"block_refs":['), F.coalesce("blocks", F.lit("")), F.lit('],"block_defs":{"SCHEDULE":{"name":"SCHEDULE 1"}},"ole_entities":[{"type":"Excel","source_entity":"H0","data":{"rows":[["sheet","'), "file", F.lit('"]]}},{"type":""}]}'))
    return N.drawings(entities.join(blocks, "file", "left").select("file", body.alias("body")))


_CELLS = """p AS (SELECT p_partkey // 20 AS file, p_partkey % 3 AS e, p_partkey AS k, p_name AS name FROM part), f AS (SELECT DISTINCT file FROM p),
t AS (SELECT file, min(e) FILTER (WHERE e < 2) AS first FROM p GROUP BY 1),
r AS (SELECT file, e AS tbl, 0 AS kind, k AS o, CASE WHEN k % 7 = 0 THEN ['{"x":"' || name || '"}'] ELSE [name, k::VARCHAR] END AS cells, CASE WHEN k % 7 = 0 THEN 0.5 ELSE 0.95 END::DOUBLE AS c, 'dwg_table_entity' AS m FROM p WHERE e < 2
UNION ALL SELECT file, CASE WHEN k % 8 = 0 AND (file, 1) IN (SELECT file, e FROM p) THEN 1 ELSE first END, 1, k, [k::VARCHAR, 'block'], CASE WHEN k % 12 = 0 THEN 0.5 ELSE 0.9 END, 'dwg_block_schedule' FROM p JOIN t USING (file) WHERE k % 4 = 0
UNION ALL SELECT file, CASE WHEN (file, 0) IN (SELECT file, e FROM p) THEN 0 ELSE first END, 2, 0, ['sheet', file::VARCHAR], 0.6, 'ole_spreadsheet' FROM t),
x AS (SELECT *, row_number() OVER (PARTITION BY file, tbl ORDER BY kind, o) - 1 AS row FROM r)"""


@query(f"""WITH {_CELLS} SELECT file, tbl::BIGINT AS tbl, row::BIGINT AS row, i - 1 AS col, cells[i] AS value, m AS method, c AS confidence FROM x, unnest(range(1, len(cells) + 1)) AS u(i)""")
def schedule_entities(t):
    """Every cell of the schedules in drawings' own entities, blocks and embedded sheets, with how sure it is."""
    c = N.schedule_cells(_drawings(t))
    return c.select("file", F.col("table").cast("bigint").alias("tbl"), F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), "value", "method", "confidence")


@query(f"""WITH {_CELLS} SELECT x.file, x.tbl::BIGINT AS tbl, 'T' || x.tbl AS name, 'name,key' AS headers, count(*) AS n_rows, CASE WHEN min(c) <= 0.5 THEN 0.5 ELSE 0.95 END::DOUBLE AS confidence FROM x GROUP BY x.file, x.tbl""")
def schedule_tables(t):
    """The schedules of drawings."""
    return N.schedule_tables(_drawings(t)).select("file", F.col("table").cast("bigint").alias("tbl"), "name", "headers", F.col("n_rows").cast("bigint").alias("n_rows"), "confidence")


cases("value_slots", "The slot that a unit, a qualifier and a family name.", "family string, unit string, qualifier string", "slot string, u string, confidence string, reason string", [
    ("ahu", "CFM", None, "airflow", "CFM", "high", None), ("vav_box", "cfm", "min", "airflow_min", "CFM", "high", None), ("vav_box", "L/s", "max", "airflow_max", "L/s", "high", None), ("pump", "GPM", None, "water_flow", "GPM", "high", None), ("fan", "watts", "motor", "power", "W", "high", None),
    ("heat_pump", "kW", "heating", "heating_capacity", "kW", "high", None), ("pump", "kW", None, "power", "kW", "medium", None), ("heat_pump", "kW", None, None, None, None, "power or thermal capacity"), ("pump", "ft", "head", "head", "ft", "high", None), ("pump", "ft", None, None, None, None, None), ("fan", "mm", None, None, None, None, None),
    ("chiller", "tons", None, "cooling_capacity", "ton", "medium", None), ("boiler", "MBH", None, "heating_capacity", "MBH", "medium", None), ("ahu", "MBH", "cooling", "cooling_capacity", "MBH", "high", None), ("ahu", "MBH", None, None, None, None, "cooling or heating"), ("desk", "ton", None, None, None, None, "no slot"),
], lambda: [C.value_slot(F.col("family"), F.col("unit"), F.col("qualifier"))[c] for c in ("slot", "unit", "confidence", "reason")])
cases("polygon_classes", "Room polygons by their evidence.", "area double, numbered boolean, label string, adjacent int, doors int, aspect double", "kind string, confidence double", [
    (1.5, False, "", 0, 0, 1.0, "shaft", 0.95), (5.0, False, "", 0, 0, 1.0, "closet", 0.9), (12.0, True, "SHAFT", 0, 0, 1.0, "room", 0.95), (5.0, True, "", 0, 0, 1.0, "room", 0.8), (9.0, False, "Elev 1", 0, 0, 1.0, "elevator_core", 0.9), (9.0, False, "STAIR", 0, 0, 1.0, "elevator_core", 0.9), (9.0, False, "pipe chase", 0, 0, 1.0, "shaft", 0.9),
    (9.0, False, "Storage", 0, 0, 1.0, "closet", 0.85), (9.0, False, None, 3, 0, 1.0, "room", 0.75), (9.0, False, "", 0, 3, 1.0, "room", 0.85), (9.0, False, "", 0, 0, 6.0, "shaft", 0.88), (9.0, False, "", 0, 0, 4.0, "closet", 0.88), (30.0, False, "", 9, 9, 9.0, "unassigned", 0.5),
], lambda: [C.polygon_class(F.col("area"), F.col("numbered"), F.col("label"), F.col("adjacent"), F.col("doors"), F.col("aspect"))[c] for c in ("kind", "confidence")])


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 4.5 WHEN o_orderkey % 3 = 1 THEN 2.0 END::DOUBLE AS s, CASE WHEN o_orderkey % 5 <> 0 THEN 10.5 END::DOUBLE AS z0, CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 12.0 ELSE 11.75 END END::DOUBLE AS z1, CASE WHEN o_orderkey % 7 = 0 THEN '@untagged' ELSE o_orderpriority END AS tag, CASE WHEN o_orderkey % 4 = 0 THEN 9.0 WHEN o_orderkey % 4 = 1 THEN 7.5 END::DOUBLE AS wall FROM orders""")
def opening_identities(t):
    """Where openings lie along and up their walls, what they must share to be one, and wall areas."""
    k = F.col("o_orderkey")
    o = F.struct(
        F.when(k % 3 == 0, 4.5).alias("s_center_m"), F.when(k % 3 == 1, F.array(F.lit(1.5), F.lit(2.5))).alias("host_interval_m"), F.when(k % 5 != 0, 0.5).alias("sill_m"), F.when(k % 2 == 0, 2.0).alias("head_m"), F.lit(1.25).alias("height_m"),
        F.lit("south").alias("host_facade"), F.when(k % 7 == 0, "").otherwise(F.col("o_orderpriority")).alias("tag"), F.lit("window").alias("category"),
    )
    rows = t.orders.select(k.alias("id"), o.alias("o"), F.when(k % 4 == 0, 9.0).alias("a"), F.when(k % 4 < 2, 2.5).alias("l"))
    z = R.opening_height(F.col("o"), F.lit(10.0))
    return rows.select("id", R.opening_place(F.col("o")).alias("s"), z.z0.alias("z0"), z.z1.alias("z1"), R.opening_group(F.col("o")).tag.alias("tag"), R.wall_area(F.col("a"), F.col("l"), F.lit(3.0)).alias("wall"))


@query("""WITH i AS (SELECT DISTINCT l_partkey AS e, l_returnflag AS u, l_linestatus AS f, l_quantity AS v FROM lineitem), g AS (SELECT e, u, f, CASE WHEN count(*) = 1 THEN max(v) END AS total FROM i GROUP BY 1, 2, 3)
SELECT CASE f WHEN 'F' THEN 'airflow' ELSE 'airflow_max' END AS field, u AS unit, sum(total) AS total, count(total) AS n FROM g GROUP BY 1, 2 HAVING count(total) > 0""")
def sized_loads(t):
    """Totals of what schedules state for zone loads; equipment that states two values has none."""
    rows = t.lineitem.select(F.col("l_partkey").alias("equipment"), F.when(F.col("l_linestatus") == "F", "airflow").otherwise("airflow_max").alias("field"), F.col("l_quantity").alias("value"), F.col("l_returnflag").alias("unit"), F.lit("").alias("raw"), F.lit("S").alias("sheet"), F.col("l_orderkey").alias("row"), F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag").alias("cell"))
    other = rows.limit(0).unionByName(rows.withColumn("field", F.lit("power")))
    return H.sized(H.zone_load_inputs(rows.unionByName(other), rows))[1]


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN round(0.05 * (c_custkey % 9 + 1), 3) END::DOUBLE AS people, CASE WHEN c_custkey % 4 = 0 THEN round((c_custkey % 7 + 1) * 10.0, 3) END::DOUBLE AS lighting, CASE WHEN c_custkey % 3 <> 0 THEN 2 ELSE 0 END + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END + 1 + CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS n FROM customer""")
def load_properties(t):
    """Load properties of spaces, without those that aren't known."""
    k = F.col("c_custkey")
    m = H.load_properties(F.when(k % 3 != 0, 0.05), (k % 9 + 1).cast("double"), F.when(k % 4 == 0, (k % 7 + 1) * 10.0), F.lit(120.0), F.lit(8.0))
    return t.customer.select(k.alias("id"), m.alias("m")).select("id", F.try_element_at("m", F.lit("OccupancyNumber")).alias("people"), F.try_element_at("m", F.lit("Lighting")).alias("lighting"), F.size("m").alias("n"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE event_id % 3 = 0) AS undone, count(*) FILTER (WHERE event_type = 'click') AS human, count(*) FILTER (WHERE event_type = 'view') AS auto FROM events")
def correction_counts(t):
    """Corrections by who made them."""
    c = t.events.select((F.col("event_id") % 3 == 0).alias("undone"), F.when(F.col("event_type") == "click", "human").when(F.col("event_type") == "view", "auto").otherwise("import").alias("source"))
    return V.correction_counts(c)


@query("SELECT o_orderkey AS id, o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 AS acknowledged, o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AS now FROM orders")
def acknowledged(t):
    """The queue with everything that waits acknowledged."""
    k = F.col("o_orderkey")
    return V.acknowledged(t.orders.select(k.alias("id"), (k % 2 == 0).alias("needs_review"), (k % 3 == 0).alias("acknowledged"))).select("id", "acknowledged", "now")


@query("""WITH s AS (SELECT p_partkey AS f, CASE p_partkey % 4 WHEN 0 THEN 'floor_plan' WHEN 1 THEN 'partial_plan' WHEN 2 THEN 'section' ELSE 'partial_plan' END AS k, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS d, CASE WHEN p_size % 7 <> 0 THEN p_size END AS l FROM part)
SELECT f AS file FROM s a WHERE k = 'partial_plan' AND EXISTS (SELECT 1 FROM s b WHERE b.k = 'floor_plan' AND b.d IS NOT DISTINCT FROM a.d AND b.l IS NOT DISTINCT FROM a.l)""")
def covered_partials(t):
    """Partial plans that a full plan covers."""
    k, z = F.col("p_partkey"), F.col("p_size")
    kind = F.when(k % 4 == 0, "floor_plan").when(k % 4 == 2, "section").otherwise("partial_plan")
    return V.covered_partials(t.part.select(k.alias("file"), kind.alias("kind"), F.when(z % 5 != 0, F.col("p_brand")).alias("discipline"), F.when(z % 7 != 0, z).alias("level")))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_quantity) AS r FROM lineitem) SELECT r = 1 AS kept, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM r GROUP BY 1""")
def first_surfaces(t):
    """The first of surfaces with one geometry stays."""
    keep, rest = V.first_of_each(t.lineitem, [F.col("l_orderkey"), F.col("l_linenumber")], ["l_extendedprice", "l_quantity"])
    told = lambda x, kept: x.agg(F.lit(kept).alias("kept"), F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    return told(keep, True).unionByName(told(rest, False).where("n > 0"))


@query("""WITH m AS (SELECT s_nationkey AS lv, s_suppkey AS sheet, 3.0 + CASE WHEN s_nationkey % 2 = 0 THEN 0.01 * (s_suppkey % 3) ELSE 0.5 * (s_suppkey % 3) END AS h FROM supplier), g AS (SELECT lv, avg(h) AS a, max(h) - min(h) AS d, string_agg(sheet || ': ' || printf('%.2f', h) || ' m', '; ' ORDER BY sheet || ': ' || printf('%.2f', h) || ' m') AS said FROM m GROUP BY 1)
SELECT n_nationkey AS level, round(CASE WHEN n_nationkey % 5 = 0 THEN 4.0 WHEN d <= 0.05 THEN a ELSE 3.0 END, 4)::DOUBLE AS height_m, CASE WHEN n_nationkey % 5 = 0 THEN 'config' WHEN d <= 0.05 THEN 'elevation_level_marks' ELSE 'storey_height_default' END AS source, CASE WHEN n_nationkey % 5 <> 0 AND d > 0.05 THEN said ELSE '' END AS conflict FROM nation LEFT JOIN g ON lv = n_nationkey""")
def level_heights(t):
    """Heights of levels: stated, as the marks agree, or by default."""
    n, s = F.col("s_nationkey"), F.col("s_suppkey")
    marks = t.supplier.select(n.alias("level"), s.cast("string").alias("sheet"), (3.0 + F.when(n % 2 == 0, 0.01 * (s % 3)).otherwise(0.5 * (s % 3))).alias("height_m"))
    levels = t.nation.select(F.col("n_nationkey").alias("level"))
    return V.level_heights(levels, marks, levels.where("level % 5 = 0").withColumn("height_m", F.lit(4.0)))


@query("""WITH g AS (SELECT event_type AS arm, count(value) AS n, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1) SELECT arm, n, round(m, 6) AS mean, round(s, 6) AS sd, round(m - (SELECT m FROM g WHERE arm = 'click'), 6) AS delta FROM g""")
def arm_stats(t):
    """Means and spreads of runs by arm."""
    out = V.arm_stats(t.events, "event_type", "value", "click")
    return out.select(F.col("event_type").alias("arm"), "n", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "delta")])


@query("""SELECT upper(replace(p_brand, ' ', '')) AS key, max(p_partkey) AS id, count(*) > 1 AS noted FROM part GROUP BY 1""")
def noted_duplicates(t):
    """The last schedule row of each tag, with a note where it replaced another."""
    out = K.last_wins_noted(t.part, "p_brand", [F.col("p_partkey")])
    return out.select("key", F.col("p_partkey").alias("id"), F.col("note").isNotNull().alias("noted"))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 40 < 30 THEN 1 + 0.5 * ((c_custkey % 40) + 0.25) + CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 0 END END::DOUBLE AS z FROM customer""")
def ground_heights(t):
    """The ground under points, by the highest triangle there; none beyond the terrain."""
    k = F.col("c_custkey")
    corner = lambda x, y, lift: [(x, y, 1 + 0.5 * x + lift)]
    tri = []
    for x in range(0, 30, 10):
        for lift, y0 in ((0.0, 0.0), (0.0, 20.0), (5.0, 20.0)):
            a, b, c, d = (corner(x, y0, lift), corner(x + 10, y0, lift), corner(x + 10, y0 + 10, lift), corner(x, y0 + 10, lift))
            tri += [tuple(v for p in (*a, *b, *c) for v in p), tuple(v for p in (*a, *c, *d) for v in p)]
    names = ", ".join(f"{c}{i} double" for i in range(3) for c in "xyz")
    triangles = t.spark.createDataFrame([tuple(map(float, r)) for r in tri], names)
    points = t.customer.select(k.alias("id"), (k % 40 + 0.25).alias("x"), F.when(k % 3 == 0, 24.5).otherwise(4.5).alias("y"))
    return J.ground_at(points, triangles, 8.0).withColumn("z", F.round("z", 6))


@query("""SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'UndergroundWall' WHEN 1 THEN 'ExteriorWall' WHEN 2 THEN 'Split' END AS kind FROM customer""")
def walls_by_grade(t):
    """Walls above, below and across the ground."""
    k = F.col("c_custkey")
    walls = t.customer.select(k.alias("id"), F.lit(0.0).alias("z0"), F.lit(3.0).alias("z1"))
    z = F.when(k % 4 == 0, F.array(F.lit(3.0), F.lit(4.0))).when(k % 4 == 1, F.array(F.lit(0.0), F.lit(-1.0))).when(k % 4 == 2, F.array(F.lit(0.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0), F.lit(None).cast("double")))
    return J.wall_by_grade(t.customer.select(k.alias("wall"), F.explode(z).alias("z")), walls)


@query("""SELECT c_custkey AS skylight, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN round((least(10, c_custkey % 10 + 0.5 + 2.1) - greatest(0, c_custkey % 10 - 0.5 - 2.1)) * (least(8, 4.0 + 1 + 2.1) - greatest(0, 4.0 - 1 - 2.1)), 4) END::DOUBLE AS area_m2 FROM customer""")
def skylit_areas(t):
    """Daylight under skylights, inside their rooms."""
    k = F.col("c_custkey")
    spaces = t.customer.select(k.alias("id"), _ring(F.lit(0), F.lit(0), F.lit(10), F.lit(8)).alias("polygon_m"), F.when(k % 5 != 0, 3.0).alias("ceiling_m"))
    lights = t.customer.select(k.alias("id"), k.alias("space_id"), F.when(k % 7 != 0, (k % 10).cast("double")).alias("cx"), F.lit(4.0).alias("cy"), F.lit(1.0).alias("width_m"), F.lit(2.0).alias("height_m"))
    return J.skylit_areas(spaces, lights).select("skylight", "area_m2")


@query("""WITH r AS (SELECT c_custkey AS id, c_custkey // 63 AS level_id, c_custkey % 7 AS i, c_custkey // 7 % 9 AS j FROM customer)
SELECT a.level_id, a.id AS a, b.id AS b, CASE WHEN a.j = b.j THEN 3.0 - CASE WHEN a.i % 2 = 0 THEN 2.0 ELSE 0 END ELSE 4.0 END::DOUBLE AS length FROM r a JOIN r b ON a.level_id = b.level_id AND a.id < b.id WHERE (a.i = b.i AND abs(a.j - b.j) = 1) OR (a.j = b.j AND abs(a.i - b.i) = 1)""")
def open_borders(t):
    """Edges that two rooms share with no wall along them."""
    k = F.col("c_custkey")
    i, x, y = k % 7, k % 7 * 4, F.floor(k / 7) % 9 * 3
    rooms = t.customer.select(k.alias("id"), F.floor(k / 63).alias("level_id"), _ring(x, y, x + 4, y + 3).alias("polygon_m"), i.alias("i"), y.alias("y"))
    lines = J.wall_segments(rooms, ["level_id"]).join(rooms.select("id", "i", "y"), "id")
    # A wall of 2 m on the right-hand edge of every other room.
    right = lines.where(F.col("line").startswith("0.0|1.0|") & (F.split("line", r"\|")[2].cast("double") == (F.col("i") + 1) * 4) & (F.col("i") % 2 == 0))
    walls = right.select("level_id", "line", "lo", (F.col("lo") + 2).alias("hi"))
    return J.open_borders(rooms.drop("i", "y"), ["level_id"], walls).withColumn("length", F.round("length", 6))


@query("""SELECT 's' || n_nationkey AS sheet, CASE WHEN n_nationkey % 5 <> 0 THEN 'A-' || (100 + n_nationkey) END AS number, CASE WHEN n_nationkey % 5 <> 0 THEN 'A' END AS discipline, CASE n_nationkey % 3 WHEN 0 THEN 'floor_plan' WHEN 1 THEN 'elevation' END AS kind, CASE n_nationkey % 3 WHEN 0 THEN 'L2' END AS level FROM nation""")
def sheet_index(t):
    """Numbers, types and levels of ingested sheets, read from their texts."""
    n = F.col("n_nationkey")
    text = F.array(
        F.struct(F.when(n % 5 != 0, F.concat(F.lit("A"), 100 + n)).otherwise("K-101").alias("text"), F.array(*[F.lit(float(v)) for v in (900, 700, 950, 720)]).alias("bbox")),
        F.struct(F.when(n % 3 == 0, "SECOND FLOOR PLAN").when(n % 3 == 1, "BUILDING ELEVATIONS").otherwise("MEDICAL CLINIC").alias("text"), F.array(*[F.lit(float(v)) for v in (500, 690, 800, 715)]).alias("bbox")),
        F.struct(F.when(n % 3 == 2, "OFFICE").otherwise("SEE DETAIL").alias("text"), F.array(*[F.lit(float(v)) for v in (10, 10, 60, 18)]).alias("bbox")),
    )
    body = F.to_json(F.struct((n + 1).alias("page_number"), F.lit(1000.0).alias("width_pt"), F.lit(750.0).alias("height_pt"), F.lit("vector").alias("kind"), text.alias("text")))
    pages = readers.sheets(t.spark, _text_files(t, t.nation.select(n.alias("file"), body.alias("value")), "sheets")).where("page_number is not null")
    out = readers.sheet_index(pages)
    return out.select(F.concat(F.lit("s"), F.col("page_number") - 1).alias("sheet"), "number", "discipline", "kind", "level")


@query("""SELECT upper(r_name) AS description, CASE r_regionkey % 2 WHEN 0 THEN 'supply' ELSE 'return' END AS kind FROM region""")
def legend_tags(t):
    """Legend tags of a side file."""
    r = F.col("r_regionkey")
    tags = t.region.agg(F.to_json(F.struct(F.lit("tags/1").alias("schema"), F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit(" "), F.lower("r_name")), F.when(r % 2 == 0, "supply").otherwise("return")))).alias("tags"))).alias("value"), F.lit(0).alias("file"))
    return readers.legend_tags(t.spark, _text_files(t, tags, "tags"), ["supply", "return"], "tags/1")


@query("""WITH r AS (SELECT c_custkey AS k, max(c_custkey) OVER () AS top FROM customer), s AS (SELECT k, CASE WHEN k + 7 <= top THEN k + 7 WHEN k + 1 <= top THEN NULL ELSE k - 1 END AS target FROM r WHERE k % 63 = 3)
SELECT k AS id, CASE WHEN k IN (SELECT target FROM s) THEN 24.0 ELSE 12.0 END::DOUBLE AS area_m2, CASE WHEN k IN (SELECT target FROM s) THEN 1 ELSE 0 END AS n FROM r WHERE k NOT IN (SELECT k FROM s WHERE target IS NOT NULL)""")
def merged_rooms(t):
    """Closets merged into the room that shares most of their wall."""
    k = F.col("c_custkey")
    x, y = k % 7 * 4, F.floor(k / 7) % 9 * 3
    rooms = t.customer.select(k.alias("id"), F.floor(k / 63).alias("level_id"), _ring(x, y, x + 4, y + 3).alias("polygon_m"))
    left, _ = J.merged(rooms, rooms.where("id % 63 = 3"), ["level_id"])
    return left.select("id", F.round("area_m2", 6).alias("area_m2"), F.size("absorbed").alias("n"))


@query("""WITH q AS (SELECT p_partkey, p_size + 10.0 AS w, p_size % 7 + 8.0 AS h FROM part) SELECT p_partkey, ((w - 6) * (h - 6))::DOUBLE AS core, 2 * 3 * (w - 3) AS north_south, 2 * 3 * (h - 3) AS east_west, 5::BIGINT AS n FROM q""")
def perimeter_zones(t):
    """Zones along the sides of rooms and their cores."""
    from planweave.operators import polygons as P

    w, h = (F.col("p_size") + 10).cast("double"), (F.col("p_size") % 7 + 8).cast("double")
    z = F.lit(0.0)

    @F.pandas_udf("array<struct<facing: string, ring: array<array<double>>>>")
    def zones(rings):
        return rings.map(lambda r: [{"facing": f, "ring": p} for f, p in P.perimeter_core([list(v) for v in r], 3.0)])

    from planweave.functions import geometry as G

    parts = t.part.select("p_partkey", F.explode(zones(F.array(F.array(z, z), F.array(w, z), F.array(w, h), F.array(z, h)))).alias("p")).select("p_partkey", "p.facing", G.area("p.ring").alias("a"))
    total = lambda *f: F.round(F.sum(F.when(F.col("facing").isin(*f), F.col("a")).otherwise(0.0)), 6)
    return parts.groupBy("p_partkey").agg(total("core").alias("core"), total("north", "south").alias("north_south"), total("east", "west").alias("east_west"), F.count("*").alias("n"))
