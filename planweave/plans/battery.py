"""The battery of 49 rules over a building made of the tables, every rule with its own SQL.

Regions are levels, customers spaces, orders openings, suppliers walls, parts
fixtures, nations zones and roofs.  Defects come from the keys.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from planweave.checks import rules
from planweave.plans.registry import query
from planweave.session import local, release, stored

_FACADES = ("north", "east", "south", "west")


def _pick(k, values):
    return F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))


def _box(a):
    z, one = F.lit(0.0), F.lit(1.0)
    return F.array(F.array(z, z), F.array(a, z), F.array(a, one), F.array(z, one))


def model(t):
    """The building.  What several rules read is written once: what joins give, from which the other columns follow as they are read."""
    k = F.col("c_custkey")
    place = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    place = place.select(k, "c_nationkey", "r_name", (F.round(F.abs("c_acctbal"), 0) + 10).alias("area"))
    place = stored(place.repartition("c_custkey"), "battery")  # else as few tasks as the customers' file has row groups
    area = F.col("area")
    spaces = place.select(
        F.concat_ws("-", "r_name", k).alias("id"), F.when(k % 211 != 0, F.col("r_name")).alias("level_id"), F.when(k % 50 == 0, F.lit("1")).otherwise(k.cast("string")).alias("number"), F.when(k % 71 == 0, -area).otherwise(area).alias("area_m2"),
        F.when(k % 97 == 0, area * 5).otherwise(area * 4).alias("volume_m3"), F.when(k % 83 == 0, F.lit("attic")).otherwise(F.lit("room")).alias("poly_type"), F.when(k % 101 != 0, F.lit("A-101")).alias("sheet_id"),
        (k % 30).cast("double").alias("lpd_w_m2"), ((k % 30) / rules.W_PER_FT2 + F.when(k % 300 == 7, 1.0).otherwise(0.0)).alias("lpd_w_ft2"), F.when(k % 61 != 0, _box(area)).alias("polygon_m"), _pick(k, ("office", "lobby", "other")).alias("name"), k.alias("k"),
    )
    r = F.col("r_regionkey")
    levels = t.region.select(F.col("r_name").alias("id"), F.col("r_name").alias("name"), (r * 4.0).alias("elevation_z_m"), F.lit(4.0).alias("wall_height_m"))
    # Stated footprints: the spaces' areas, a tenth more in every other region.
    footprints = spaces.join(t.region, F.col("level_id") == F.col("r_name")).groupBy("level_id").agg((F.sum("area_m2") * (1 + 0.1 * (F.max(r) % 2))).alias("area_m2"), F.lit(100.0).alias("perimeter_m"))
    o = F.col("o_orderkey")
    kind = F.when(o % 43 == 0, F.lit("skylight")).when(F.col("o_orderstatus") == "O", F.lit("window")).otherwise(F.lit("door"))
    of_space = spaces.select(F.col("k").alias("o_custkey"), F.col("id").alias("sid")).hint("merge")
    pool = ThreadPoolExecutor(4)
    write = lambda x: pool.submit(stored, x, "battery")  # noqa: E731  # while the next are built
    attached = write(t.orders.join(of_space, "o_custkey", "left").select(o, "o_orderstatus", "o_orderpriority", "sid"))
    footprints = write(footprints)
    s = F.col("s_suppkey")
    walls = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("W"), s).alias("id"), F.col("r_name").alias("level_id"), _pick(s, _FACADES).alias("facade"), (s % 10 + 1).cast("double").alias("length_m"), F.lit(4.0).alias("height_m"), F.when(s % 9 != 0, (s % 10 + 1) * 4.0).alias("area_m2"),
        F.when(s % 13 != 0, _pick(s, ("mass", "steel", "wood"))).alias("construction"), (s % 5 / 8).alias("u_si"), F.when(s % 2 == 0, s % 5 / 8 + F.when(s % 17 == 0, 0.5).otherwise(0.0)).alias("stated_u"), F.lit("A-1").alias("sheet_id"),
    )
    schedules = t.orders.select(F.col("o_orderpriority").alias("tag")).distinct().where("tag <> '5-LOW'").select("tag", F.lit(1.0).alias("width_m"), F.when(F.col("tag") == "2-HIGH", 3.0).otherwise(2.0).alias("height_m"), F.lit(None).cast("double").alias("watts"))
    lamps = t.part.select(F.col("p_type").alias("tag")).distinct().where("tag <> 'PROMO'").select("tag", F.lit(None).cast("double").alias("width_m"), F.lit(None).cast("double").alias("height_m"), F.lit(60.0).alias("watts"))
    fixtures = write(t.part.join(spaces.select(F.col("k").alias("p_partkey"), F.col("id").alias("space_id")).hint("merge"), "p_partkey", "left").select(F.concat(F.lit("F"), F.col("p_partkey")).alias("id"), "space_id", F.col("p_type").alias("tag"), F.when(F.col("p_partkey") % 19 != 0, F.lit("E-1")).alias("sheet_id")))
    n = F.col("n_nationkey")
    zones = t.nation.select(F.concat(F.lit("Z"), n).alias("id"), (n % 6).cast("long").alias("n_diffusers"), _pick(n, ("AHU", "VAV")).alias("system"), (n % 3 + 2.0).alias("efficiency"), F.lit("small").alias("size_class"))
    zone = place.select(F.concat(F.lit("Z"), F.col("c_nationkey")).alias("zone_id"), k.alias("k"), F.concat_ws("-", "r_name", k).alias("space_id"))
    zone_spaces = zone.where("k % 10 <> 0").select("zone_id", "space_id")
    space_zones = zone.where("k % 10 <> 0 and k % 20 <> 1").select("space_id", "zone_id").unionByName(zone.where("k % 90 = 0").select("space_id", F.lit("Z99").alias("zone_id")))
    components = spaces.select(F.concat(F.lit("C"), F.col("k") - F.when(F.col("k") % 6 == 1, 1).otherwise(0)).alias("id"), F.col("id").alias("space_id"), F.lit("M-1").alias("sheet_id"))
    top = t.region.agg(F.max_by("r_name", "r_regionkey").alias("level_id"))
    roofs = write(t.nation.crossJoin(top).join(spaces.select("k", F.col("id").alias("sid")).hint("merge"), n == F.col("k"), "left").select(F.concat(F.lit("R"), n).alias("id"), F.col("sid").alias("space_id"), "level_id", (n + 1.0).alias("area_m2"), F.lit(0.0).alias("tilt_deg"), F.lit(None).cast("double").alias("azimuth_deg"), (n % 4 / 8).alias("u_si"), F.lit("metal").alias("construction")))
    schedules = write(schedules.unionByName(lamps))
    shading = t.supplier.select(F.concat(F.lit("H"), s).alias("id"), F.concat(F.when(s % 8 == 0, F.lit("X")).otherwise(F.lit("W")), s).alias("host_id"), (s % 7).cast("double").alias("depth_m"))
    review = t.orders.where("o_orderkey % 100 = 1").select(o.cast("string").alias("id"), F.when(o % 500 == 1, F.lit("fixture_unmatched")).otherwise(F.lit("kind")).alias("kind"), F.when(o % 300 != 1, F.lit("text")).alias("description"), F.lit("open").alias("status"), (o % 200 == 1).alias("needs_review"), F.lit(False).alias("acknowledged"))
    made = lambda rows, schema: local(t.spark, rows, schema)
    cube = [[[0, 0, 0], [0, 1, 0], [1, 1, 0], [1, 0, 0]], [[0, 0, 1], [1, 0, 1], [1, 1, 1], [0, 1, 1]], [[0, 0, 0], [1, 0, 0], [1, 0, 1], [0, 0, 1]], [[1, 0, 0], [1, 1, 0], [1, 1, 1], [1, 0, 1]], [[1, 1, 0], [0, 1, 0], [0, 1, 1], [1, 1, 1]], [[0, 1, 0], [0, 0, 0], [0, 0, 1], [0, 1, 1]]]
    faces = made([([[[float(x) for x in v] for v in f] for f in cube],)], "faces array<array<array<double>>>")
    shells = t.region.crossJoin(faces).select(F.col("r_name").alias("id"), F.when(r % 3 == 2, F.slice("faces", 1, 5)).otherwise(F.col("faces")).alias("faces"))
    attached, fixtures, roofs, footprints, schedules = (x.result() for x in (attached, fixtures, roofs, footprints, schedules))
    pool.shutdown()
    release(t.spark)
    openings = attached.select(
        o.cast("string").alias("id"), F.when(o % 37 != 0, F.col("sid")).alias("space_id"), F.when(o % 41 != 0, F.col("o_orderpriority")).otherwise(F.lit(" ")).alias("tag"), kind.alias("category"),
        F.lit(1.0).alias("width_m"), F.when(o % 53 == 0, 0.0).otherwise(2.0).alias("height_m"), F.lit(2.0).alias("area_m2"), F.lit("A-201").alias("sheet_id"), _pick(o, _FACADES).alias("host_facade"),
        F.when(o % 59 == 0, -1.0).otherwise(0.5).alias("sill_m"), F.when(o % 67 == 0, 4.5).otherwise(2.5).alias("head_m"), (o % 50 / 4).alias("s_center_m"), F.lit(0.0).alias("s0_m"), F.lit(12.0).alias("s1_m"), (o % 9 / 4).alias("u_si"),
    )
    daylight = attached.where("o_orderstatus = 'O' and sid is not null").select(o.cast("string").alias("id"), F.col("sid").alias("space_id"), F.lit(400.0).alias("area_m2"))
    return rules.Model(
        t.spark, spaces=spaces, levels=levels, openings=openings, review=review, footprints=footprints, walls=walls, schedules=schedules, fixtures=fixtures, zones=zones, zone_spaces=zone_spaces, space_zones=space_zones, components=components, roofs=roofs,
        roofs_before=roofs.withColumn("area_m2", F.col("area_m2") * 1.05), daylight=daylight, shading=shading, shells=shells,
        export_spaces=spaces.where("k % 100 <> 0").select("id", "area_m2", "volume_m3"), export_surfaces=walls.select("id", F.coalesce("area_m2", F.lit(1.0)).alias("area_m2")), export_openings=t.orders.select(o.cast("string").alias("id"), F.concat(F.lit("W"), o % 150).alias("surface_id")),
        ifc_counts=made([("IfcSpace", 5), ("IfcWall", 0)], "kind string, n bigint"), simplified=t.region.select(F.col("r_name").alias("level_id"), F.lit(100.0).alias("area_before"), (100.0 - 2 * r).alias("area_after"), (r / 4).alias("offset_m"), F.lit(0.03).alias("budget")),
        limits=made([("wall", "mass", 0.3), ("wall", "steel", 0.45), ("roof", "metal", 0.2), ("window", "window", 1.5)], "surface string, class string, u_max double"), lpd_limits=made([("office", 11.0), ("other", 20.0)], "name string, lpd_max double"),
        efficiency_limits=made([("AHU", "small", 3.0), ("*", "*", 2.5)], "system string, size_class string, least double"), conventions=made([(100.0, 105.0, 0.3), (100.0, 120.0, 0.3)], "interior_m3 double, exterior_m3 double, thickness_m double"),
    )


def _sql() -> str:
    facade = lambda c: "['north', 'east', 'south', 'west'][" + c + " % 4 + 1]"
    tables = f"""
s AS (SELECT r_name || '-' || c_custkey AS id, CASE WHEN c_custkey % 211 <> 0 THEN r_name END AS lv, CASE WHEN c_custkey % 50 = 0 THEN '1' ELSE c_custkey::VARCHAR END AS number, round(abs(c_acctbal), 0) + 10 AS a0, CASE WHEN c_custkey % 71 = 0 THEN -1 ELSE 1 END * (round(abs(c_acctbal), 0) + 10) AS a, CASE WHEN c_custkey % 97 = 0 THEN 5 ELSE 4 END * (round(abs(c_acctbal), 0) + 10) AS v, r_name, c_nationkey AS n, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
f AS (SELECT lv, sum(a) * (1 + 0.1::DOUBLE * (max(r_regionkey) % 2)) AS a FROM s JOIN region ON lv = region.r_name GROUP BY 1),
o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 37 <> 0 THEN s.id END AS sid, CASE WHEN o_orderkey % 41 <> 0 THEN o_orderpriority ELSE ' ' END AS tag, CASE WHEN o_orderkey % 43 = 0 THEN 'skylight' WHEN o_orderstatus = 'O' THEN 'window' ELSE 'door' END AS category, {facade('o_orderkey')} AS facade, o_orderkey % 50 / 4.0 AS c FROM orders LEFT JOIN s ON s.k = o_custkey),
w AS (SELECT s_suppkey AS k, r_name AS lv, {facade('s_suppkey')} AS facade, (s_suppkey % 10 + 1) * 4.0 AS a, CASE WHEN s_suppkey % 13 <> 0 THEN ['mass', 'steel', 'wood'][s_suppkey % 3 + 1] END AS cons, s_suppkey % 5 / 8.0 AS u FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
top AS (SELECT r_name AS lv FROM region ORDER BY r_regionkey DESC LIMIT 1),
fs AS (SELECT facade, sum(a) AS w FROM w GROUP BY 1), os AS (SELECT facade, 2.0 * count(*) AS o FROM o WHERE category <> 'skylight' GROUP BY 1),
zs AS (SELECT 'Z' || n AS z, id FROM s WHERE k % 10 <> 0), sz AS (SELECT z, id FROM (SELECT 'Z' || n AS z, id, k FROM s) WHERE k % 10 <> 0 AND k % 20 <> 1 UNION ALL SELECT 'Z99', id FROM s WHERE k % 90 = 0)"""
    n = {  # the number of entities that break each rule; then what breaking it means
        "C01": ("SELECT count(*) FROM s WHERE k % 61 = 0 OR k % 71 = 0", "warn"),
        "C02": ("SELECT (SELECT count(*) FROM s WHERE lv IS NULL) + (SELECT count(*) FROM f JOIN region ON lv = r_name WHERE r_regionkey % 2 = 1)", "error"),
        "C03": ("SELECT count(*) FROM s WHERE k % 97 = 0 OR k % 71 = 0 OR lv IS NULL", "warn"),
        "C04": ("SELECT count(*) FROM (SELECT s.lv, sum(v) AS v, max(f.a) * 4 AS e FROM s JOIN f ON s.lv = f.lv GROUP BY 1) WHERE abs(v - e) > 0.03 * abs(e)", "error"),
        "C05": ("SELECT 1", "warn"),
        "C06": ("SELECT count(*) FROM (SELECT sid, 2.0 * count(*) AS sky FROM o WHERE category = 'skylight' GROUP BY 1) x LEFT JOIN (SELECT id, sum(n_nationkey + 1.0) AS roof FROM nation JOIN s ON s.k = n_nationkey GROUP BY 1) y ON x.sid = y.id WHERE sky > coalesce(roof, 0) + 1e-6", "error"),
        "C07": ("SELECT count(*) FROM f JOIN top ON f.lv = top.lv WHERE abs((SELECT sum(n_nationkey + 1.0) FROM nation) - f.a) > 0.01 * abs(f.a)", "error"),
        "C08": ("SELECT 1", "error"),
        "C09": ("SELECT count(*) FROM (SELECT s.id, 400.0 * count(*) AS d, max(s.a) AS a FROM orders JOIN s ON s.k = o_custkey WHERE o_orderstatus = 'O' GROUP BY 1) WHERE d > a * 1.001", "error"),
        "C10": ("SELECT count(*) FILTER (WHERE cons IS NULL) + count(*) FILTER (WHERE k % 34 = 0) FROM w", "warn"),
        "C11": ("SELECT count(*) FROM supplier WHERE s_suppkey % 8 = 0 OR s_suppkey % 7 > 5", "error"),
        "C12": ("SELECT count(*) FROM s WHERE k % 83 = 0", "error"),
        "C13": ("SELECT count(*) FROM (SELECT w.lv, sum(w.a) AS a FROM w JOIN f ON w.lv = f.lv GROUP BY 1) WHERE abs(a - 400) > 4", "warn"),
        "I01": ("SELECT count(*) FROM region WHERE 2 * r_regionkey > 3 OR r_regionkey > 2", "error"),
        "I02": ("SELECT count(*) FROM fs FULL JOIN os ON fs.facade = os.facade WHERE coalesce(o, 0) > coalesce(w, 0) + greatest(coalesce(w, 0) * 0.005, 1e-6)", "error"),
        "I03": ("SELECT count(DISTINCT tag) FROM o WHERE tag = '2-HIGH'", "error"),
        "I04": ("SELECT count(*) FROM part WHERE p_type = 'PROMO'", "warn"),
        "I05": ("SELECT count(*) FROM o WHERE category <> 'skylight' AND tag IN (' ', '5-LOW')", "error"),
        "I06": ("SELECT (SELECT count(*) FROM s WHERE k % 71 = 0) + (SELECT count(*) FROM o WHERE k % 53 = 0)", "error"),
        "I07": ("SELECT count(*) FROM s WHERE k % 30 > 25 OR (k % 30 = 0 AND k IN (SELECT p_partkey FROM part))", "warn"),
        "I08": ("SELECT count(*) FROM s WHERE k % 300 = 7", "error"),
        "I09": ("SELECT count(*) FROM o LEFT JOIN s ON sid = s.id WHERE o.k % 59 = 0 OR (o.k % 67 = 0 AND s.lv IS NOT NULL)", "error"),
        "I10": ("SELECT CASE WHEN sum(CASE WHEN id NOT IN (SELECT id FROM sz) THEN a END) > 0.05 * sum(a) THEN count(*) FILTER (WHERE id NOT IN (SELECT id FROM sz)) ELSE 0 END FROM s", "warn"),
        "I11": ("SELECT CASE WHEN count(*) > 0.01 * max(n) THEN count(*) ELSE 0 END FROM (SELECT (SELECT count(*) FROM o JOIN s ON sid = s.id WHERE lv IS NOT NULL) AS n FROM p a JOIN p b ON a.facade = b.facade AND a.tag = b.tag AND a.category = b.category AND b.r = a.r + 1 AND a.c = b.c)", "warn"),
        "I12": ("SELECT count(*) FROM o WHERE sid IS NULL", "warn"),
        "E01": ("SELECT count(*) FROM s a JOIN s b ON b.k = a.k - 1 WHERE a.k % 6 = 1", "error"),
        "E02": ("SELECT count(*) FROM nation WHERE n_nationkey % 6 = 0 OR 'Z' || n_nationkey NOT IN (SELECT z FROM zs)", "error"),
        "E03": ("SELECT count(*) FROM ((SELECT * FROM zs EXCEPT SELECT * FROM sz) UNION (SELECT * FROM sz EXCEPT SELECT * FROM zs))", "error"),
        "E04": ("SELECT count(*) FROM (SELECT id FROM s WHERE id <> concat_ws('-', lv, number) UNION SELECT min(id) FROM s GROUP BY number HAVING count(*) > 1)", "warn"),
        "E05": ("SELECT count(*) FROM o WHERE abs(CASE WHEN k % 67 = 0 THEN 4.5 ELSE 2.5 END - CASE WHEN k % 59 = 0 THEN -1 ELSE 0.5 END - CASE WHEN k % 53 = 0 THEN 0 ELSE 2 END) > 0.01 OR c > 12 OR k % 53 = 0", "error"),
        "E06": ("SELECT count(*) FROM (SELECT lead(c) OVER (PARTITION BY sid, tag, facade ORDER BY c, k::VARCHAR) - c AS d FROM o WHERE category = 'window') WHERE d < 0.15", "error"),
        "E07": ("SELECT count(*) FROM o WHERE category = 'window' AND tag = ' '", "warn"),
        "E08": ("SELECT (SELECT count(*) FROM s WHERE k % 101 = 0) + (SELECT count(*) FROM part WHERE p_partkey % 19 = 0)", "error"),
        "E09": ("SELECT count(*) FROM orders WHERE o_orderkey % 300 = 1", "error"),
        "E10": ("SELECT count(*) FROM orders WHERE o_orderkey % 200 = 1", "warn"),
        "E11": ("SELECT 1", "error"),
        "X01": ("SELECT 1 + count(*) FILTER (WHERE k % 100 <> 0 AND k % 71 = 0) FROM s", "error"),
        "X02": ("SELECT count(*) FROM orders WHERE o_orderkey % 150 NOT IN (SELECT s_suppkey FROM supplier)", "error"),
        "X03": ("SELECT CASE WHEN abs(sum(CASE WHEN k % 9 = 0 THEN 1 ELSE a END) - sum(a)) > 0.01 * sum(a) THEN 1 ELSE 0 END FROM w", "error"),
        "X04": ("SELECT 2", "error"),
        "A01": ("SELECT count(*) FROM w WHERE u > CASE cons WHEN 'mass' THEN 0.3 ELSE 0.45 END OR cons IS NULL OR cons = 'wood'", "error"),
        "A02": ("SELECT count(*) FROM nation WHERE n_nationkey % 4 / 8.0 > 0.2", "error"),
        "A03": ("SELECT count(*) FROM o WHERE category = 'window' AND k % 9 / 4.0 > 1.5", "error"),
        "A04": ("SELECT count(*) FROM s WHERE k % 30 > CASE WHEN k % 3 = 0 THEN 11 ELSE 20 END", "warn"),
        "A05": ("SELECT count(*) FROM nation WHERE n_nationkey % 3 + 2 < CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 2.5 END", "error"),
        "K01": ("SELECT CASE WHEN abs((SELECT sum(a) FROM s) - sum(f.a)) > 0.03 * sum(f.a) THEN 1 ELSE 0 END FROM f", "error"),
        "K02": ("SELECT CASE WHEN abs((SELECT sum(v) FROM s) - 4 * sum(f.a)) > 0.05 * 4 * sum(f.a) THEN 1 ELSE 0 END FROM f", "error"),
        "K03": ("SELECT count(*) FROM fs LEFT JOIN os ON fs.facade = os.facade WHERE w <= 0 OR coalesce(o, 0) > 1.01 * w", "error"),
        "K04": ("SELECT count(*) FROM region WHERE r_regionkey % 3 = 2", "error"),
    }
    tables += ",\np AS (SELECT o.*, r_regionkey AS r FROM o JOIN s ON sid = s.id JOIN region ON lv = region.r_name)"
    rows = " UNION ALL\n".join(f"SELECT '{check}' AS check_id, '{bad}' AS bad, ({sql}) AS n" for check, (sql, bad) in n.items())
    return f"WITH {tables},\nb AS ({rows})\nSELECT check_id, CASE WHEN n = 0 THEN 'pass' ELSE bad END AS severity, n::BIGINT AS n_bad FROM b"


BATTERY_SQL = _sql()


@query(BATTERY_SQL)
def check_battery(t):
    """All 49 rules over a building made of the tables."""
    return rules.run(model(t), keep=0).select("check_id", "severity", "n_bad")


@query(f"WITH v AS ({BATTERY_SQL}) SELECT count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warn') AS warnings, count(*) FILTER (WHERE severity = 'pass') AS passed, 0::BIGINT AS skipped, count(*) FILTER (WHERE severity = 'error') = 0 AS ok FROM v")
def check_summary(t):
    """The report's counts by severity."""
    return rules.summary(rules.run(model(t), keep=0))


@query(f"WITH v AS ({BATTERY_SQL}), w AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 200 = 1) SELECT (count(*) FILTER (WHERE severity = 'error') = 0 AND max(w.n) = 0) AS may_export, (count(*) FILTER (WHERE severity = 'error' AND check_id[1] IN ('A', 'X')) = 0 AND max(w.n) = 0) AS of_limits FROM v, w")
def gate(t):
    """No export while there are errors or unacknowledged items: by the whole report, and by the limits and exports alone."""
    m = model(t)
    report = rules.run(m, keep=0)
    return rules.gate(report, m.review).crossJoin(rules.gate(report.where("substring(check_id, 1, 1) in ('A', 'X')"), m.review).withColumnRenamed("may_export", "of_limits"))
