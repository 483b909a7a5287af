"""Classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.operators import classify as C
from planweave.plans.registry import query


@query("""WITH x AS (SELECT p_partkey AS id, (['AHU', 'EF', 'P', 'XX'])[p_partkey % 4 + 1] AS tag, (['Air handling unit', 'supply fan', 'pump', 'exhaust fan and pump', 'none'])[p_partkey % 5 + 1] AS txt FROM part),
f AS (SELECT id, CASE tag WHEN 'AHU' THEN 'ahu' WHEN 'EF' THEN 'exhaust_fan' WHEN 'P' THEN 'pump' END AS a, CASE txt WHEN 'Air handling unit' THEN 'ahu' WHEN 'supply fan' THEN 'fan' WHEN 'pump' THEN 'pump' WHEN 'exhaust fan and pump' THEN 'exhaust_fan' END AS b FROM x)
SELECT id, CASE WHEN a = b THEN a WHEN a = 'exhaust_fan' AND b = 'fan' THEN a WHEN a IS NOT NULL AND b IS NOT NULL THEN NULL ELSE coalesce(a, b) END AS family, CASE WHEN a = b THEN 'high' WHEN a = 'exhaust_fan' AND b = 'fan' THEN 'high' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'low' WHEN a IS NULL AND b IS NULL THEN 'none' ELSE 'medium' END AS confidence FROM f""")
def equipment_family(t):
    """A family where tag and text agree."""
    k = F.col("p_partkey")
    tag = F.concat(F.element_at(F.array(*map(F.lit, ("AHU", "EF", "P", "XX"))), (k % 4 + 1).cast("int")), F.lit("-1"))
    text = F.element_at(F.array(*map(F.lit, ("Air handling unit", "supply fan", "pump", "exhaust fan and pump", "none"))), (k % 5 + 1).cast("int"))
    return t.part.select(k.alias("id"), C.equipment_family(tag, text).alias("f")).select("id", "f.*")


@query("""WITH e(keys, value) AS (VALUES (['green'], 1.0), (['blue'], 2.0), (['blue', 'large'], 3.0), (['small'], 2.0), (['steel'], 4.0)), w AS (SELECT p_partkey AS id, list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS ws FROM part),
h AS (SELECT id, keys, value FROM w, e WHERE len(list_intersect(ws, keys)) = len(keys)), k AS (SELECT a.id, a.value FROM h a WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.id = a.id AND len(b.keys) > len(a.keys) AND len(list_intersect(a.keys, b.keys)) = len(a.keys))),
g AS (SELECT id, count(DISTINCT value) AS n, min(value) AS v FROM k GROUP BY 1)
SELECT w.id, CASE WHEN n = 1 THEN v::DOUBLE END AS value, CASE WHEN n IS NULL THEN 'unknown' WHEN n > 1 THEN 'ambiguous' END AS reason FROM w LEFT JOIN g ON w.id = g.id""")
def keyword_lookup(t):
    """The value of entries whose words are all there, the particular over the general."""
    table = t.spark.createDataFrame([(["green"], 1.0), (["blue"], 2.0), (["blue", "large"], 3.0), (["small"], 2.0), (["steel"], 4.0)], "keys array<string>, value double")
    return C.keyword_lookup(t.part.withColumnRenamed("p_partkey", "id"), table, "id", "p_name")


@query("""WITH p AS (SELECT event_id AS id, json_extract_string(props, '$.k') AS k, user_id FROM events), v AS (
SELECT id, 'unknown: k' AS violation FROM p WHERE k IS NOT NULL UNION ALL SELECT id, 'missing: kind' FROM p UNION ALL SELECT id, 'too long: k' FROM p WHERE length(k) > 1) SELECT * FROM v""")
def payload_violations(t):
    """What is wrong with payloads."""
    p = t.events.select(F.col("event_id").alias("id"), "props")
    return C.payload_violations(p, "id", "props", ["kind"], ["kind"], "secret|path", longest=1)


@query("SELECT event_type, count(*) FILTER (WHERE NOT (value / 100 >= 0.95 AND user_id % 4 < 2)) AS n_human, count(*) AS n FROM events GROUP BY 1")
def triage(t):
    """Only what is sure and not urgent resolves itself."""
    s = t.events.select("event_type", (F.col("value") / 100).alias("probability"), (F.col("user_id") % 4).alias("urgency"))
    return C.triage(s).groupBy("event_type").agg(F.count_if("needs_human").alias("n_human"), F.count("*").alias("n"))


@query("""WITH w AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS g, (l_partkey % 4) * 45 AS angle, (l_partkey % 50) / 10.0::DOUBLE AS o, (l_linenumber * 3)::DOUBLE AS lo, l_linenumber * 3 + l_quantity AS hi FROM lineitem),
d AS (SELECT * FROM w WHERE id IN (SELECT id FROM w GROUP BY id HAVING count(*) = 1))
SELECT a.g, a.id AS a, b.id AS b FROM d a JOIN d b ON a.g = b.g AND a.angle = b.angle AND a.id < b.id WHERE abs(a.o - b.o) <= 0.25 AND least(a.hi, b.hi) - greatest(a.lo, b.lo) >= 0.9 * least(a.hi - a.lo, b.hi - b.lo)""")
def linings(t):
    """Parallel walls close together that overlap over most of the shorter; walls whose number is there twice are none."""
    w = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("g"), ((F.col("l_partkey") % 4) * 45).alias("angle"), (F.col("l_partkey") % 50 / 10.0).alias("offset"), (F.col("l_linenumber") * 3).cast("double").alias("lo"), (F.col("l_linenumber") * 3 + F.col("l_quantity")).alias("hi"))
    once = w.groupBy("id").agg(F.count("*").alias("n")).where("n = 1").select("id")
    return C.linings(w.join(once, "id"), ["g"], 0.25)


@query("""SELECT n_nationkey AS grp, CASE WHEN count(DISTINCT s_suppkey % 3) FILTER (WHERE s_suppkey IS NOT NULL) = 1 THEN max(s_suppkey % 3) END AS unit FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1""")
def zone_loops(t):
    """The loop that all zones serving a group name."""
    groups = t.nation.select(F.col("n_nationkey").alias("group"), F.col("n_nationkey").alias("space_id"))
    served = t.supplier.select(F.col("s_nationkey").alias("space_id"), F.col("s_suppkey").alias("zone"))
    loops = t.supplier.select(F.col("s_suppkey").alias("zone"), (F.col("s_suppkey") % 3).alias("unit"))
    return C.zone_loops(groups, served, loops).withColumnRenamed("group", "grp")
