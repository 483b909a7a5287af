"""Takeoff, schedule and envelope queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.functions import text as T
from planweave.operators import aggregates as A
from planweave.operators import takeoff as K
from planweave.plans.registry import query

# A schedule of part brands: the last part of a brand gives its size.
_SCHEDULE_SQL = """
s AS (
  SELECT tag, width_m, height_m FROM (
    SELECT upper(replace(p_brand, ' ', '')) AS tag, p_size / 10.0::DOUBLE AS width_m, 2.0::DOUBLE AS height_m,
           row_number() OVER (PARTITION BY upper(replace(p_brand, ' ', '')) ORDER BY p_partkey DESC) AS r
    FROM part) WHERE r = 1
)"""


def _schedule(t):
    rows = t.part.select(T.normalize_tag("p_brand").alias("tag"), (F.col("p_size") / 10.0).alias("width_m"), F.lit(2.0).alias("height_m"), "p_partkey")
    return K.last_wins(rows, ["tag"], [F.col("p_partkey")]).drop("p_partkey")


def _detections(t):
    return t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).when(F.col("l_linenumber") == 6, F.concat(F.lit("x"), "p_brand")).otherwise(F.lower("p_brand")).alias("tag"), F.col("l_returnflag").alias("label"), F.col("l_discount").alias("tag_score"), "l_orderkey"
    )


_DETECTIONS_SQL = """
d AS (
  SELECT CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN 'X' || upper(replace(p_brand, ' ', '')) ELSE upper(replace(p_brand, ' ', '')) END AS tag, l_returnflag AS label, l_discount AS tag_score
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


@query(f"WITH {_SCHEDULE_SQL}, {_DETECTIONS_SQL} SELECT d.tag, count(*) AS count, round(count(*) * any_value(s.width_m) * any_value(s.height_m), 3) AS area_m2 FROM d JOIN s ON d.tag = s.tag GROUP BY d.tag")
def takeoff_rollup(t):
    """Count x width x height by tag."""
    return K.rollup(_detections(t), _schedule(t)).lines


@query(f"WITH {_SCHEDULE_SQL}, {_DETECTIONS_SQL} SELECT d.tag, count(*) AS count FROM d LEFT JOIN s ON d.tag = s.tag WHERE s.tag IS NULL AND d.tag <> '' GROUP BY d.tag")
def takeoff_unmatched(t):
    """Tags that the schedule lacks."""
    return K.rollup(_detections(t), _schedule(t)).unmatched


@query(f"WITH {_DETECTIONS_SQL} SELECT label, count(*) AS count FROM d WHERE tag = '' GROUP BY label")
def takeoff_untagged(t):
    """Detections without a tag, by label."""
    return K.rollup(_detections(t), _schedule(t)).untagged


@query(f"WITH {_DETECTIONS_SQL} SELECT label, count(*) AS n FROM d WHERE tag <> '' AND tag_score < 0.05 GROUP BY label")
def takeoff_review(t):
    """Weakly read tags, by label."""
    return K.rollup(_detections(t), _schedule(t), review_below=0.05).review.groupBy("label").agg(F.count("*").alias("n"))


@query("""SELECT s_suppkey AS space_id, coalesce(n, 0) AS n_fixtures, 0::BIGINT AS n_unknown, round(coalesce(w, 0.0), 2) AS total_w, round(coalesce(w, 0.0) / nullif(a, 0.0), 4) AS lpd_w_m2
FROM (SELECT s_suppkey, abs(s_acctbal) AS a FROM supplier) s LEFT JOIN (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS w FROM lineitem GROUP BY l_suppkey) l ON s_suppkey = l_suppkey""")
def lighting_lpd(t):
    """Watts and watts per square metre of every space."""
    fixtures = t.lineitem.select(F.col("l_suppkey").alias("space_id"), F.col("l_quantity").alias("watts"))
    spaces = t.supplier.select(F.col("s_suppkey").alias("space_id"), F.abs("s_acctbal").alias("area_m2"))
    return K.lighting_density(fixtures, spaces).select("space_id", "n_fixtures", "n_unknown", F.round("total_w", 2).alias("total_w"), F.round("lpd_w_m2", 4).alias("lpd_w_m2"))


@query("SELECT p_type AS category, count(*) AS count, sum(p_size * p_size)::DOUBLE AS area_px2, round(sum(p_size * p_size)::DOUBLE * 0.05 * 0.05, 4) AS area_m2 FROM part GROUP BY p_type")
def measure_by_category(t):
    """Regions and their area by category, scaled."""
    regions = t.part.select(F.col("p_type").alias("category"), (F.col("p_size") * F.col("p_size")).cast("double").alias("area_px2"))
    return K.measure(regions, "category", "area_px2", F.lit(0.05)).withColumn("area_m2", F.round("area_m2", 4))


@query("SELECT round(0.9 / median(p_size), 6) AS m_per_px FROM part")
def scale_reference(t):
    """Metres per pixel from things of known width."""
    return K.scale_from_reference(t.part, "p_size", 0.9).select(F.round("m_per_px", 6).alias("m_per_px"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def schedule_last_wins(t):
    """The last row of each key."""
    return K.last_wins(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""WITH r AS (SELECT *, row_number() OVER w AS r, first_value(o_orderpriority) OVER w AS f FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderpriority, count(*) FILTER (WHERE r = 1) AS kept, count(*) FILTER (WHERE r > 1 AND o_orderpriority IS DISTINCT FROM f) AS conflicts FROM r GROUP BY o_orderpriority""")
def schedule_first_wins(t):
    """The first sheet's value stands; later ones that differ are conflicts."""
    kept, conflicts = K.first_wins(t.orders.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [F.col("o_orderkey")], ["o_orderpriority"])
    both = kept.select("o_orderpriority", F.lit(1).alias("k")).unionByName(conflicts.select("o_orderpriority", F.lit(0).alias("k")))
    return both.groupBy("o_orderpriority").agg(F.count_if(F.col("k") == 1).alias("kept"), F.count_if(F.col("k") == 0).alias("conflicts"))


@query("SELECT upper(regexp_replace(p_brand, '\\s+', '', 'g')) AS tag, count(*) AS n FROM part GROUP BY 1")
def tag_normalise(t):
    return t.part.groupBy(T.normalize_tag("p_brand").alias("tag")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT upper(regexp_replace(trim(p_name), '\\s+', ' ', 'g')) AS name, len(list_distinct(string_split(upper(regexp_replace(trim(p_name), '\\s+', ' ', 'g')), ' '))) AS n_tokens FROM part")
def name_tokens(t):
    return t.part.select(T.normalize_name("p_name").alias("name"), F.size(T.name_tokens("p_name")).cast("long").alias("n_tokens")).distinct()


@query("""WITH w AS (SELECT o_orderpriority AS g, sum(o_totalprice) AS wall_area, count(*) AS n_walls, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS facades FROM orders GROUP BY 1),
o AS (SELECT o_orderpriority AS g, sum(l_extendedprice) AS window_area, count(*) AS n_windows FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1)
SELECT w.g, round(wall_area, 2) AS wall_area, n_walls, facades, round(coalesce(window_area, 0), 2) AS window_area, coalesce(n_windows, 0) AS n_windows, round(CASE WHEN wall_area > 0 THEN coalesce(window_area, 0) / wall_area ELSE 0 END, 6) AS wwr FROM w LEFT JOIN o ON w.g = o.g""")
def envelope_summary(t):
    """Wall and window areas, counts, ratio and facades by group."""
    walls = t.orders.select(F.col("o_orderpriority").alias("g"), F.col("o_totalprice").alias("area_m2"), F.lit(None).cast("double").alias("length_m"), F.lit(None).cast("double").alias("height_m"), F.col("o_orderstatus").alias("facade"))
    openings = t.lineitem.join(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("g")), F.col("l_orderkey") == F.col("o_orderkey")).select("g", F.when(F.col("l_returnflag") == "R", F.lit("window")).otherwise("door").alias("category"), F.col("l_extendedprice").alias("area_m2"))
    out = A.envelope_summary(walls, openings, "g")
    return out.withColumns({"wall_area": F.round("wall_area", 2), "window_area": F.round("window_area", 2), "wwr": F.round("wwr", 6)})


@query("""SELECT coalesce(a.y, b.y) AS y, coalesce(na, 0) AS n_a, coalesce(nb, 0) AS n_b, coalesce(nb, 0) - coalesce(na, 0) AS delta
FROM (SELECT year(l_shipdate)::INT AS y, count(*) AS na FROM lineitem GROUP BY 1) a FULL OUTER JOIN (SELECT year(o_orderdate)::INT AS y, count(*) AS nb FROM orders GROUP BY 1) b ON a.y = b.y WHERE coalesce(nb, 0) <> coalesce(na, 0)""")
def reconcile_counts(t):
    """Counts of two tables that differ."""
    a = t.lineitem.groupBy(F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"))
    b = t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return K.reconcile_counts(a, b, "y")


@query("SELECT o_orderkey, 'RVW-' || CASE WHEN r < 1000 THEN lpad(r::VARCHAR, 3, '0') ELSE r::VARCHAR END AS review_id FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders WHERE o_totalprice < 5000)")
def review_queue(t):
    """Rows under the bar, numbered."""
    return K.review_queue(t.orders, "o_totalprice", ["o_orderkey"], below=5000.0).select("o_orderkey", "review_id")


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END, o_orderpriority DESC, o_totalprice, o_orderkey LIMIT 15")
def worst_first(t):
    """The fifteen items to look at first."""
    items = t.orders.select(F.when(F.col("o_orderstatus") == "O", F.lit("open")).otherwise("done").alias("status"), F.col("o_orderpriority").alias("urgency"), F.col("o_totalprice").alias("confidence"), F.col("o_orderkey").alias("id"))
    return items.orderBy(*K.worst_first(items)).limit(15).select(F.col("id").alias("o_orderkey"), F.col("urgency").alias("o_orderpriority"))
