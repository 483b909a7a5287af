"""Revision, history and dedup queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from planweave.operators import revisions as R
from planweave.operators.components import connected_components
from planweave.plans.registry import query

# The second revision: every 11th order gone, every 7th dearer, every 5th with another status, some new.
_REVISION_SQL = """
o AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 13 <> 0),
n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 10 ELSE o_totalprice END AS p, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 11 <> 0),
c AS (SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'removed' ELSE coalesce(nullif(concat_ws('+', CASE WHEN sha1(printf('%.2f', o.p)) <> sha1(printf('%.2f', n.p)) THEN 'geometry' END, CASE WHEN sha1(o.s) <> sha1(n.s) THEN 'schedule' END), ''), 'identical') END AS change FROM o FULL OUTER JOIN n ON o.k = n.k)"""


def _revisions(t):
    k = F.col("o_orderkey")
    old = t.orders.where(k % 13 != 0).select(k.alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    new = t.orders.where(k % 11 != 0).select(k.alias("k"), F.when(k % 7 == 0, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")).alias("p"), F.when(k % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("s"))
    return R.diff(old, new, "k", {"geometry": [R.number("p")], "schedule": [F.col("s")]})


@query(f"WITH {_REVISION_SQL} SELECT k, change FROM c")
def hash_diff(t):
    """New, removed, changed and identical rows of two revisions, by fingerprints."""
    return _revisions(t)


@query(f"WITH {_REVISION_SQL} SELECT change, count(*) AS n FROM c GROUP BY 1")
def takeoff_diff_summary(t):
    """Changes counted by kind."""
    return R.change_counts(_revisions(t))


@query("""WITH b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS v FROM part), a AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'OTHER' ELSE p_type END AS v FROM part)
SELECT count(*) FILTER (WHERE b.v IS NOT NULL AND a.v IS NULL) AS lost, count(*) FILTER (WHERE b.v <> a.v) AS flipped, count(*) FILTER (WHERE b.v IS NULL AND a.v IS NOT NULL) AS gained, count(*) FILTER (WHERE b.v = a.v) AS same FROM b FULL OUTER JOIN a ON a.k = b.k""")
def before_after(t):
    """How a mapping changed between two runs."""
    k = F.col("p_partkey")
    before = t.part.select(k.alias("k"), F.when(k % 3 != 0, F.col("p_type")).alias("v"))
    after = t.part.select(k.alias("k"), F.when(k % 4 == 0, F.lit(None)).when(k % 5 == 0, F.lit("OTHER")).otherwise(F.col("p_type")).alias("v"))
    return R.before_after(before, after, "k", "v")


@query("""SELECT c_custkey AS old_id, c_custkey + 1000000000 AS new_id, CASE WHEN c_custkey % 5 = 0 THEN 2.5 ELSE 3.0 END::DOUBLE AS score FROM customer WHERE c_custkey % 7 <> 0""")
def reidentify(t):
    """Rooms that got new ids found again by level, area and name."""
    k, area = F.col("c_custkey"), F.abs("c_acctbal") + 100
    old = t.customer.select(k.alias("id"), F.col("c_nationkey").alias("level"), F.col("c_name").alias("name"), area.alias("area"))
    new = t.customer.select((k + 1000000000).alias("id"), F.col("c_nationkey").alias("level"), F.concat(F.when(k % 5 == 0, "Room ").otherwise(""), F.lower("c_name")).alias("name"), (area * F.when(k % 7 == 0, 1.02).otherwise(1.005)).alias("area"))
    return R.reidentify(old, new, "id", "level", "name", "area")


@query("""SELECT user_id, CASE WHEN event_type <> 'purchase' THEN event_type END AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def decisions_replay(t):
    """The last decision on each item; one kind takes it back."""
    d = t.events.withColumn("action", F.when(F.col("event_type") == "purchase", F.lit("revert")).otherwise(F.col("event_type")))
    return R.final_states(d, "user_id", "action", ["ts", "event_id"])


@query("""SELECT o_custkey, o_orderkey, o_orderdate AS valid_from, lead(o_orderdate) OVER w AS valid_to, lead(1) OVER w IS NULL AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def scd2_history(t):
    """Every state with the span in which it held."""
    return R.history(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate").select("o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current")


@query("""WITH c AS (SELECT user_id, event_id, event_id % 3 = 0 AS undone FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, undone ORDER BY event_id DESC) AS r FROM c)
SELECT user_id, count(*) FILTER (WHERE undone) AS was_undone, count(*) FILTER (WHERE undone OR r <= 2) AS undone FROM r GROUP BY 1""")
def undo_last_n(t):
    """The last two corrections of each user that still hold are undone."""
    c = t.events.select("user_id", "event_id", (F.col("event_id") % 3 == 0).alias("undone"), (F.col("event_id") % 3 == 0).alias("was"))
    return R.undo_last(c, ["user_id"], ["event_id"], 2).groupBy("user_id").agg(F.count_if("was").alias("was_undone"), F.count_if("undone").alias("undone"))


@query("""SELECT user_id, min_by(event_type, event_id) AS value FROM events WHERE event_id % 4 <> 0 GROUP BY 1""")
def revert_to_automatic(t):
    """What the earliest correction that still holds replaced."""
    c = t.events.select("user_id", "event_id", F.col("event_type").alias("before"), (F.col("event_id") % 4 == 0).alias("undone"))
    return R.automatic_values(c, ["user_id"], "event_id")


@query("SELECT o_orderkey AS id, count(*) AS n FROM orders GROUP BY 1")
def idempotent_append(t):
    """Appending the same items twice changes nothing."""
    have = t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    more = t.orders.select(F.col("o_orderkey").alias("id"))
    return R.append_new(R.append_new(have, more, "id"), more, "id").groupBy("id").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE s AS (SELECT o_orderkey AS id, o_custkey, o_orderdate::DATE - DATE '1992-01-01' AS d FROM orders), e AS (SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.o_custkey = b.o_custkey AND a.id <> b.id AND abs(a.d - b.d) <= 30),
c(a, b) AS (SELECT id, id FROM s UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a) SELECT a AS id, min(b) AS cluster FROM c GROUP BY 1""")
def dedupe_components(t):
    """Near observations of one blocking key form clusters, chained; the least id stands for each."""
    d = F.datediff("o_orderdate", F.lit("1992-01-01"))
    s = t.orders.select(F.col("o_orderkey").alias("id"), "o_custkey", d.alias("d"))
    # Links along the order of a key's dates are enough to connect them.
    w = Window.partitionBy("o_custkey").orderBy("d", "id")
    links = s.withColumn("p", F.lag("id").over(w)).withColumn("pd", F.lag("d").over(w)).where("d - pd <= 30").select(F.col("id").alias("a"), F.col("p").alias("b"))
    return s.select("id").join(connected_components(links).withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))
