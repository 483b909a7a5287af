"""Checks, questions, streams and the n-tuple classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.checks import rules
from planweave.operators import tuples as N
from planweave.plans.registry import query
from planweave.streaming import events as E


@query("""WITH s AS (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) SELECT o_orderkey, CASE WHEN o_totalprice = 0 THEN 'inf' WHEN abs(s - o_totalprice) / o_totalprice > 0.5 THEN 'error' WHEN abs(s - o_totalprice) / o_totalprice > 0.03 THEN 'warn' ELSE 'pass' END AS severity FROM orders JOIN s ON o_orderkey = l_orderkey""")
def check_conservation(t):
    """Parts against their stated whole, by relative error."""
    s = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s"))
    e = rules.relative_error(F.col("s"), F.col("o_totalprice"))
    j = t.orders.join(s, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("o_orderkey", F.when(e == float("inf"), "inf").when(e > 0.5, "error").when(e > 0.03, "warn").otherwise("pass").alias("severity"))


@query("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_daily_counts(t):
    """Counts by day from a stream of event files."""
    stream = E.parquet_stream(t.spark, t.folder, "events")
    out = E.collect_stream(E.window_counts(stream, "ts", ["event_type"], "1 day", sums={"total": "value"}), "daily", "complete")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT event_type, least(floor(value / 100 * 5), 4)::INT AS bin, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_histogram(t):
    """A running histogram over a stream."""
    stream = E.parquet_stream(t.spark, t.folder, "events")
    return E.collect_stream(E.histogram(stream, "event_type", F.col("value") / 100), "bins", "complete")


@query("""SELECT user_id, CASE WHEN event_type <> 'purchase' THEN event_type END AS state, event_id AS seq FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""")
def stream_decisions(t):
    """The last decision on each item, kept as state over a stream."""
    stream = E.parquet_stream(t.spark, t.folder, "events").withColumn("action", F.when(F.col("event_type") == "purchase", F.lit("revert")).otherwise(F.col("event_type")))
    told = E.collect_stream(E.last_decisions(stream, "user_id", "action", "event_id"), "last", "update")
    return told.groupBy("user_id").agg(F.max_by("state", "seq").alias("state"), F.max("seq").alias("seq"))


_BITS_SQL = """b AS (SELECT vec_id, label, i // 8 AS k, sum(CASE WHEN embedding[i + 1] > 0 THEN 1 << (7 - i % 8) ELSE 0 END) AS address FROM embeddings, unnest(range(0, 64)) AS t(i) GROUP BY 1, 2, 3)"""


def _bits(t):
    rows = t.embeddings.withColumn("bits", N.thermometer(F.col("embedding"), [0.0]))
    return N.addresses(rows, "vec_id", "bits", 8, ["label"])


@query(f"WITH {_BITS_SQL} SELECT label, k::INT AS k, address::INT AS address, count(*) AS n FROM b WHERE vec_id % 2 = 0 GROUP BY 1, 2, 3")
def wisard_fit(t):
    """Counts by class, tuple and address."""
    return N.fit(_bits(t).where("vec_id % 2 = 0"), "label")


@query(f"""WITH {_BITS_SQL}, m AS (SELECT label, k, address FROM b WHERE vec_id % 2 = 0 GROUP BY 1, 2, 3), h AS (SELECT b.vec_id, m.label, count(*) AS score FROM b JOIN m ON b.k = m.k AND b.address = m.address WHERE b.vec_id % 2 = 1 GROUP BY 1, 2)
SELECT vec_id, label, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS r FROM h) WHERE r = 1""")
def wisard_predict(t):
    """The class whose tuples have seen most of a vector's addresses."""
    b = _bits(t)
    return N.predict(b.where("vec_id % 2 = 1").drop("label"), N.fit(b.where("vec_id % 2 = 0"), "label"), "vec_id", "label")
