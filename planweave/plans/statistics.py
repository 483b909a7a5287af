"""Aggregate and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from planweave.functions import text as T
from planweave.operators import aggregates as A
from planweave.operators import fill as L
from planweave.operators import hvac as H
from planweave.plans.registry import query


def _r(df, *cols, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("""SELECT l_returnflag, round(sum(CASE WHEN l_discount > 0 THEN l_discount * l_extendedprice END) / nullif(sum(CASE WHEN l_discount > 0 THEN l_extendedprice END), 0), 6) AS mean, count(*) FILTER (WHERE l_discount <= 0) AS n_excluded FROM lineitem GROUP BY 1""")
def weighted_u(t):
    """Weighted mean over rows with a positive value and weight; the others are counted."""
    from pyspark.sql import Window

    rows = t.lineitem.select("l_returnflag", "l_discount", "l_extendedprice", F.row_number().over(Window.partitionBy("l_returnflag", "l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_quantity")).alias("k"), "l_orderkey")
    rows = rows.withColumn("id", F.concat_ws("-", "l_orderkey", "k"))
    out = A.weighted_mean(rows, ["l_returnflag"], "l_discount", "l_extendedprice", "id")
    return out.select("l_returnflag", F.round("mean", 6).alias("mean"), F.size("excluded").cast("long").alias("n_excluded"))


@query("""SELECT coalesce(o_orderstatus, 'total') AS o_orderstatus, round(sum(o_totalprice), 2) AS gross, round(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END), 2) AS rentable FROM orders GROUP BY ROLLUP(o_orderstatus)""")
def area_rollup(t):
    """Sums by level and over all."""
    out = A.level_and_total(t.orders, "o_orderstatus", {"gross": F.col("o_totalprice"), "rentable": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0)})
    return _r(out, "gross", "rentable", digits=2)


@query("""SELECT l_partkey, l_returnflag, CASE WHEN count(DISTINCT l_quantity) = 1 THEN max(l_quantity) END AS total, CASE WHEN count(DISTINCT l_quantity) > 1 THEN 'conflict' WHEN count(*) > 1 THEN 'duplicate' END AS issue FROM lineitem GROUP BY 1, 2""")
def slot_totals(t):
    """One stated value is the total, several conflict."""
    return A.slot_totals(t.lineitem, ["l_partkey", "l_returnflag"], "l_quantity")


@query("SELECT event_type, user_id, CASE WHEN count(*) = count(CASE WHEN value > 1 THEN value END) THEN round(sum(value), 4) END AS total FROM events GROUP BY 1, 2")
def null_poison_sum(t):
    """A sum that any unknown part makes unknown."""
    return t.events.groupBy("event_type", "user_id").agg(F.round(A.poisoned_sum(F.when(F.col("value") > 1, F.col("value"))), 4).alias("total"))


@query("SELECT l_orderkey, round(max(l_quantity / s), 6) AS top_share, count(*) AS n FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS s FROM lineitem) GROUP BY 1")
def area_share(t):
    """Each part's share of its whole."""
    boxes = t.lineitem.select(F.col("l_orderkey").alias("unit"), F.col("l_quantity").alias("flow"), F.col("l_partkey").alias("box"))
    units = t.lineitem.select(F.col("l_orderkey").alias("unit")).distinct().withColumn("fan_flow", F.lit(None).cast("double"))
    out = H.box_shares(boxes, units)
    return out.groupBy(F.col("unit").alias("l_orderkey")).agg(F.round(F.max("share"), 6).alias("top_share"), F.count("*").alias("n"))


@query("""WITH d AS (SELECT l_returnflag AS g, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
p AS (SELECT g, v, (sum(w) OVER (PARTITION BY g ORDER BY v ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER (PARTITION BY g) AS p FROM d),
x AS (SELECT *, lag(p) OVER (PARTITION BY g ORDER BY v) AS p0, lag(v) OVER (PARTITION BY g ORDER BY v) AS v0, max(p) OVER (PARTITION BY g) AS p9 FROM p),
q AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS q)
SELECT g, q, round(CASE WHEN p0 < q AND q <= p THEN v0 + (v - v0) * (q - p0) / (p - p0) ELSE v END, 2) AS value FROM x, q
WHERE (p0 < q AND q <= p) OR (p0 IS NULL AND q <= p) OR (p = p9 AND q > p)""")
def weighted_percentile(t):
    """Midpoint percentiles by weight."""
    out = A.weighted_percentiles(t.lineitem.withColumn("g", F.col("l_returnflag")), "l_extendedprice", "l_quantity", [0.05, 0.25, 0.5, 0.75, 0.95], ["g"])
    return _r(out, "value", digits=2)


@query("""SELECT metric, count(x) AS n, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median, round(quantile_cont(x, 0.1), 4) AS p10, round(quantile_cont(x, 0.9), 4) AS p90, min(x) AS min, max(x) AS max
FROM (SELECT 'p_size' AS metric, p_size::DOUBLE AS x FROM part UNION ALL SELECT 'p_retailprice', p_retailprice FROM part) GROUP BY metric""")
def priors(t):
    """Spread of metrics over a dataset."""
    return _r(A.priors(t.part, ["p_size", "p_retailprice"]), "mean", "median", "p10", "p90")


@query("SELECT l_returnflag, least(floor(l_discount * 10 * 5), 4)::INT AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2")
def conf_histogram(t):
    """Confidences in five bins."""
    return A.histogram(t.lineitem, "l_returnflag", F.col("l_discount") * 10)


@query("""SELECT event_type, CASE WHEN bool_or(user_id % 50 = 0) THEN 'error' ELSE 'ok' END AS outcome, count(*) AS attempts, round(sum(value), 1) AS seconds FROM events GROUP BY 1""")
def stage_outcomes(t):
    """One error makes a stage's outcome an error."""
    e = t.events.withColumn("outcome", F.when(F.col("user_id") % 50 == 0, F.lit("error")).otherwise("ok"))
    return A.stage_outcomes(e, "event_type", "outcome", "value", "event_id")


@query("""SELECT lang, source, count(*) AS claims, count(*) FILTER (WHERE quality = 1) AS correct, count(*) FILTER (WHERE quality IS NULL) AS abstained, count(*) FILTER (WHERE toxic = 1) AS unverifiable
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id GROUP BY 1, 2""")
def calibration(t):
    """Claims and how they turned out."""
    j = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left").select("lang", "source", (F.col("quality") == 1).alias("correct"), F.col("quality").isNull().alias("abstained"), (F.col("toxic") == 1).alias("unverifiable"))
    return A.calibration_table(j, ["lang", "source"])


_P_SQL = "(SELECT (n_chars % 101) / 100.0::DOUBLE AS p, quality = 1 AS ok FROM documents JOIN labels ON documents.doc_id = labels.doc_id)"


def _claims(t):
    return t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id").select((F.col("n_chars") % 101 / 100.0).alias("p"), (F.col("quality") == 1).alias("ok"))


@query(f"SELECT ceil(p * 10)::INT AS bin, count(*) AS n, round(avg(p), 6) AS confidence, round(avg(ok::INT), 6) AS accuracy FROM {_P_SQL} WHERE p > 0 GROUP BY 1")
def reliability(t):
    """Accuracy by bin of confidence."""
    return _r(A.reliability(_claims(t), "p", "ok"), "confidence", "accuracy", digits=6)


@query(f"WITH c AS (SELECT * FROM {_P_SQL}), r AS (SELECT count(*) AS n, avg(p) AS c, avg(ok::INT) AS a FROM c WHERE p > 0 GROUP BY ceil(p * 10)) SELECT round(sum(n * abs(a - c)) / (SELECT count(*) FROM c), 6) AS ece FROM r")
def ece(t):
    """Expected calibration error."""
    return _r(A.expected_calibration_error(_claims(t), "p", "ok"), "ece", digits=6)


@query("""WITH x AS (SELECT doc_id, toxic, (doc_id * 37 % 1009) AS s, quality AS hit, sum(quality) OVER (PARTITION BY toxic) AS n FROM labels),
p AS (SELECT *, sum(hit) OVER w / count(*) OVER w AS precision, sum(hit) OVER w / n AS recall FROM x WINDOW w AS (PARTITION BY toxic ORDER BY s DESC, doc_id ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, max(precision) OVER (PARTITION BY toxic ORDER BY s DESC, doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best, recall - coalesce(lag(recall) OVER (PARTITION BY toxic ORDER BY s DESC, doc_id), 0) AS gain FROM p)
SELECT toxic, round(sum(gain * best), 6) AS ap FROM e GROUP BY toxic""")
def average_precision(t):
    """All-point interpolated average precision by class."""
    from pyspark.sql import Window

    rows = t.labels.select("doc_id", "toxic", (F.col("doc_id") * 37 % 1009).alias("s"), (F.col("quality") == 1).alias("hit"), F.sum("quality").over(Window.partitionBy("toxic")).alias("n"))
    return _r(A.average_precision(rows, ["toxic"], "s", "hit", ["doc_id"], "n"), "ap", digits=6)


@query("""WITH t AS (SELECT p_partkey AS k, p_size AS a, p_type AS b FROM part), p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS a, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS b FROM part WHERE p_partkey % 11 <> 0),
j AS (SELECT p.k AS pk, t.k AS tk, p.a AS pa, t.a AS ta, p.b AS pb, t.b AS tb FROM p FULL OUTER JOIN t ON p.k = t.k),
c AS (SELECT count(pk) AS n_pred, count(tk) AS n_truth, count(*) FILTER (WHERE pk = tk) AS matched, count(*) FILTER (WHERE pk = tk AND pa = ta AND pb IS NOT DISTINCT FROM tb) AS exact, count(pa) + count(pb) AS cp, count(ta) + count(tb) AS ct, count(*) FILTER (WHERE pa = ta) + count(*) FILTER (WHERE pb = tb) AS ok FROM j)
SELECT n_pred, n_truth, matched, exact, round(ok / cp, 6) AS precision, round(ok / ct, 6) AS recall, round(2 * (ok / cp) * (ok / ct) / (ok / cp + ok / ct), 6) AS f1 FROM c""")
def schedule_score(t):
    """Predicted schedule rows held against true ones, cell by cell."""
    truth = t.part.select(F.col("p_partkey").alias("k"), F.col("p_size").alias("a"), F.col("p_type").alias("b"))
    pred = truth.where("k % 11 <> 0").select("k", F.when(F.col("k") % 7 == 0, F.col("a") + 1).otherwise(F.col("a")).alias("a"), F.when(F.col("k") % 5 != 0, F.col("b")).alias("b"))
    return _r(A.schedule_score(pred, truth, "k", ["a", "b"]), "precision", "recall", "f1", digits=6)


@query("""SELECT lower(trim(p_name)) AS description, CASE WHEN count(DISTINCT p_type) = 1 THEN min(p_type) END AS kind, count(DISTINCT p_type) > 1 AS conflict FROM part GROUP BY 1""")
def legend_conflicts(t):
    """Legend descriptions with one class are learned, with several conflict."""
    return A.learn_legend(t.part, "p_name", "p_type")


@query("""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM conversations)
SELECT word, count(*) AS n FROM w WHERE len(word) > 2 AND word NOT IN ('the', 'and', 'for', 'was', 'that') GROUP BY 1 ORDER BY n DESC, word LIMIT 10""")
def theme_words(t):
    """The commonest words that aren't stop words."""
    return A.top_words(t.conversations, "text", ["the", "and", "for", "was", "that"], 10)


@query("SELECT upper(trim(o_orderstatus)) AS mark, string_agg(DISTINCT year(o_orderdate)::VARCHAR, ',' ORDER BY year(o_orderdate)::VARCHAR) AS sheets, false AS addendum FROM orders GROUP BY 1")
def revision_index(t):
    """Revision marks and the sheets that bear them."""
    return A.revision_index(t.orders.withColumn("sheet", F.year("o_orderdate")), "o_orderstatus", "sheet")


@query("""SELECT p_partkey, CASE WHEN p_size <= 10 THEN 10 WHEN p_size <= 20 THEN 20 WHEN p_size <= 30 THEN 30 ELSE 40 END AS band FROM part""")
def band_pick(t):
    """The least band that holds a value, the last one above all."""
    bands = t.spark.createDataFrame([(10.0, 10), (20.0, 20), (30.0, 30), (40.0, 40)], "upper double, band int")
    return L.pick_band(t.part.select("p_partkey", "p_size"), bands, "p_size").select("p_partkey", "band")


@query("""SELECT p_partkey, round(CASE WHEN p_size <= 5 THEN 0.11 WHEN p_size <= 13 THEN 0.11 + (p_size - 5) * (0.16 - 0.11) / (13 - 5) WHEN p_size <= 20 THEN 0.16 + (p_size - 13) * (0.17 - 0.16) / (20 - 13) ELSE 0.17 END, 6) AS r FROM part""")
def piecewise_interp(t):
    """Straight lines between breakpoints."""
    return t.part.select("p_partkey", F.round(L.interpolate(F.col("p_size").cast("double"), [(5.0, 0.11), (13.0, 0.16), (20.0, 0.17)]), 6).alias("r"))


@query("""SELECT 'p_size' AS column, count(*) FILTER (WHERE p_size > 25 AND p_type IN ('ECONOMY', 'STANDARD')) AS filled, count(*) FILTER (WHERE p_size <= 25) AS kept, count(*) FILTER (WHERE p_size > 25 AND p_type NOT IN ('ECONOMY', 'STANDARD')) AS unmatched FROM part""")
def fill_defaults(t):
    """Missing values from a table of defaults, none overwritten."""
    rows = t.part.select("p_partkey", "p_type", F.when(F.col("p_size") <= 25, F.col("p_size")).alias("p_size"))
    defaults = t.spark.createDataFrame([("ECONOMY", 1), ("STANDARD", 2)], "p_type string, p_size int")
    return L.fill_missing(rows, defaults, "p_type", ["p_size"])[1]


@query("""SELECT p_type, max(coalesce(l, 9.5)) AS limit_u, bool_and(l IS NOT NULL) AS exact, count(*) AS n FROM part LEFT JOIN (VALUES ('ECONOMY', 1.5::DOUBLE), ('PROMO', 2.5::DOUBLE)) v(k, l) ON p_type = k GROUP BY 1""")
def limit_lookup(t):
    """A limit by class, the loosest where the class is unknown."""
    table = t.spark.createDataFrame([("ECONOMY", 1.5), ("PROMO", 2.5), ("*", 9.5)], "p_type string, limit_u double")
    out = L.lookup_with_fallback(t.part.select("p_type"), table, "p_type", "limit_u", "*")
    return out.groupBy("p_type").agg(F.max("limit_u").alias("limit_u"), F.bool_and("exact").alias("exact"), F.count("*").alias("n"))


@query("""WITH x AS (SELECT c_custkey, nullif(c_acctbal, 0) AS area, CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey * 1000.0::DOUBLE END AS cool, CASE WHEN c_nationkey % 4 <> 0 THEN c_nationkey * 400.0::DOUBLE END AS heat FROM customer)
SELECT CASE WHEN area IS NULL OR area <= 0 THEN 'review' WHEN cool / area >= 5 OR heat / area >= 5 THEN 'conditioned' WHEN cool IS NULL OR heat IS NULL THEN 'review' WHEN heat / area >= 1 THEN 'semiheated' ELSE 'unconditioned' END AS category, count(*) AS n FROM x GROUP BY 1""")
def classify_3vl(t):
    """Spaces by capacity per area, unknown where an unknown part could decide."""
    k = F.col("c_nationkey")
    x = t.customer.select(F.nullif("c_acctbal", F.lit(0.0)).alias("area"), F.when(k % 3 != 0, k * 1000.0).alias("cool"), F.when(k % 4 != 0, k * 400.0).alias("heat"))
    return x.groupBy(L.spaces_by_thresholds(F.col("area"), F.col("cool"), F.col("heat"), 5.0, 5.0, 1.0).alias("category")).agg(F.count("*").alias("n"))


@query("""SELECT n_name AS grp, round(CASE WHEN a > 0 THEN q / a END, 6) AS flow_per_area FROM (SELECT n_name, count(*) AS n_sup, sum(s_acctbal) AS q, sum(s_suppkey) AS a FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)""")
def flow_per_area(t):
    """Air flow per area where zones serve exactly a group's spaces."""
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    members = s.select(F.col("n_name").alias("group"), F.col("s_suppkey").cast("string").alias("space_id"))
    served = s.select(F.col("n_name").alias("zone"), F.col("s_suppkey").cast("string").alias("space_id"))
    flows = s.groupBy(F.col("n_name").alias("zone")).agg(F.sum("s_acctbal").alias("flow"))
    areas = s.select(F.col("s_suppkey").cast("string").alias("space_id"), F.col("s_suppkey").cast("double").alias("area_m2"))
    return H.flow_per_area(members, served, flows, areas).select(F.col("group").alias("grp"), F.round("flow_per_area", 6).alias("flow_per_area"))


@query("""SELECT o_orderpriority AS zone, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) END AS unit, CASE WHEN count(DISTINCT o_orderstatus) > 1 THEN 'several' END AS reason FROM orders GROUP BY 1""")
def one_claim(t):
    """A zone's only claimed unit; several go to review."""
    return H.one_claim(t.orders.select(F.col("o_orderpriority").alias("zone"), F.col("o_orderstatus").alias("unit")), "zone", "unit")


@query("""SELECT l_suppkey AS unit, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS boxes, CASE WHEN count(*) = count(*) FILTER (WHERE l_discount > 0) THEN round(sum(l_quantity), 2) END AS flow FROM lineitem GROUP BY 1""")
def air_loops(t):
    """One loop for each unit; its flow only if every box's is known."""
    boxes = t.lineitem.select(F.col("l_suppkey").alias("unit"), F.col("l_linenumber").cast("string").alias("box"), F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("flow"))
    return _r(H.air_loops(boxes), "flow", digits=2)


@query("""WITH z AS (SELECT n_regionkey AS zone, count(*) * 1000.0::DOUBLE AS cap, sum(n_nationkey + 1) AS a FROM nation GROUP BY 1) SELECT n_nationkey::VARCHAR AS space_id, round(cap * (n_nationkey + 1) / a, 4) AS duty FROM nation JOIN z ON n_regionkey = zone""")
def space_duties(t):
    """A zone's capacity by area over its spaces."""
    bridge = t.nation.select(F.col("n_regionkey").alias("zone"), F.col("n_nationkey").cast("string").alias("space_id"))
    areas = t.nation.select(F.col("n_nationkey").cast("string").alias("space_id"), (F.col("n_nationkey") + 1.0).alias("area_m2"))
    caps = bridge.groupBy("zone").agg((F.count("*") * 1000.0).alias("capacity"))
    return _r(H.space_duties(bridge, areas, caps), "duty")


@query("""WITH n AS (SELECT p_partkey, list_distinct(string_split(upper(p_name), ' ')) AS ws FROM part), p AS (SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(a.ws, b.ws)) / len(list_distinct(list_concat(a.ws, b.ws))) AS j FROM n a JOIN n b ON a.p_partkey <> b.p_partkey WHERE len(list_intersect(a.ws, b.ws)) > 0)
SELECT a, b, round(j, 6) AS j FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY j DESC, b) AS r FROM p) WHERE r <= 3""")
def jaccard_suggest(t):
    """The three names that share most words with each."""
    return A.alike(t.part.select(F.col("p_partkey").alias("id"), T.name_tokens("p_name").alias("words")), 3).select("a", "b", F.round("j", 6).alias("j"))
