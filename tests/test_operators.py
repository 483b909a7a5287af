import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from planweave.functions.text import normalize_name
from planweave.operators import aggregates as A
from planweave.operators import fill as L
from planweave.operators import hvac as H
from planweave.operators import linking as N
from planweave.operators import ordered as W
from planweave.operators import revisions as R
from planweave.operators import spatial as S
from planweave.operators import takeoff as K
from planweave.operators.components import connected_components
from planweave.plans import catalog


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_components_of_chains_and_hubs(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000), (None, 3)]
    edges += [(random.randrange(2000, 2100), random.randrange(2000, 2100)) for _ in range(90)]
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    want = sorted((n, root(n)) for n in up)
    got = rows(connected_components(spark.createDataFrame(edges, "a long, b long")))
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_takeoff_keeps_every_miss(spark):
    det = spark.createDataFrame([("w 1", "win", 0.9), ("W1", "win", 0.5), ("X9", "win", 0.9), (None, "door", 0.9), (" ", "door", 0.1)], "tag string, label string, tag_score double")
    sch = spark.createDataFrame([("W1", 2.0, 1.5)], "tag string, width_m double, height_m double")
    t = K.rollup(det, sch)
    assert rows(t.lines) == [("W1", 2, 6.0)] and rows(t.unmatched) == [("X9", 1)] and rows(t.untagged) == [("door", 2)] and rows(t.review) == [("W1", "win", 0.5)]


def test_unknown_is_not_zero(spark):
    f = spark.createDataFrame([("a", 10.0), ("a", None), ("b", 5.0)], "space_id string, watts double")
    s = spark.createDataFrame([("a", 10.0), ("b", 0.0), ("c", 4.0)], "space_id string, area_m2 double")
    assert rows(K.lighting_density(f, s)) == [("a", 2, 1, None, None), ("b", 1, 0, 5.0, None), ("c", 0, 0, 0.0, 0.0)]
    assert A.poisoned_sum("watts") is not None
    assert rows(f.groupBy("space_id").agg(A.poisoned_sum("watts"))) == [("a", None), ("b", 5.0)]


def test_slot_totals(spark):
    d = spark.createDataFrame([("a", "cfm", 1.0), ("b", "cfm", 1.0), ("b", "cfm", 1.0), ("c", "cfm", 1.0), ("c", "cfm", 2.0), ("d", "cfm", None)], "k string, u string, v double")
    assert rows(A.slot_totals(d, ["k", "u"], "v")) == [("a", "cfm", 1.0, None), ("b", "cfm", 1.0, "duplicate"), ("c", "cfm", None, "conflict"), ("d", "cfm", None, "unresolved")]


def test_guard_and_greedy(spark):
    d = spark.createDataFrame([("g", 1, 10.0), ("g", 2, 9.9), ("h", 1, 10.0), ("h", 2, 5.0)], "k string, id int, s double")
    assert rows(W.guarded_best(d, ["k"], "s", "id", 0.5)) == [("g", None, 10.0, "tie"), ("h", 1, 10.0, None)]
    random.seed(2)
    pairs = list({(random.randrange(12), random.randrange(12)): random.randrange(6) for _ in range(60)}.items())
    pairs = [(a, b, s) for (a, b), s in pairs]
    left, right, want = set(), set(), []
    for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in left and b not in right:
            left.add(a), right.add(b), want.append((a, b, s))
    assert rows(W.best_pairs(spark.createDataFrame(pairs, "a int, b int, s int"), "a", "b", "s")) == sorted(want)


def greedy(pairs):
    left, right, out = set(), set(), []
    for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in left and b not in right:
            left.add(a), right.add(b), out.append((a, b, s))
    return sorted(out)


def test_greedy_settles_tied_blocks(spark):
    """More ties than any fixed number of rounds would settle one by one; blocks with a stray pair are not whole."""
    block = [(a, b, 3) for a in range(70) for b in range(60)]
    stray = [(100 + a, 100 + b, 2) for a in range(4) for b in range(4)] + [(103, 110, 2), (102, 103, 5), (104, 100, 2)]
    # As many pairs as a whole block, with the same first partners, which others take: no block.
    crossed = [(300, 399, 9), (398, 300, 9)] + [p for i in range(1, 5) for p in ((300 + i, 300, 4), (300, 300 + i, 4), (300 + i, 305 - i, 4))]
    pairs = block + stray + crossed + [(69, 200, 1), (5, 201, 1)]
    got = rows(W.best_pairs(spark.createDataFrame(pairs + [(None, 1, 9), (None, None, 9)], "a int, b int, s int"), "a", "b", "s"))
    assert got == greedy(pairs)


def test_greedy_goes_on_until_no_pair_is_left(spark):
    """Each pair of the chain waits for the one before it."""
    chain = [(i, i + d, 1) for i in range(52) for d in (-1, 0)][1:]
    assert rows(W.best_pairs(spark.createDataFrame(chain, "a int, b int, s int"), "a", "b", "s")) == greedy(chain)


def test_apportion_is_exact(spark):
    d = spark.createDataFrame([("f", i, float(w)) for i, w in enumerate([3, 3, 3, 1])], "k string, i int, w double")
    got = W.apportion(d, ["k"], "w", F.lit(7), ["i"])
    assert [r["units"] for r in got.orderBy("i").collect()] == [2, 2, 2, 1] and got.agg(F.sum("units")).first()[0] == 7


def test_intervals(spark):
    seg = spark.createDataFrame([("A", 0.0, 4.0), ("B", 4.0, 10.0)], "seg string, s0 double, s1 double")
    q = spark.createDataFrame([(1, 1.0, 3.0), (2, 3.0, 5.0), (3, 20.0, 21.0), (4, 2.0, 2.0)], "id int, s0 double, s1 double")
    assert rows(S.match_intervals(q, seg, "id", "seg", 5.0)) == [(1, "A", 1.0, False), (2, "A", 0.5, True), (3, None, 0.0, True), (4, None, 0.0, True)]


def test_labels_fall_back_to_the_nearest(spark):
    rooms = spark.createDataFrame([("big", [[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0]]), ("small", [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0]])], "room string, polygon array<array<double>>")
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 10.0, 5.0), (4, 50.0, 50.0), (5, None, None)], "id int, x double, y double")
    got = {r["id"]: (r["room"], round(r["confidence"], 3)) for r in S.label_spaces(rooms, pts, "room", "id", 3.0).collect()}
    assert got == {1: ("small", 1.0), 2: ("big", 1.0), 3: ("big", 0.6), 4: (None, 0.0), 5: (None, 0.0)}


def test_adjudication(spark):
    c = spark.createDataFrame([(1, "B", 0.1, "grid"), (1, "A", 0.05, "geometric"), (2, "C", 0.1, "grid")], "id int, tag string, distance double, method string")
    assert rows(S.adjudicate(c, "id")) == [(1, "A"), (2, "C")]
    assert rows(S.adjudicate(c, "id", preferred="grid")) == [(1, "B"), (2, "C")]
    assert rows(S.adjudicate(c, "id", "keep_both")) == [(1, "A,B"), (2, "C")]


def test_weighted_percentiles_flat_outside(spark):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 2.0)], "v double, w double")
    got = {r.q: r.value for r in A.weighted_percentiles(d, "v", "w", [0.0, 0.125, 0.375, 0.5, 1.0]).collect()}
    assert got[0.0] == 1.0 and got[0.125] == 1.0 and got[0.375] == 2.0 and math.isclose(got[0.5], 2 + 1 / 3) and got[1.0] == 3.0


def test_ap_and_calibration_edges(spark):
    d = spark.createDataFrame([("a", 0.9, False, 1, 2), ("b", 0.9, True, 1, 0)], "k string, c double, hit boolean, id int, n int")
    assert dict(rows(A.average_precision(d, ["k"], "c", "hit", ["id"], "n"))) == {"a": 0.0, "b": None}
    p = spark.createDataFrame([(0.0, True), (0.1, True), (0.11, False)], "p double, ok boolean")
    assert [r[0] for r in rows(A.reliability(p, "p", "ok"))] == [1, 2]


def test_decisions_are_all_or_nothing(spark):
    items = spark.createDataFrame([("a", "open", None), ("b", "open", None)], "id string, status string, resolution string")
    good = spark.createDataFrame([("a", "confirm", None, 1), ("a", "revert", None, 2), ("b", "edit", "x", 3)], "id string, action string, value string, seq int")
    assert rows(R.apply_decisions(items, good, "id", ["seq"])) == [("a", "open", None), ("b", "edit", "x")]
    with pytest.raises(ValueError):
        R.apply_decisions(items, good.union(spark.createDataFrame([("zz", "confirm", None, 4)], good.schema)), "id", ["seq"])


def test_reidentify_prefers_names(spark):
    s = "id string, level string, name string, area double"
    old = spark.createDataFrame([("o1", "L1", "Office 1", 20.0), ("o2", "L1", "Store room", 10.0), ("o3", "L2", "Office 1", 20.0)], s)
    new = spark.createDataFrame([("n1", "L1", "OFFICE  1", 20.1), ("n2", "L1", "store", 10.05), ("n3", "L2", "lab", 20.0)], s)
    assert [(a, b, round(c, 2)) for a, b, c in rows(R.reidentify(old, new, "id", "level", "name", "area"))] == [("o1", "n1", 3.0), ("o2", "n2", 2.5)]


def test_fill_never_overwrites(spark):
    d = spark.createDataFrame([("x", 1.0), ("x", None), ("y", None)], "k string, v double")
    out, counts = L.fill_missing(d, spark.createDataFrame([("x", 9.0)], "k string, v double"), "k", ["v"])
    assert rows(out.select("k", F.coalesce("v", F.lit(-1.0)), F.size("filled"))) == [("x", 1.0, 0), ("x", 9.0, 1), ("y", -1.0, 0)]
    assert rows(counts) == [("v", 1, 1, 1)]


def test_box_shares(spark):
    b = spark.createDataFrame([("u1", "a", 40.0), ("u1", "b", 60.0), ("u2", "c", None), ("u3", "d", 5.0), ("u4", "e", 30.0)], "unit string, box string, flow double")
    u = spark.createDataFrame([("u1", None), ("u2", 10.0), ("u4", 20.0)], "unit string, fan_flow double")
    got = {r.box: (r.share, r.reason) for r in H.box_shares(b, u).collect()}
    assert got == {"a": (0.4, None), "b": (0.6, None), "c": (None, "no flow"), "d": (None, "no unit"), "e": (None, "over one")}


def test_gaps_count_parts_of_seconds(spark, tmp_path):
    at = lambda *s: F.to_timestamp_ntz(F.lit("2024-01-01 " + s[0]))
    rows_ = [(1, 1, "00:00:00.900000"), (1, 2, "06:00:00.100000"), (2, 3, "00:00:00.100000"), (2, 4, "06:00:00.900000"), (3, 5, "00:00:00.500000"), (3, 6, "06:00:00.500000")]
    d = None
    for user, event, clock in rows_:
        r = spark.range(1).select(F.lit(user).cast("long").alias("user_id"), F.lit(event).cast("long").alias("event_id"), at(clock).alias("ts"))
        d = r if d is None else d.unionByName(r)
    d.write.parquet(str(tmp_path / "events.parquet"))
    got = rows(catalog.QUERIES["gaps_islands"](spark, str(tmp_path)))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(con.execute(catalog.ORACLE["gaps_islands"]).fetchall())
    assert [r[:2] for r in got][:2] == [(1, 1), (2, 2)]


def test_intervals_without_an_end_come_last(spark):
    # At one start the open end sorts behind, as SQL has it, and starts nothing of its own.
    d = spark.createDataFrame([("a", 3.0, None), ("a", 3.0, 4.0), ("a", 3.0, 4.0), ("b", 1.0, None), ("b", 2.0, 5.0), ("c", None, 1.0), ("c", 3.0, 4.0)], "k string, lo double, hi double")
    got = sorted((tuple(r) for r in W.merged_intervals(d, ["k"], "lo", "hi", 1.0).collect()), key=str)
    assert got == [("a", 3.0, 4.0, 3), ("b", 1.0, None, 1), ("b", 2.0, 5.0, 1), ("c", 3.0, 4.0, 2)]


def broadcasts(df):
    """The sides that a plan broadcasts, before it runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_items_are_not_broadcast_to_a_schedule(spark, tmp_path, monkeypatch):
    random.seed(3)
    items = [(i, random.random() * 9, random.random() * 9) for i in range(200)]
    sizes = [(f"T{i}", random.random() * 9 - 1, random.random() * 9) for i in range(30)]
    spark.createDataFrame(items, "id long, width_m double, height_m double").write.parquet(str(tmp_path / "items"))
    i, s = spark.read.parquet(str(tmp_path / "items")), spark.createDataFrame(sizes, "tag string, width_m double, height_m double")
    want = sorted((a, t, n + 1) for a, w, h in items for n, (d, t) in enumerate(sorted((math.hypot(w - sw, h - sh), t) for t, sw, sh in sizes if math.hypot(w - sw, h - sh) <= 1.0)))
    small = S.size_candidates(i, s, "id", 1.0)
    # One broadcast: the schedule, though its size is not known to Spark and the items' file is small.
    assert broadcasts(small) == 1 and "BuildRight" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small.select("id", "tag", "rank")) == want
    monkeypatch.setattr(S, "SMALL_SCHEDULE", 5)
    large = S.size_candidates(i, s, "id", 1.0)
    assert broadcasts(large) == 0 and rows(large.select("id", "tag", "rank")) == want


def test_adjudicated_items_are_not_broadcast(spark, data):
    plan = catalog.QUERIES["adjudicated_tags"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and plan.count("BuildRight") == 2


def test_titles_are_not_broadcast(spark, tmp_path):
    random.seed(5)
    word = lambda: "".join(random.choice("abc ") for _ in range(random.randrange(0, 9))).strip()
    a, b = [(i, i % 3, f"plan {word()}" if i % 9 else word()) for i in range(90)], [(i, i % 3 if i % 7 else 0, f"plan {word()}" if i % 9 else word()) for i in range(70)]
    for name, t in (("a", a), ("b", b)):
        spark.createDataFrame(t, "id long, g int, title string").write.parquet(str(tmp_path / name))
    x, y = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    got = [N.title_matches(x, y, ["g"], least=0.7, few=few) for few in (1000, 25, 0)]
    assert [broadcasts(t) for t in got] == [0, 0, 0]
    pairs = x.alias("a").join(y.alias("b"), F.col("a.g") == F.col("b.g")).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), normalize_name("a.title").alias("x"), normalize_name("b.title").alias("y"))
    ratio = 1 - F.levenshtein("x", "y") / F.greatest(F.length("x"), F.length("y"), F.lit(1))
    want = rows(pairs.withColumn("r", ratio).where("r >= 0.7").groupBy("a_id").agg(F.min(F.struct(-F.col("r"), "b_id")).alias("m")).select("a_id", "m.b_id"))
    assert len(want) > 20 and all(rows(t.select("a_id", "b_id")) == want for t in got)
