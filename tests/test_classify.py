import pytest

from planweave.operators import adjacency as J
from planweave.operators import classify as C
from planweave.operators import linking as N
from planweave.sources import providers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


RING = lambda x, y, w=4.0, h=3.0: [[x, y], [x + w, y], [x + w, y + h], [x, y + h]]


def test_heated_slabs(spark):
    s = "tag string, values map<string,string>"
    d = [("R1", {"desc": "Radiant floor", "serves": "101, 102"}), ("R2", {"desc": "snow melt radiant", "serves": "1"}), ("R3", {"desc": "in-floor cooling"}), ("A", {"desc": "fan"})]
    assert rows(C.heated_slabs(spark.createDataFrame(d, s))) == [("R1", "101,102")]
    d.append(("R4", {"desc": "heated slab", "serves": ""}))
    assert rows(C.heated_slabs(spark.createDataFrame(d, s))) == [("R1,R4", None)]


def test_vestibules_and_atria(spark):
    r = spark.createDataFrame([("v", "entry", 8.0), ("l", "Lobby", 50.0), ("o", "office", 9.0)], "id string, name string, area_m2 double")
    d = spark.createDataFrame([("d1", "v", None, 1), ("d2", "l", "v", 2), ("d3", "o", None, 3)], "id string, room string, other string, place int")
    assert rows(C.exterior_vestibules(r, d)) == [("v",)]
    lv = spark.createDataFrame([("L1", 0.0), ("L2", 3.0), ("L3", 6.0), ("L4", 9.0)], "id string, elevation_z_m double")
    rooms = spark.createDataFrame([("a", "L1", RING(0.0, 0.0), 11.0), ("b", "L3", RING(1.0, 1.0), None), ("c", "L1", RING(20.0, 0.0), 3.0)], "id string, level_id string, polygon_m array<array<double>>, top_m double")
    assert rows(C.atria(rooms, lv)) == [("a", "L2", "L2")]


def test_shafts_and_merging(spark):
    s = "id long, level_id string, polygon_m array<array<double>>"
    lv = spark.createDataFrame([("L1", 0.0), ("L2", 3.0), ("L3", 6.0)], "id string, elevation_z_m double")
    shafts = spark.createDataFrame([(1, "L1", RING(0.0, 0.0)), (2, "L2", RING(0.1, 0.0)), (3, "L3", RING(0.2, 0.0)), (4, "L2", RING(2.0, 0.0)), (5, "L1", RING(50.0, 0.0))], s)
    assert dict(rows(J.shaft_stacks(shafts, lv))) == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    rooms = spark.createDataFrame([(1, "L1", RING(0.0, 0.0, 1.0, 1.0)), (2, "L1", RING(1.0, 0.0)), (3, "L1", RING(0.0, 1.0, 0.5, 2.0)), (9, "L1", RING(90.0, 0.0))], s)
    small = rooms.where("id in (1, 9)")
    got = {r.id: (r.target, r.reason) for r in J.merge_targets(rooms, small, ["level_id"]).collect()}
    assert got == {1: (2, None), 9: (None, "no neighbour")}
    blocks = spark.createDataFrame([(10, "L1", RING(0.0, 0.0, 2.0, 9.0)), (11, "L1", RING(2.0, 0.0, 9.0, 9.0))], s)
    assert [(r.space, r.block) for r in J.majority_blocks(rooms.where("id = 2"), blocks, ["level_id"]).collect()] == [(2, 11)]


def test_observations_merge_across_sheets(spark):
    v = spark.createDataFrame([(1, "A", "s", 0.0, 1.0, 0.9, "W1"), (2, "B", "s", 0.1, 1.1, 0.3, "W2"), (3, "A", "s", 5.0, 6.0, 0.8, "W1"), (4, "A", "s", 0.0, 1.0, 0.8, "W9")], "id long, sheet string, facade string, lo double, hi double, confidence double, tag string")
    g = N.group_means(N.merged_observations(v.where("id < 4"), ["facade"]), ["facade"])
    assert sorted((r.group, round(r.lo, 3), r.tag, r.n) for r in g.collect()) == [(1, 0.025, "W1,W2", 2), (3, 5.0, "W1", 1)]


def test_openings_of_revisions(spark):
    box = lambda x: (x, 0.0, x + 4.0, 4.0)
    s = "id int, sheet string, tag string, box struct<x0: double, y0: double, x1: double, y1: double>"
    old = spark.createDataFrame([(1, "A", "W1", box(0.0)), (2, "A", "W2", box(10.0)), (3, "A", "W2", box(20.0)), (4, "A", None, box(30.0))], s)
    new = spark.createDataFrame([(11, "A", "W1", box(90.0)), (12, "A", "W2", box(11.0)), (13, "A", "W2", box(60.0)), (14, "A", None, box(30.5))], s)
    assert rows(N.moved_openings(old, new, ["sheet"])) == [(1, 11, "tag"), (2, 12, "box"), (4, 14, "box")]
    e = N.enlarged_plans(spark.createDataFrame([(1, "L1", (1.0, 1.0, 3.0, 3.0)), (2, "L1", (50.0, 0.0, 51.0, 1.0))], "id int, level string, box struct<x0: double, y0: double, x1: double, y1: double>"), spark.createDataFrame([(7, "L1", (0.0, 0.0, 10.0, 10.0)), (8, "L1", (0.0, 0.0, 30.0, 30.0))], "id int, level string, box struct<x0: double, y0: double, x1: double, y1: double>"), ["level"])
    assert rows(e) == [(1, 7, None), (2, None, "none")]


def test_links_to_rooms_and_units(spark):
    rooms = spark.createDataFrame([("L1-101", "101", "OFFICE"), ("L1-102", "102", "Lab A")], "id string, number string, name string")
    refs = spark.createDataFrame([("A", "101"), ("B", "lab  a"), ("C", "999")], "tag string, room string")
    assert rows(N.link_rooms(refs, rooms)) == [("A", ["L1-101"]), ("B", ["L1-102"]), ("C", [])]
    eq = spark.createDataFrame([("V1", {"Served by": "AHU-1"}), ("V2", {"Served by": "AHU-9"}), ("V3", {"AHU": "AHU-1", "Unit": "AHU-2"}), ("V4", {"note": "x"})], "tag string, values map<string,string>")
    units = spark.createDataFrame([("ahu-1",), ("AHU-2",)], "unit string")
    assert rows(N.served_by(eq, units)) == [("V1", "AHU-1", None), ("V2", None, "not scheduled: AHU-9"), ("V3", None, "several: AHU-1,AHU-2")]


def test_providers(spark, tmp_path):
    spark.createDataFrame([("window", 0.9), ("door", 0.8)], "label string, score double").write.parquet(str(tmp_path / "d"))
    one = {"provider": "precomputed", "path": str(tmp_path / "d")}
    assert providers.detect(spark, {"provider": "combined", "parts": [one, {"provider": "labeled", "inner": one, "labels": ["door"]}]}).count() == 3
    with pytest.raises(KeyError):
        providers.detect(spark, {"provider": "none"})
    with pytest.raises(ValueError):
        providers.detect(spark, {"provider": "precomputed"})
    providers.provider("trial", release=False)(lambda spark: spark.range(1))
    with pytest.raises(PermissionError):
        providers.detect(spark, {"provider": "trial"}, release=True)
    assert providers.settings({"scale": "1:50"}, {"scale": "1:100"})["scale"] == "1:100"
    providers.READERS["upper"] = lambda b: b.decode().upper()
    d = spark.createDataFrame([(bytearray(b"ab"),), (None,)], "content binary")
    assert sorted(str(r.text) for r in providers.read_texts(d, "upper").collect()) == ["AB", "None"]
    assert providers.read_texts(d, None).where("text is not null").count() == 0
