import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.functions import text as T
from planweave.functions import units as U
from planweave.operators import polygons as P


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, metres", [("3'-6\"", 1.0668), ("3'-6 1/2\"", 1.0795), ('42"', 1.0668), ("12'", 3.6576), ("900 mm", 0.9), ("90 cm", 0.9), ("0.9 m", 0.9), ('1/2"', 0.0127), ("abc", None), (None, None), ("", None)])
def test_length(spark, text, metres):
    got = one(spark, text, "string", T.length_m)
    assert got is None if metres is None else math.isclose(got, metres, abs_tol=1e-9)


@pytest.mark.parametrize("text, ratio", [("1:100", 100), ("SCALE 1 : 50", 50), ("1/8\" = 1'-0\"", 96), ("NTS", None), ("none", None)])
def test_scale(spark, text, ratio):
    got = one(spark, text, "string", T.scale_ratio)
    assert got is None if ratio is None else math.isclose(got, ratio)


@pytest.mark.parametrize("text, number", [("1,250 cfm", 1250), ("about 3.5", 3.5), ("-2", -2), ("none", None), (None, None)])
def test_number(spark, text, number):
    assert one(spark, text, "string", T.number) == number


@pytest.mark.parametrize("title, kind, level", [("SECOND FLOOR PLAN", "floor_plan", "L2"), ("Roof plan", "roof_plan", "ROOF"), ("BASEMENT 2 PLAN", "floor_plan", "B2"), ("Door schedule", "schedule", None), ("South Elevation", "elevation", None)])
def test_titles(spark, title, kind, level):
    r = spark.createDataFrame([(title,)], "t string").select(T.sheet_type("t"), T.level_of_title("t")).first()
    assert (r[0], r[1]) == (kind, level)


def test_labels_and_tags(spark):
    r = spark.createDataFrame([(" of 1 ", "OFFICE 1O1", "102 LOBBY", "AHU-1 supply")], "a string, b string, c string, d string").select(T.normalize_tag("a"), T.room_label("b"), T.room_label("c"), T.equipment_tag("d")).first()
    assert r[0] == "OF1" and tuple(r[1]) == ("OFFICE", "101", 0.95) and tuple(r[2]) == ("LOBBY", "102", 0.95) and r[3] == "AHU-1"
    n = spark.createDataFrame([(None,)], "a string").select(T.normalize_tag("a"), T.facade_of_title("a")).first()
    assert n[0] == "" and n[1] is None


def test_rules_need_one_hit(spark):
    rules = [("steel", "steel"), ("wood|timber", "wood")]
    rows = spark.createDataFrame([("steel stud",), ("wood and steel",), ("glass",)], "t string").select(T.exactly_one_rule("t", rules).alias("r")).collect()
    assert [(x.r.value, x.r.reason) for x in rows] == [("steel", None), (None, "ambiguous"), (None, "none")]


def test_units(spark):
    q = lambda a, u, b, v: spark.createDataFrame([(a, u, b, v)], "a double, u string, b double, v string").select(U.same_quantity("a", "u", "b", "v")).first()[0]
    assert q(1.0, "kW", 1000.0, "W") and not q(1.0, "kW", 1001.0, "W")
    assert q(5.0, "odd", 5.0, "cfm") and not q(5.0, "cfm", 6.0, "odd")
    with pytest.raises(Exception, match="unknown power unit"):
        spark.createDataFrame([(1.0, "cubit")], "a double, u string").select(U.to_btuh("a", "u")).collect()


SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]


@pytest.mark.parametrize("x, y, raw, include, strict", [(2, 2, True, True, True), (5, 2, False, False, False), (4, 2, None, True, False), (0, 0, None, True, False)])
def test_point_in_polygon(spark, x, y, raw, include, strict):
    d = spark.createDataFrame([(SQUARE, float(x), float(y))], "p array<array<double>>, x double, y double")
    got = d.select(*[G.point_in_polygon("x", "y", "p", b).alias(b) for b in ("raw", "include", "strict")]).first()
    assert got["include"] == include and got["strict"] == strict and (raw is None or got["raw"] == raw)


def test_degenerate_polygons(spark):
    d = spark.createDataFrame([([],), ([[1.0, 1.0]],), ([[0.0, 0.0], [1.0, 1.0]],), ([[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]],)], "p array<array<double>>")
    for r in d.select(G.area("p").alias("a"), G.centroid("p").alias("c")).collect():
        assert r.a == 0 and r.c is None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.integers(1, 5), st.integers(1, 5)), min_size=1, max_size=6))
def test_union_area_of_boxes(boxes):
    cells = {(x + i, y + j) for x, y, w, h in boxes for i in range(w) for j in range(h)}
    rings = [[[x, y], [x + w, y], [x + w, y + h], [x, y + h]] for x, y, w, h in boxes]
    assert math.isclose(P.union_area(rings), len(cells), abs_tol=1e-9)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=1, max_size=15))
def test_hull_holds_all_points(points):
    hull = P.convex_hull(points)
    for x, y in points:
        for (ax, ay), (bx, by) in zip(hull, hull[1:] + hull[:1]):
            assert len(hull) < 3 or (bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0


def test_polygon_pieces():
    parts = P.perimeter_core([[0, 0], [20, 0], [20, 10], [0, 10]], 3)
    assert [k for k, _ in parts] == ["south", "east", "north", "west", "core"]
    assert math.isclose(sum(abs(P._area(p)) for _, p in parts), 200)
    halves = P.split_polygon(SQUARE, (2, -1), (2, 5))
    assert sorted(abs(P._area(p)) for p in halves) == [8, 8]
    assert math.isclose(abs(P._area(P.clip_convex([[2, 2], [6, 2], [6, 6], [2, 6]], SQUARE))), 4)
    ring = P.simplify_ring([[0, 0], [2, 0.001], [4, 0], [4, 4], [0, 4]], 0.01)
    assert len(ring) == 4
    assert all(v[2] > 0 for v in P.sun_vectors(45)) and not [v for v in P.sun_vectors(90)[:1] if v[2] < 0]
    with pytest.raises(ValueError):
        P.sun_vectors(91)


def test_volume_and_normals(spark):
    cube = [[[0, 0, 0], [0, 1, 0], [1, 1, 0], [1, 0, 0]], [[0, 0, 1], [1, 0, 1], [1, 1, 1], [0, 1, 1]], [[0, 0, 0], [1, 0, 0], [1, 0, 1], [0, 0, 1]], [[1, 1, 0], [0, 1, 0], [0, 1, 1], [1, 1, 1]], [[0, 1, 0], [0, 0, 0], [0, 0, 1], [0, 1, 1]], [[1, 0, 0], [1, 1, 0], [1, 1, 1], [1, 0, 1]]]
    cube = [[[float(c) for c in v] for v in f] for f in cube]
    d = spark.createDataFrame([(cube,)], "f array<array<array<double>>>")
    assert math.isclose(d.select(G.shell_volume("f")).first()[0], 1)
    r = d.select(G.plane_orientation(F.col("f")[2]).alias("o")).first().o
    assert math.isclose(r.tilt_deg, 90) and math.isclose(r.azimuth_deg, 180) and math.isclose(r.area, 1)


def test_zones_of_other_shapes_and_joined_outlines():
    hexagon = [[4.0, 0.0], [10.0, 0.0], [14.0, 6.0], [10.0, 12.0], [4.0, 12.0], [0.0, 6.0]]
    parts = P.perimeter_core(hexagon, 2.0)
    assert len(parts) == 7 and parts[-1][0] == "core" and math.isclose(sum(abs(P._area(p)) for _, p in parts), abs(P._area(hexagon)))
    assert P.perimeter_core([[0, 0], [4, 0], [4, 1], [0, 1]], 3)[0][0] in ("north", "south") and not [k for k, _ in P.perimeter_core([[0, 0], [4, 0], [4, 1], [0, 1]], 3) if k == "core"]
    assert P.perimeter_core([[0, 0], [4, 0], [4, 4], [2, 1], [0, 4]], 1)[0][0] == "unsplit"
    ell = P.joined_ring([SQUARE, [[4, 1], [6, 1], [6, 3], [4, 3]]])
    assert len(ell) == 8 and math.isclose(abs(P._area(ell)), 20)
    assert math.isclose(abs(P._area(P.joined_ring([SQUARE, [[4, 0], [8, 0], [8, 4], [4, 4]]]))), 32) and len(P.joined_ring([SQUARE, [[4, 0], [8, 0], [8, 4], [4, 4]]])) == 4
    assert P.joined_ring([SQUARE]) and P.joined_ring([]) == []
