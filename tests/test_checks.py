import pytest
from pyspark.sql import functions as F

from planweave.checks import rules
from planweave.plans import battery, catalog
from planweave.plans.registry import Tables
from planweave.query.engine import Engine, dispatch

ROOM = lambda x: [[x, 0.0], [x + 5.0, 0.0], [x + 5.0, 6.0], [x, 6.0]]


def clean(spark, **over):
    """A level of 10 x 6 m with two rooms of 30 m2, four walls, two windows and a zone."""
    t = {
        "levels": ([("L1", "Level 1", 0.0, 3.0)], "id string, name string, elevation_z_m double, wall_height_m double"),
        "spaces": ([("L1-101", "L1", "OFFICE", "101", ROOM(0.0), 30.0, 90.0, "room", "A-1", 10.0, 10.0 / 10.7639), ("L1-102", "L1", "LOBBY", "102", ROOM(5.0), 30.0, 90.0, "room", "A-1", 5.0, 5.0 / 10.7639)], "id string, level_id string, name string, number string, polygon_m array<array<double>>, area_m2 double, volume_m3 double, poly_type string, sheet_id string, lpd_w_m2 double, lpd_w_ft2 double"),
        "footprints": ([("L1", 60.0, 32.0)], "level_id string, area_m2 double, perimeter_m double"),
        "walls": ([("w1", "L1", "south", 10.0, 3.0, 30.0, "mass", 0.5, "A-1"), ("w2", "L1", "north", 10.0, 3.0, 30.0, "mass", 0.5, "A-1"), ("w3", "L1", "east", 6.0, 3.0, 18.0, "mass", 0.5, "A-1"), ("w4", "L1", "west", 6.0, 3.0, 18.0, "mass", 0.5, "A-1")], "id string, level_id string, facade string, length_m double, height_m double, area_m2 double, construction string, u_si double, sheet_id string"),
        "schedules": ([("W1", "window", 1.5, 1.2, None), ("F1", "fixture", None, None, 64.0)], "tag string, category string, width_m double, height_m double, watts double"),
        "openings": ([("o1", "L1-101", "W1", "window", 1.5, 1.2, 0.9, 2.1, "south", 2.0, 0.0, 5.0, 1.5 * 1.2, "A-2"), ("o2", "L1-101", "W1", "window", 1.5, 1.2, 0.9, 2.1, "south", 4.0, 0.0, 5.0, 1.5 * 1.2, "A-2")], "id string, space_id string, tag string, category string, width_m double, height_m double, sill_m double, head_m double, host_facade string, s_center_m double, s0_m double, s1_m double, area_m2 double, sheet_id string"),
        "fixtures": ([("f1", "L1-101", "F1", "E-1")], "id string, space_id string, tag string, sheet_id string"),
        "zones": ([("z1", 2, "AHU", 3.5, "small", "AHU-1")], "id string, n_diffusers bigint, system string, efficiency double, size_class string, unit string"),
        "zone_spaces": ([("z1", "L1-101"), ("z1", "L1-102")], "zone_id string, space_id string"),
        "space_zones": ([("L1-101", "z1"), ("L1-102", "z1")], "space_id string, zone_id string"),
        "components": ([("c1", "L1-101", "M-1")], "id string, space_id string, sheet_id string"),
        "revision_log": ([(1, "A-1", 1, "import", "")], "seq bigint, sheet_id string, revision bigint, action string, note string"),
    }
    frames = {k: spark.createDataFrame(*v) for k, v in t.items()}
    return rules.Model(spark, **frames | over)


def severities(report):
    return {r.check_id: r.severity for r in report.collect()}


def test_battery_on_a_clean_model(spark):
    report = rules.run(clean(spark)).cache()
    got = severities(report)
    assert len(rules.RULES) == 49 and len(got) == 49
    assert set(got.values()) <= {"pass", "skip"}, {k: v for k, v in got.items() if v not in ("pass", "skip")}
    assert rules.summary(report).first().ok and rules.gate(report).first().may_export


DEFECTS = {
    "C01": ("spaces", lambda: {"area_m2": F.lit(31.0)}, "warn"),
    "C02": ("spaces", lambda: {"level_id": F.lit(None).cast("string")}, "error"),
    "C03": ("spaces", lambda: {"volume_m3": F.lit(91.0)}, "warn"),
    "C04": ("spaces", lambda: {"volume_m3": F.lit(99.0)}, "error"),
    "C10": ("walls", lambda: {"construction": F.lit(None).cast("string")}, "warn"),
    "C12": ("spaces", lambda: {"poly_type": F.lit("attic")}, "error"),
    "C13": ("walls", lambda: {"area_m2": F.col("area_m2") * 2}, "warn"),
    "I02": ("openings", lambda: {"area_m2": F.lit(100.0)}, "error"),
    "I03": ("openings", lambda: {"area_m2": F.lit(5.0)}, "error"),
    "I04": ("fixtures", lambda: {"tag": F.lit("F9")}, "error"),
    "I05": ("openings", lambda: {"tag": F.lit("W9")}, "error"),
    "I06": ("openings", lambda: {"width_m": F.lit(0.0)}, "error"),
    "I07": ("spaces", lambda: {"lpd_w_m2": F.lit(30.0)}, "warn"),
    "I08": ("spaces", lambda: {"lpd_w_ft2": F.lit(9.0)}, "error"),
    "I09": ("openings", lambda: {"sill_m": F.lit(-1.0)}, "error"),
    "I12": ("openings", lambda: {"space_id": F.lit("none")}, "warn"),
    "E02": ("zones", lambda: {"n_diffusers": F.lit(0).cast("bigint")}, "error"),
    "E03": ("space_zones", lambda: {"zone_id": F.lit("z9")}, "error"),
    "E04": ("spaces", lambda: {"number": F.lit("101")}, "warn"),
    "E05": ("openings", lambda: {"s_center_m": F.lit(9.0)}, "error"),
    "E06": ("openings", lambda: {"s_center_m": F.lit(2.0)}, "error"),
    "E07": ("openings", lambda: {"tag": F.lit(" ")}, "warn"),
    "E08": ("components", lambda: {"sheet_id": F.lit("")}, "error"),
}


@pytest.mark.parametrize("check_id", sorted(DEFECTS))
def test_each_defect_fires_its_rule(spark, check_id):
    table, change, severity = DEFECTS[check_id]
    m = clean(spark)
    broken = clean(spark, **{table: getattr(m, table).withColumns(change())})
    assert severities(rules.run(broken, [check_id])) == {check_id: severity}


def test_gate_waits_for_acknowledgement(spark):
    m = clean(spark, review=spark.createDataFrame([("r1", "k", "d", 0.5, "open", True, False)], "id string, kind string, description string, confidence double, status string, needs_review boolean, acknowledged boolean"))
    report = rules.run(m, ["E10"])
    assert severities(report) == {"E10": "warn"} and not rules.gate(report, m.review).first().may_export
    assert rules.gate(report, m.review, least_confidence=0.6).first().may_export


def test_limits(spark):
    limits = spark.createDataFrame([("wall", "mass", 0.4), ("wall", "steel", 0.6)], "surface string, class string, u_max double")
    assert severities(rules.run(clean(spark, limits=limits), ["A01"])) == {"A01": "error"}
    other = spark.createDataFrame([("wall", "steel", 0.6)], "surface string, class string, u_max double")
    assert severities(rules.run(clean(spark, limits=other), ["A01"])) == {"A01": "warn"}


def test_a_failing_rule_is_a_finding(spark, monkeypatch):
    def broken(m):
        raise RuntimeError("no")

    monkeypatch.setattr(rules, "RULES", [("Z01", "broken", broken)])
    assert rules.run(clean(spark)).first().message == "the rule failed: RuntimeError"


def test_questions(spark):
    e = Engine(clean(spark), bearing_deg=181.0)
    ask = lambda q: tuple(e.query(q).first())
    assert ask("How many spaces?") == ("2", "count_spaces") and ask("total floor area") == ("60.0", "total_floor_area")
    assert ask("which direction is it facing") == ("S", "building_orientation") and ask("tell me a joke") == (None, "query_dispatch")
    assert ask("list zones")[0] == '{"z1":["L1-101","L1-102"]}' and '"wwr":0.0375' in ask("WWR")[0]
    assert dispatch(None) is None and len(e.available()) == 5
    assert e.space_by_number("101").count() == 1 and e.zones_of_space("L1-101").first()[0] == "z1" and e.spaces_of_zone("z1").count() == 2


def test_large_areas_have_no_exponent(spark):
    for areas, want in (([67842000.0, 50.0], "67842050.0"), ([12345678.25, 0.0], "12345678.25"), ([9e15, 5e14], "9500000000000000.0"), ([1.5e16, 0.0], "1.5e+16"), ([0.001, None], "0.001"), ([-2e7, None], "-20000000.0")):
        m = rules.Model(spark, spaces=spark.createDataFrame([("a", areas[0]), ("b", areas[1])], "id string, area_m2 double"))
        assert Engine(m).query("total floor area").first().answer == want
    assert Engine(rules.Model(spark)).query("total floor area").first().answer is None


def test_repeated_openings_are_counted_without_their_pairs(spark):
    import random

    r = random.Random(4)
    levels = spark.createDataFrame([(f"L{i}", f"L{i}", 3.0 * i, 3.0) for i in range(3)], "id string, name string, elevation_z_m double, wall_height_m double")
    spaces = spark.createDataFrame([(f"s{i}", f"L{i}") for i in range(3)], "id string, level_id string")
    rows = [(f"o{i:03}", f"s{i % 3}", "W1" if i % 5 else None, "window", r.choice("ns"), None if i % 17 == 0 else r.randrange(-4, 5) * 0.05 + r.choice((0.0, 0.01)), r.choice((1.0, 1.15, 1.3))) for i in range(240)]
    openings = spark.createDataFrame(rows, "id string, space_id string, tag string, category string, host_facade string, s_center_m double, width_m double")
    pairs = [a[0] for a in rows for b in rows if a[2] and a[2] == b[2] and a[4] == b[4] and int(b[1][1]) == int(a[1][1]) + 1 and None not in (a[5], b[5]) and abs(a[5] - b[5]) <= 0.05 and abs(a[6] - b[6]) <= 0.15]
    m = rules.Model(spark, levels=levels, spaces=spaces, openings=openings)
    got = rules.run(m, ["I11"]).first()
    assert (got.severity, got.n_bad, got.entities) == ("warn", len(pairs), ",".join(sorted(pairs)[:20])) and len(pairs) > 400
    found = next(f for check, _, f in rules.RULES if check == "I11")(m)
    assert found.bad.count() == len(set(pairs))


def test_spaces_are_not_broadcast(spark, data):
    m = battery.model(Tables(spark, data))
    for check, _, f in rules.RULES:
        if check in ("C09", "I07", "I09", "I12", "E03"):
            plan = f(m).bad._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan, check


def test_summary_and_gate_of_many_repeats(spark):
    # 30,000 openings on each of two levels: 9 * 10^8 pairs, which no rule may make.
    levels = spark.createDataFrame([("L0", "L0", 0.0, 3.0), ("L1", "L1", 3.0, 3.0)], "id string, name string, elevation_z_m double, wall_height_m double")
    spaces = spark.createDataFrame([("s0", "L0"), ("s1", "L1")], "id string, level_id string")
    i = F.col("id")
    openings = spark.range(60000).select(i.cast("string").alias("id"), F.concat(F.lit("s"), i % 2).alias("space_id"), F.lit("W1").alias("tag"), F.lit("window").alias("category"), F.lit("south").alias("host_facade"), F.lit(2.0).alias("s_center_m"), F.lit(1.0).alias("width_m"))
    m = rules.Model(spark, levels=levels, spaces=spaces, openings=openings)
    report = rules.run(m, ["I11"])
    assert report.first().n_bad == 900_000_000 and tuple(rules.summary(report).first()) == (0, 1, 0, 0, True) and rules.gate(report, m.review).first().may_export


def test_rows_are_counted_in_few_passes(spark, data):
    m = battery.model(Tables(spark, data))
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    report = rules.run(m, keep=0)
    assert jobs() - before < 300
    n = {x.check_id: x.n_bad for x in report.collect()}
    found = {check: f(m) for check, _, f in rules.RULES}
    cheap = {check: f for check, f in found.items() if f.parts or f.tally}
    assert len(cheap) > 12
    for check, f in cheap.items():
        bad = f.bad.withColumn("_n", F.col("_n") if "_n" in f.bad.columns else F.lit(1)).agg(F.sum("_n")).first()[0] or 0
        assert n[check] == bad, check


def test_a_pass_that_fails_leaves_its_rules_alone(spark):
    bad = F.raise_error(F.lit("no")).cast("boolean")
    m = rules.Model(spark, spaces=spark.createDataFrame([("a", "L", -1.0)], "id string, level_id string, area_m2 double"))
    added = [("T01", "fails", lambda m: rules.each((m.spaces, None, bad))), ("T02", "fails to plan", lambda m: m.spaces.no), ("T03", "negative", lambda m: rules.each((m.spaces, None, F.col("area_m2") < 0)))]
    rules.RULES.extend(added)
    try:
        got = {x.check_id: (x.severity, x.n_bad, x.entities, x.message.split(":")[0]) for x in rules.run(m, ["T01", "T02", "T03"]).collect()}
    finally:
        del rules.RULES[-3:]
    assert got["T03"] == ("error", 1, "a", "") and {got[k] for k in ("T01", "T02")} == {("error", 0, "", "the rule failed")}


def test_gate_looks_for_no_ids(spark, data, monkeypatch):
    asked = []
    row = rules.Finding.row
    monkeypatch.setattr(rules.Finding, "row", lambda f, m, keep=20, *a: asked.append(keep) or row(f, m, keep, *a))
    assert tuple(catalog.QUERIES["gate"](spark, data).first()) == (False, False)
    assert len(asked) == len(rules.RULES) and not any(asked)


def test_a_slow_rule_holds_up_no_other(spark):
    from threading import Event

    last = Event()
    n = lambda m: m.spaces.agg(F.count("*").alias("n"))
    added = [("T00", "slow", lambda m: rules.Finding(m.spaces, "id", tally=lambda: last.wait(30) and n(m)))]
    added += [(f"T{i:02}", "between", lambda m: rules.Finding(m.spaces, "id", tally=lambda: n(m))) for i in range(1, 13)]
    added += [("T13", "last", lambda m: rules.Finding(m.spaces, "id", tally=lambda: last.set() or n(m)))]
    m = rules.Model(spark, spaces=spark.createDataFrame([("a", "L")], "id string, level_id string"))
    rules.RULES.extend(added)
    try:
        got = [(x.check_id, x.n_bad) for x in rules.run(m, [x for x, _, _ in added], keep=0).collect()]
    finally:
        del rules.RULES[-14:]
    assert got == [(f"T{i:02}", 1) for i in range(14)]


def test_ids_are_sorted_by_their_hashes(spark, data):
    m = battery.model(Tables(spark, data))
    for check, _, f in rules.RULES:
        if check in ("C09", "I07", "I09", "I10", "I11", "I12", "E03", "E06"):
            assert "Sort [_h#" in f(m).bad._jdf.queryExecution().executedPlan().toString(), check


def test_model_writes_what_joins_give(spark, data, monkeypatch):
    wrote = []
    stored = battery.stored
    monkeypatch.setattr(battery, "stored", lambda x, name: wrote.append(x.columns) or stored(x, name))
    m = battery.model(Tables(spark, data))
    assert len(wrote) == 6 and ["o_orderkey", "o_orderstatus", "o_orderpriority", "sid"] in wrote
    assert "Join" not in m.daylight._jdf.queryExecution().executedPlan().toString()


def test_windows_at_one_place(spark):
    rows = [("a", "s", 1.0), ("b", "s", 1.0), ("c", "s", 1.1), ("d", "s", 1.3), ("e", None, 1.0), ("f", None, 1.14), ("g", "t", 1.0), ("h", "s", None)]
    openings = spark.createDataFrame(rows, "id string, space_id string, s_center_m double").withColumns({"tag": F.lit("W"), "host_facade": F.lit("north"), "category": F.lit("window")})
    got = rules.run(rules.Model(spark, openings=openings), ["E06"]).first()
    assert (got.severity, got.n_bad, got.entities) == ("error", 3, "a,b,e")
