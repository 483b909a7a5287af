import json
import random

from pyspark.sql import functions as F

from planweave import cli
from planweave.model import proposal
from planweave.operators import registration as R
from planweave.operators import text_model as X
from tests.test_sources import doc


def test_affine_and_grid(spark):
    t = [("s", x, y, 2 * x - y + 3, x + 4 * y - 1) for x, y in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (2.0, 3.0))] + [("line", float(i), float(i), 1.0, 1.0) for i in range(4)]
    got = {r.sheet: r for r in R.fit_affine(spark.createDataFrame(t, "sheet string, x double, y double, tx double, ty double"), ["sheet"]).collect()}
    assert [round(got["s"][k], 6) for k in "abcdef"] == [2, -1, 3, 1, 4, -1] and got["s"].rms < 1e-9 and got["line"].a is None
    b = spark.createDataFrame([("e", "A", 100.0), ("e", "B", 300.0), ("e", "C", 500.0), ("f", "A", 1.0)], "sheet string, label string, u double")
    g = spark.createDataFrame([("A", 0.0), ("B", 2.0), ("C", 4.2)], "label string, s double")
    r = R.register_grid(b, g, ["sheet"]).collect()
    assert len(r) == 1 and r[0].sheet == "e" and r[0].confidence == 0.85
    w = spark.createDataFrame([("north", 100.0, 50.0, 10.0), ("south", 100.0, 50.0, 10.0)], "facade string, px_per_m double, wall_u0_px double, facade_length_m double")
    assert {x.facade: (x.scale, x.offset) for x in R.register_by_wall(w).collect()} == {"north": (-0.01, 10.5), "south": (0.01, -0.5)}


def test_openings_seen_twice(spark):
    lv = spark.createDataFrame([("L1", 0.0), ("L2", 3.0)], "id string, elevation_z_m double")
    s = "id long, level_id string, host_facade string, tag string, category string, s_center_m double, width_m double, sill_m double, head_m double, confidence double, sheet_id string"
    o = [(1, "L1", "south", "W1", "window", 2.0, 1.0, 0.9, 3.0, 0.8, "a"), (2, "L2", "south", "W1", "window", 2.03, 1.1, 0.0, 1.5, 0.9, "b"), (3, "L1", "south", "W1", "window", 2.01, 1.0, 0.9, 2.5, 0.5, "c"), (4, "L1", "south", None, "window", 2.0, 1.0, 0.9, 2.5, 0.5, "d")]
    kept, over = R.dedupe_openings(spark.createDataFrame(o, s), lv)
    assert sorted((r.id, list(r.sources), r.n) for r in kept.collect()) == [(2, ["b", "a"], 3), (4, ["d"], 1)]
    assert [tuple(r) for r in over.collect()] == [(1, 3, "c")]


def test_placing(spark):
    d = spark.createDataFrame([("w", 1, 2.0, 3.0, 10.0), ("w", 2, 1.5, None, 10.0), ("w", 3, 4.0, None, 10.0), ("w", 4, 3.0, None, 10.0)], "wall string, id int, width_m double, s_m double, wall_m double")
    got = {r.id: (None if r.start_m is None else round(r.start_m, 3), r.reason) for r in R.place_openings(d, ["wall"]).collect()}
    assert got == {1: (2.0, None), 3: (4.1, None), 2: (0.1, None), 4: (None, "no room")}


def test_triage_model(spark):
    r = random.Random(1)
    rows = [(("missing tag on window " if i % 2 else "area of room agrees ") + str(r.randrange(99)), float(i % 2) + r.random(), i % 2) for i in range(240)]
    d = spark.createDataFrame(rows, "text string, n double, y int")
    out = X.TriageModel("text", ["n"], "y", slots=256).fit(d).predict(d.drop("y").withColumn("n", F.when(F.col("n") > 0.1, F.col("n"))))
    right = out.withColumn("y", F.col("text").startswith("missing").cast("int")).where((F.col("probability") > 0.5) == (F.col("y") == 1)).count()
    assert right >= 230 and out.where("probability < 0 or probability > 1").count() == 0


def test_noise_repeats(spark):
    d = spark.createDataFrame([(1, "BOILER 105"), (2, ""), (3, None)], "id int, text string")
    a, b = (sorted(map(str, X.degrade(d, "text", "id", 0.5).collect())) for _ in range(2))
    assert a == b and X.degrade(d, "text", "id", 0.0).where("id = 1").first().text == "BOILER 105"
    assert X.degrade(d, "text", "id", 1.0).where("id = 1").first().text == "801LFR IOS"


def test_proposals(spark, tmp_path):
    good = {"schema": "s", "version": "1", "units": "m", "id": "p", "levels": [{"id": "L1", "name": "one", "elevation_m": 0, "height_m": 3, "walls": [{"id": "w", "points": [[0, 0], [5, 0], [5, 4], [0, 4]], "closed": True, "openings": [{"id": "o", "kind": "window", "offset_m": 1, "sill_m": 1, "width_m": 1, "height_m": 1}]}], "spaces": [{"number": "1", "name": "a", "polygon": [[0, 0], [5, 0], [5, 4], [0, 4]]}]}]}
    bad = json.loads(json.dumps(good))
    bad["levels"][0]["walls"][0]["openings"][0] |= {"kind": "hatch", "sill_m": 2.5, "offset_m": 17.5}
    bad["levels"][0]["spaces"][0]["polygon"] = [[0, 0], [1, 1]]
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "b.json").write_text(json.dumps(bad))
    d = proposal.read(spark, str(tmp_path))
    assert sorted(r.problem for r in proposal.diagnostics(d).collect()) == ["beyond its wall", "higher than its wall", "no area", "unknown kind"]
    tables, report = proposal.mapped(d)
    assert sorted((r.proposed, r.mapped, r.reconciles) for r in report.collect()) == [(1, 0, False), (1, 1, True)]
    assert tables["walls"].first().length_m == 18 and tables["spaces"].first().volume_m3 == 60 and tables["openings"].first().head_m == 2


def test_command_line(spark, data, tmp_path, capsys):
    (tmp_path / "m.json").write_text(json.dumps(doc("1.2")))
    m = str(tmp_path / "m.json")
    assert cli.main(["queries"]) == 0 and "takeoff_rollup" in capsys.readouterr().out
    assert cli.main(["run", "compass", data, "--out", str(tmp_path / "o")]) == 0 and spark.read.parquet(str(tmp_path / "o")).count() == 8
    assert cli.main(["ask", m, "how many spaces"]) == 0 and "1 (count_spaces)" in capsys.readouterr().out
    assert cli.main(["gbxml", m]) == 0 and "<gbXML" in capsys.readouterr().out
    assert cli.main(["diff", m, m]) == 0 and "identical" in capsys.readouterr().out
    assert cli.main(["tables", m]) == 0
