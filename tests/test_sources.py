import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from planweave.checks import rules
from planweave.model import document
from planweave.sinks import writers
from planweave.sources import readers
from planweave.streaming import events


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_schedules_last_row_wins(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Tag,category,width_m,height_m\n w 1 ,,1.5,1.2\nW2,Door,0.9,2.1\nW1,window,1.6,n/a\n,window,1,1\n")
    s = readers.window_schedule(spark, str(tmp_path / "w.csv")).select("tag", "category", "width_m", F.coalesce("height_m", F.lit(-1.0)))
    assert rows(s) == [("W1", "window", 1.6, -1.0), ("W2", "door", 0.9, 2.1)]
    (tmp_path / "l.csv").write_text("tag,description,lamp_type,watts\nf 1,x,LED,64\nF1,y,LED,70\n")
    assert rows(readers.lighting_schedule(spark, str(tmp_path / "l.csv")).select("key", "tag", "watts")) == [("F1", "F1", 70.0)]


def test_detections_reject_what_breaks_the_contract(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"image": "s1.png", "width": 10, "height": 10, "preds": [{"cls": 0, "conf": 0.9, "x0": 1, "y0": 1, "x1": 2, "y1": 2}, {"cls": 7, "conf": 0.1, "x0": 1, "y0": 1, "x1": 2, "y1": 2}]}))
    (tmp_path / "b.json").write_text("{nonsense")
    (tmp_path / "c.json").write_text(json.dumps({"image": "s2.png"}))
    good, bad = readers.detections(spark, str(tmp_path), {0: "window"}, "detector")
    assert rows(good.select("image", "label", "score")) == [("s1.png", "7", 0.1), ("s1.png", "window", 0.9)]
    assert sorted(r.reason for r in bad.collect()) == ["no preds", "not JSON of the contract"]


def test_floorplans_read_two_columns(spark, tmp_path):
    d = spark.createDataFrame([((bytearray(b"x"), "p"), 1, ([[0.0, 0.0, 500.0, 2000.0], [1.0, 1.0, 2.0, 2.0]], ["door", "wall"]))], readers.FLOORPLAN)
    d.write.parquet(str(tmp_path / "f"))
    got = readers.floorplan_objects(spark, str(tmp_path / "f"), size=100.0)
    assert [(r.category, tuple(r.box)) for r in got.collect()] == [("door", (0.0, 0.0, 50.0, 100.0))]
    assert "bytes" not in got._jdf.queryExecution().executedPlan().toString()
    spark.range(3).write.parquet(str(tmp_path / "g"))
    with pytest.raises(TypeError):
        readers.floorplan_objects(spark, str(tmp_path / "g"))


def test_logs_and_annotations(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"kind": "friction", "context": {"a": "b"}, "at": "2026"}\n{oops\n{"kind": "note"}\n')
    assert sorted(r.kind for r in readers.feedback(spark, str(tmp_path / "f.jsonl")).collect()) == ["friction", "note"]
    (tmp_path / "e.err").write_text("** Warning ** a\n** Severe  ** b\nEnergyPlus Completed Successfully\n")
    assert tuple(readers.simulation_log(spark, str(tmp_path / "e.err")).first()) == (True, 1, 1)
    (tmp_path / "x.xml").write_text("<annotation><object><name>window</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object></annotation>")
    assert [tuple(r)[1:] for r in readers.xml_boxes(spark, str(tmp_path / "x.xml")).collect()] == [("window", 1.0, 2.0, 3.0, 4.0)]


def test_workbooks_and_databases(spark, tmp_path):
    m = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{m}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Component" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{m}"><si><t>Name</t></si><si><t>AHU-1</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{m}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1" t="inlineStr"><is><t>Flow</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="AB2"><v>1200</v></c></row></sheetData></worksheet>')
    t = readers.sheet_table(readers.workbook(spark, str(tmp_path / "b.xlsx")), "Component")
    assert [r.cells for r in t.collect()] == [{"Name": "AHU-1", "Flow": "1200"}]
    db = sqlite3.connect(tmp_path / "s.sql")
    db.execute("create table t (k text, v real)")
    db.execute("insert into t values ('eui', 12.5)")
    db.commit()
    db.close()
    assert [tuple(r)[1:] for r in readers.sqlite_tables(spark, str(tmp_path / "s.sql"), "select k, v from t", "k string, v double").collect()] == [("eui", 12.5)]


def test_continuation_and_headers(spark):
    d = spark.createDataFrame([(1, "A", "one"), (2, " ", "two"), (3, "TAG", "NOTE"), (4, "B", None)], "n int, tag string, note string")
    d = readers.without_repeated_headers(d, ["tag", "note"])
    assert rows(readers.continuation_rows(d, "tag", "n", ["note"])) == [("A", 1, "one two"), ("B", 4, "")]


def doc(version):
    p = {"sheet_id": "A-1", "revision": 1, "method": "m", "confidence": 0.9, "bbox": [0, 0, 1, 1], "note": ""}
    space = {"name": "R&D", "number": "1", "level_id": "L1", "polygon_m": [[0, 0], [4, 0], [4, 3], [0, 3]], "area_m2": 12, "volume_m3": 36, "core_provenance": p, "openings": [{"id": "o1", "tag": "W1", "category": "window", "width_m": 1, "height_m": 1, "area_m2": 1, "host_facade": "south", "provenance": p}], "zone_ids": ["z"]}
    return {"version": version, "name": "b", "levels": [{"id": "L1", "name": "one", "elevation_z_m": 0, "wall_height_m": 3}], "spaces": {"L1-1": space}, "envelope": [{"id": "w", "level_id": "L1", "facade": "south", "length_m": 4, "height_m": 3, "provenance": p}], "zones": {"z": {"space_ids": ["L1-1"], "n_diffusers": 1}}, "revision_log": [{"seq": 1, "sheet_id": "A-1", "revision": 1, "action": "import"}], "review": []}


def test_documents_come_forward(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps(doc("1.0")))
    d = document.read(spark, str(tmp_path / "m.json"))
    t = document.tables(d)
    o = t["openings"].first()
    assert d.first().version == document.VERSION and o.source_provenance[0].sheet_id == "A-1" and o.space_id == "L1-1" and o.sheet_id == "A-1"
    report = rules.run(rules.Model(spark, **{k: v.drop("model_id") for k, v in t.items()}), ["C01", "E03", "E08", "E11"])
    assert {r.check_id: r.severity for r in report.collect()} == {"C01": "pass", "E03": "pass", "E08": "pass", "E11": "pass"}
    x = writers.gbxml(t).first().body
    assert "<Name>R&amp;D</Name><Area>12.0</Area>" in x and 'buildingStoreyIdRef="L1"' in x and "<Area>12.0</Area></Surface>" in x
    assert "<FloorAreaValue>12.0</FloorAreaValue>" in writers.building_sync(t).first().body
    assert len(writers.canonical_json(d).first().sha256) == 64
    (tmp_path / "bad.json").write_text(json.dumps(doc("9.9")))
    with pytest.raises(Exception, match="unknown model version"):
        document.read(spark, str(tmp_path / "bad.json")).collect()


def test_manifest_and_publishing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1")
    (tmp_path / "in" / "b.txt").write_text("2")
    before = spark.createDataFrame(writers.manifest(spark, {"input": str(tmp_path / "in")}).collect())
    (tmp_path / "in" / "a.txt").write_text("changed")
    (tmp_path / "in" / "b.txt").unlink()
    (tmp_path / "in" / "c.txt").write_text("3")
    drift = writers.drift(before, writers.manifest(spark, {"input": str(tmp_path / "in")}))
    assert sorted(r.drift for r in drift.collect()) == ["added", "changed", "missing"]
    out = str(tmp_path / "out")
    assert writers.publish(spark.range(3), out, lambda w: w.count() == 3) and not writers.publish(spark.range(9), out, lambda w: False)
    assert spark.read.parquet(out).count() == 3 and writers.publish(spark.range(4), out, lambda w: True) and spark.read.parquet(out).count() == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]
    m = rules.Model(spark, revision_log=spark.createDataFrame([(1,)], "seq bigint"))
    assert not writers.gated_publish(m, spark.range(2), str(tmp_path / "no"))
    assert {r.number for r in writers.trust_report(m, rules.run(m, ["E11"])).collect()} >= {"spaces", "errors"}


def test_streams(spark, tmp_path):
    d = spark.createDataFrame([("a", "confirm", 1), ("a", "revert", 3), ("b", "edit", 2), ("a", "confirm", 2)], "item string, action string, seq long")
    d.repartition(2).write.parquet(str(tmp_path / "d.parquet"))
    stream = events.parquet_stream(spark, str(tmp_path), "d", files_per_batch=1)
    told = events.collect_stream(events.last_decisions(stream, "item", "action", "seq"), "decisions_test", "update")
    last = told.groupBy("item").agg(F.max_by("state", "seq").alias("state"))
    assert dict(rows(last)) == {"a": None, "b": "edit"}
    q = events.keep_history(events.parquet_stream(spark, str(tmp_path), "d"), str(tmp_path / "h"), "item", "seq", str(tmp_path / "c"))
    q.awaitTermination()
    q = events.keep_history(events.parquet_stream(spark, str(tmp_path), "d"), str(tmp_path / "h"), "item", "seq", str(tmp_path / "c"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "h")).count() == 4


def test_streams_of_one_name_do_not_share_state(spark, tmp_path):
    import __spark_entry__ as entry

    for k, n in (("a", 5), ("b", 7)):
        rows = [(i, "click", i % 3, 1.0 * i) for i in range(n)]
        spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double").selectExpr("event_id", "event_type", "user_id", "value", "timestamp_seconds(event_id) as ts").write.parquet(f"{tmp_path}/{k}/events.parquet")
    for _ in range(2):
        for k, n in (("a", 5), ("b", 7)):
            got = entry.queries()["stream_histogram"](spark, f"{tmp_path}/{k}").collect()
            assert sum(r.n for r in got) == n
            assert {r.user_id: r.seq for r in entry.queries()["stream_decisions"](spark, f"{tmp_path}/{k}").collect()} == {i % 3: i for i in range(n - 3, n)}
