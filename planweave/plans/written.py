"""Readers and writers: the tables are written in a format's own shape and read back by its reader."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from planweave.model import document
from planweave.plans import battery
from planweave.plans.registry import query
from planweave.session import shared_folder
from planweave.sinks import writers
from planweave.sources import providers, readers


def _place(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _text_files(t, rows, name: str) -> str:
    """A text file for each value of the column `file`, from the column `value`."""
    path = _place(t, name)
    rows.select("file", "value").repartition("file").write.partitionBy("file").text(path)
    return f"{path}/*"


@query("""SELECT upper(replace(p_brand, ' ', '')) || '-' || p_partkey AS key, p_name AS description, p_type AS lamp_type, p_size::DOUBLE AS watts FROM part""")
def read_lighting_schedule(t):
    """Lamps of a lighting schedule in CSV."""
    path = _place(t, "lamps")
    t.part.select(F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" -"), "p_partkey").alias("Tag"), F.col("p_name").alias("description"), F.col("p_type").alias("lamp_type"), F.col("p_size").alias("watts")).write.option("header", True).csv(path)
    return readers.lighting_schedule(t.spark, path).select("key", "description", "lamp_type", "watts")


@query("""SELECT upper(replace(p_brand, ' ', '')) || '-' || p_partkey AS tag, CASE WHEN p_size % 2 = 0 THEN 'door' ELSE 'window' END AS category, CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0 END::DOUBLE AS width_m, 2.0::DOUBLE AS height_m FROM part""")
def read_window_schedule(t):
    """Openings of a window schedule in CSV; blank categories are windows, sizes that are no numbers null."""
    path = _place(t, "windows")
    s = F.col("p_size")
    t.part.select(F.concat("p_brand", F.lit("-"), "p_partkey").alias("tag"), F.when(s % 2 == 0, " Door ").otherwise(" ").alias("category"), F.when(s % 7 == 0, "wide").otherwise((s / 10.0).cast("string")).alias("width_m"), F.lit("2.0").alias("height_m")).write.option("header", True).csv(path)
    return readers.window_schedule(t.spark, path).select("tag", "category", "width_m", "height_m")


@query("""SELECT 'N' || n_nationkey AS image, CASE s_suppkey % 3 WHEN 0 THEN 'window' WHEN 1 THEN 'door' ELSE '2' END AS label, count(*) AS n, sum(s_suppkey)::DOUBLE AS x FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 0 GROUP BY 1, 2 UNION ALL SELECT 'no image', 'rejected', count(DISTINCT n_nationkey), 0 FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_nationkey % 7 = 0""")
def read_detections(t):
    """Detections of a detector's JSON, a file for each image; files without an image are rejected."""
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    p = F.struct((s % 3).cast("int").alias("cls"), F.lit(0.9).alias("conf"), s.cast("double").alias("x0"), F.lit(0.0).alias("y0"), (s + 1.0).alias("x1"), F.lit(1.0).alias("y1"))
    docs = t.supplier.groupBy(n.alias("file")).agg(F.collect_list(p).alias("preds"))
    body = F.when(F.col("file") % 7 != 0, F.to_json(F.struct(F.concat(F.lit("N"), "file").alias("image"), F.lit(10).alias("width"), F.lit(10).alias("height"), "preds"))).otherwise(F.to_json(F.struct("preds")))
    good, bad = readers.detections(t.spark, _text_files(t, docs.select("file", body.alias("value")), "detections"), {0: "window", 1: "door"}, "detector")
    told = good.groupBy("image", "label").agg(F.count("*").alias("n"), F.sum("box.x0").alias("x"))
    return told.unionByName(bad.groupBy(F.col("reason").alias("image")).agg(F.lit("rejected").alias("label"), F.count("*").alias("n"), F.lit(0.0).alias("x")))


@query("""SELECT l_orderkey AS image_id, l_returnflag AS category, count(*) AS n, round(sum(least(1000, l_quantity * 50)) / 1000 * 2, 6) AS x1 FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def read_floorplans(t):
    """Objects of floor plans in Parquet, boxes scaled from thousandths and kept inside."""
    path = _place(t, "plans")
    box = F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity") * 50, F.lit(10.0))
    objects = t.lineitem.groupBy(F.col("l_orderkey").alias("image_id")).agg(F.collect_list(F.struct(box.alias("bbox"), F.col("l_returnflag").alias("category"))).alias("o"))
    objects.select(F.struct(F.lit(None).cast("binary").alias("bytes"), F.lit("x").alias("path")).alias("image"), "image_id", F.struct(F.col("o.bbox").alias("bbox"), F.col("o.category").alias("category")).alias("objects")).write.parquet(path)
    return readers.floorplan_objects(t.spark, path, ("R",), 2.0).groupBy("image_id", "category").agg(F.count("*").alias("n"), F.round(F.sum("box.x1"), 6).alias("x1"))


@query("""SELECT event_type AS kind, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE event_id % 10 <> 0 GROUP BY 1""")
def read_feedback(t):
    """Events of a JSON lines log; lines that are no JSON are skipped."""
    path = _place(t, "feedback")
    line = F.to_json(F.struct(F.col("event_type").alias("kind"), F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("context"), F.col("ts").cast("string").alias("at")))
    t.events.select(F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(line).alias("value")).write.text(path)
    return readers.feedback(t.spark, path).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct(F.col("context")["user"]).alias("users"))


@query("""SELECT true AS completed, count(*) FILTER (WHERE event_type = 'error') AS warnings, count(*) FILTER (WHERE event_type <> 'error' AND value > 50) AS severe FROM events""")
def read_simulation_log(t):
    """What a simulation's error log says."""
    path = _place(t, "log")
    t.events.select(F.when(F.col("event_type") == "error", F.lit("   ** Warning ** something")).when(F.col("value") > 50, F.lit("   ** Severe  ** worse")).otherwise("plain line").alias("value")).unionByName(t.spark.range(1).select(F.lit("Run Completed Successfully").alias("value"))).write.text(path)
    return readers.simulation_log(t.spark, path)


@query("""SELECT CASE s_suppkey % 2 WHEN 0 THEN 'room' ELSE 'wall' END AS label, count(*) AS n, sum(s_suppkey)::DOUBLE AS x0, sum(s_suppkey + 5)::DOUBLE AS x1 FROM supplier GROUP BY 1""")
def read_xml_boxes(t):
    """Boxes of annotation files in XML."""
    s = F.col("s_suppkey")
    one = F.concat(F.lit("<object><name>"), F.when(s % 2 == 0, "room").otherwise("wall"), F.lit("</name><bndbox><xmin>"), s, F.lit("</xmin><ymin>0</ymin><xmax>"), s + 5, F.lit("</xmax><ymax>9</ymax></bndbox></object>"))
    docs = t.supplier.groupBy(F.col("s_nationkey").alias("file")).agg(F.concat(F.lit("<annotation>"), F.array_join(F.collect_list(one), ""), F.lit("</annotation>")).alias("value"))
    return readers.xml_boxes(t.spark, _text_files(t, docs, "boxes")).groupBy("label").agg(F.count("*").alias("n"), F.sum("x0").alias("x0"), F.sum("x1").alias("x1"))


@query("""SELECT n_name AS key, string_agg(part, ' ' ORDER BY seq) AS note FROM (SELECT n_name, 3 * n_nationkey AS seq, n_name || ' note' AS part FROM nation UNION ALL SELECT n_name, 3 * n_nationkey + 1, 'more of ' || n_nationkey FROM nation UNION ALL SELECT n_name, 3 * n_nationkey + 2, 'end' FROM nation WHERE n_nationkey % 2 = 0) GROUP BY 1""")
def read_continued_rows(t):
    """Rows without a key go on with the one before; repeated headers go first."""
    n = F.col("n_nationkey")
    row = lambda k, key, note: F.struct((n * 4 + k).alias("seq"), key.alias("key"), note.alias("note"))
    rows = F.array(row(0, F.col("n_name"), F.concat("n_name", F.lit("  note"))), row(1, F.lit(" "), F.concat(F.lit("more of "), n)), row(2, F.lit("KEY"), F.lit("Note ")), row(3, F.when(n % 2 == 0, "").otherwise("Key"), F.when(n % 2 == 0, "end").otherwise("note")))
    return readers.continuation_rows(readers.without_repeated_headers(t.nation.select(F.inline(rows)), ["key", "note"]), "key", "seq", ["note"]).select("key", "note")


def _documents(t):
    """Model documents of 300 customers each, written as JSON and read back; half of them of an older version."""
    path = _place(t, "models")
    k = F.col("c_custkey")
    p = F.struct(F.lit("A-101").alias("sheet_id"), F.lit(1).alias("revision"), F.lit("read").alias("method"), F.lit(0.9).alias("confidence"))
    opening = F.struct(F.concat(F.lit("o"), k).alias("id"), F.lit("W1").alias("tag"), F.lit("window").alias("category"), F.lit(1.0).alias("width_m"), F.lit(2.0).alias("height_m"), F.lit(2.0).alias("area_m2"), p.alias("provenance"))
    space = F.struct(F.concat(F.lit("L1-"), k).alias("id"), F.struct(F.col("c_name").alias("name"), k.cast("string").alias("number"), F.lit("L1").alias("level_id"), F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0))]).alias("polygon_m"), F.lit(12.0).alias("area_m2"), F.lit(36.0).alias("volume_m3"), p.alias("core_provenance"), F.when(k % 2 == 0, F.array(opening)).otherwise(F.array(opening, opening)).alias("openings"), F.array(F.lit("z1")).alias("zone_ids")).alias("s"))
    building = F.floor(k / 300)
    docs = t.customer.groupBy(building.alias("b")).agg(F.map_from_entries(F.collect_list(space)).alias("spaces"))
    wall = F.struct(F.lit("w1").alias("id"), F.lit("L1").alias("level_id"), F.lit("south").alias("facade"), F.lit(4.0).alias("length_m"), F.lit(3.0).alias("height_m"), p.alias("provenance"))
    body = F.to_json(F.struct(F.when(F.col("b") % 2 == 0, "1.2").otherwise("1.3").alias("version"), F.concat(F.lit("B"), F.col("b")).alias("name"), F.array(F.struct(F.lit("L1").alias("id"), F.lit("one").alias("name"), F.lit(0.0).alias("elevation_z_m"), F.lit(3.0).alias("wall_height_m"))).alias("levels"), "spaces", F.array(wall).alias("envelope"), F.create_map(F.lit("z1"), F.struct(F.array(F.lit("L1-0")).alias("space_ids"), F.lit(1).alias("n_diffusers"))).alias("zones")))
    docs.select(F.col("b").alias("file"), body.alias("value")).repartition("file").write.partitionBy("file").text(path)
    return document.read(t.spark, f"{path}/*").withColumn("model_id", F.col("name"))


@query("""SELECT 'B' || (c_custkey // 300) AS model_id, '1.3' AS version, count(*) AS spaces, sum(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END)::BIGINT AS openings, sum(CASE WHEN (c_custkey // 300) % 2 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END ELSE 0 END)::BIGINT AS sourced, 12.0 * count(*)::DOUBLE AS area, count(*) AS zoned FROM customer GROUP BY 1, c_custkey // 300""")
def read_documents(t):
    """Model documents brought to the present version, and their tables."""
    d = _documents(t)
    m = document.tables(d)
    s = m["spaces"].groupBy("model_id").agg(F.count("*").alias("spaces"), F.sum("area_m2").alias("area"))
    o = m["openings"].groupBy("model_id").agg(F.count("*").alias("openings"), F.sum(F.greatest(F.size(F.coalesce("source_provenance", F.array())), F.lit(0))).alias("sourced"))
    z = m["space_zones"].groupBy("model_id").agg(F.count("*").alias("zoned"))
    return d.select("model_id", "version").join(s, "model_id").join(o, "model_id").join(z, "model_id")


@query("""SELECT 'B' || (c_custkey // 300) AS model_id, count(*) AS spaces, 1::BIGINT AS walls, count(*) AS points, (12 * count(*))::DOUBLE AS floor_area, 1::BIGINT AS floors FROM customer GROUP BY 1""")
def write_exports(t):
    """Energy-model and audit documents in XML, told by what they hold."""
    m = document.tables(_documents(t))
    count = lambda tag: (F.size(F.split("body", f"<{tag}[ >]")) - 1).cast("bigint")
    g = writers.gbxml(m).select("model_id", count("Space").alias("spaces"), count("Surface").alias("walls"), (count("CartesianPoint") / 4).cast("bigint").alias("points"))
    b = writers.building_sync(m).select("model_id", F.regexp_extract("body", "<FloorAreaValue>([0-9.]+)<", 1).cast("double").alias("floor_area"), F.regexp_extract("body", "<FloorsAboveGrade>([0-9]+)<", 1).cast("bigint").alias("floors"))
    return g.join(b, "model_id")


@query("""SELECT 'export' AS role, r_regionkey::BIGINT AS file, length(r_name) + 1 AS bytes, sha256(r_name || chr(10)) AS sha256 FROM region""")
def write_manifest(t):
    """Bytes and checksums of exported files."""
    path = _text_files(t, t.region.select(F.col("r_regionkey").alias("file"), F.col("r_name").alias("value")), "export")
    return writers.manifest(t.spark, {"export": path}).select("role", F.regexp_extract("file", "file=([0-9]+)", 1).cast("bigint").alias("file"), "bytes", "sha256").where("sha256 is not null")


@query("""SELECT p_partkey::VARCHAR AS file, CASE WHEN p_partkey % 5 = 0 THEN 'missing' WHEN p_partkey % 7 = 0 THEN 'added' ELSE 'changed' END AS drift FROM part WHERE (p_partkey % 5 = 0) <> (p_partkey % 7 = 0) OR (p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 11 = 0)""")
def verify_manifest(t):
    """What was added, is missing or changed since a manifest."""
    k = F.col("p_partkey")
    recorded = t.part.where(k % 7 != 0).select(k.cast("string").alias("file"), F.sha2("p_name", 256).alias("sha256"))
    present = t.part.where(k % 5 != 0).select(k.cast("string").alias("file"), F.sha2(F.when(k % 11 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")), 256).alias("sha256"))
    return writers.drift(recorded, present)


@query("""SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'F and O again', count(*) FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def provided_detections(t):
    """Detections of stored, combined and filtered providers."""
    path = _place(t, "provided")
    t.orders.select(F.col("o_orderstatus").alias("label"), F.lit(0.9).alias("score")).write.parquet(path)
    stored = {"provider": "precomputed", "path": path}
    some = {"provider": "labeled", "inner": stored, "labels": ["F", "O"]}
    twice = providers.detect(t.spark, {"provider": "combined", "parts": [stored, some]}, release=True).groupBy("label").agg(F.count("*").alias("n"))
    one = providers.detect(t.spark, stored).groupBy("label").agg(F.count("*").alias("n"))
    extra = twice.join(one.withColumnRenamed("n", "m"), "label").agg(F.sum(F.col("n") - F.col("m")).alias("n"))
    return one.unionByName(extra.select(F.lit("F and O again").alias("label"), "n"))


@query("""SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def published(t):
    """What is put in place is what was accepted; what isn't accepted changes nothing."""
    path = _place(t, "published")
    rows = t.orders.select("o_orderpriority", "o_orderkey")
    if not writers.publish(rows, path, lambda written: written.count() == rows.count()) or writers.publish(rows.limit(1), path, lambda written: False):
        raise RuntimeError("publishing went wrong")
    return t.spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT count(*) AS n, round(sum(CASE WHEN c_custkey % 71 = 0 THEN -1 ELSE 1 END * (round(abs(c_acctbal), 0) + 10)), 3) AS area FROM customer) SELECT 'spaces' AS number, n::DOUBLE AS value, 'spaces' AS source FROM a UNION ALL SELECT 'floor_area_m2', area, 'spaces.area_m2' FROM a UNION ALL SELECT 'walls', (SELECT count(*) FROM supplier), 'walls' UNION ALL SELECT 'openings', (SELECT count(*) FROM orders), 'openings' UNION ALL SELECT 'errors', 1, 'report.severity' UNION ALL SELECT 'open_review_items', (SELECT count(*) FROM orders WHERE o_orderkey % 100 = 1), 'review.status'""")
def trust_report(t):
    """A report's numbers, each with where it comes from."""
    m = battery.model(t)
    return writers.trust_report(m, t.spark.createDataFrame([("E11", "error"), ("E10", "warn")], "check_id string, severity string"))


@query("""SELECT 0.125::DOUBLE AS volume_bias, (SELECT sum(CASE WHEN c_custkey % 83 = 0 THEN CASE WHEN c_custkey % 71 = 0 THEN -1 ELSE 1 END * (round(abs(c_acctbal), 0) + 10) ELSE 0 END) FROM customer) AS non_room_area""")
def convention_report(t):
    """How far stated conventions move the figures."""
    return writers.convention_report(battery.model(t))
