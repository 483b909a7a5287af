"""Readers of schedules, detections, logs, annotations, models and weather-of-simulation outputs.

Text formats go through Spark's readers with explicit schemas; rows that break
their contract come back as rejects, not as missing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planweave.functions.text import normalize_tag
from planweave.operators.ordered import running_sum
from planweave.operators.takeoff import last_wins

SCHEDULE = "tag string, category string, width_m string, height_m string, note string, u_factor string, shgc string, vt string"
LIGHTING = "tag string, description string, lamp_type string, watts string, category string, note string"
DETECTIONS = "image string, width int, height int, preds array<struct<cls: int, conf: double, x0: double, y0: double, x1: double, y1: double>>, _corrupt_record string"
FEEDBACK = "kind string, context map<string,string>, at string"
FLOORPLAN = "image struct<bytes: binary, path: string>, image_id bigint, objects struct<bbox: array<array<double>>, category: array<string>>"


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headed CSV by column name, with what it has of the schema's columns; rows are numbered as they stand."""
    raw = spark.read.option("header", True).csv(path)
    names = {c.strip().lower(): c for c in raw.columns}
    want = T.StructType.fromDDL(schema).fieldNames()
    rows = raw.select(*[F.col(f"`{names[c]}`").alias(c) if c in names else F.lit(None).cast("string").alias(c) for c in want])
    return rows.withColumn("row", F.monotonically_increasing_id())  # order within a file, which one task reads in order


def window_schedule(spark: SparkSession, path: str) -> DataFrame:
    """tag, category (blank: window), width_m, height_m and the rest, the last row of a tag; sizes that are no numbers are null."""
    rows = _csv(spark, path, SCHEDULE)
    num = ("width_m", "height_m", "u_factor", "shgc", "vt")
    rows = rows.select(normalize_tag("tag").alias("tag"), F.coalesce(F.nullif(F.lower(F.trim("category")), F.lit("")), F.lit("window")).alias("category"), *[F.col(c).try_cast("double").alias(c) for c in num], "note", "row")
    return last_wins(rows.where("tag <> ''"), ["tag"], [F.col("row")]).drop("row")


def lighting_schedule(spark: SparkSession, path: str) -> DataFrame:
    """key (normalised), tag as stated, description, lamp_type, watts; the last row of a key."""
    rows = _csv(spark, path, LIGHTING).withColumn("key", normalize_tag("tag")).withColumn("watts", F.col("watts").try_cast("double"))
    return last_wins(rows.where("key <> ''"), ["key"], [F.col("row")]).select("key", "tag", "description", "lamp_type", "watts", "category", "note")


def detections(spark: SparkSession, path: str, labels: dict[int, str], source: str) -> tuple[DataFrame, DataFrame]:
    """(label, score, box, image, source of each detection; files that break the contract with why)."""
    raw = spark.read.schema(DETECTIONS).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path).withColumn("file", F.input_file_name())
    why = F.when(F.col("_corrupt_record").isNotNull(), F.lit("not JSON of the contract")).when(F.col("image").isNull(), F.lit("no image")).when(F.col("preds").isNull(), F.lit("no preds"))
    raw = raw.withColumn("reason", why)
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    p = raw.where("reason is null").select("image", F.explode("preds").alias("p"))
    good = p.select("image", F.coalesce(F.try_element_at(names, "p.cls"), F.col("p.cls").cast("string")).alias("label"), F.col("p.conf").alias("score"), F.struct("p.x0", "p.y0", "p.x1", "p.y1").alias("box"), F.lit(source).alias("source"))
    return good, raw.where("reason is not null").select("file", "reason")


def floorplan_objects(spark: SparkSession, path: str, skip: tuple[str, ...] = ("wall", "background"), size: float = 1.0) -> DataFrame:
    """image_id, category and box of each object, boxes scaled from thousandths; only those two columns are read."""
    have, want = spark.read.parquet(path).schema, T.StructType.fromDDL(FLOORPLAN)
    for name in ("image_id", "objects"):
        if name not in have.fieldNames() or have[name].dataType.simpleString() != want[name].dataType.simpleString():
            raise TypeError(f"{path}: column {name} is missing or of another type")
    rows = spark.read.parquet(path).select("image_id", F.explode(F.arrays_zip("objects.category", "objects.bbox")).alias("o"))
    b = lambda i: (F.greatest(F.lit(0.0), F.least(F.lit(1000.0), F.col("o.bbox")[i])) * size / 1000).alias(("x0", "y0", "x1", "y1")[i])
    return rows.where(~F.col("o.category").isin(*skip)).select("image_id", F.col("o.category").alias("category"), F.struct(*[b(i) for i in range(4)]).alias("box"))


def feedback(spark: SparkSession, path: str) -> DataFrame:
    """Events of a JSON lines log; malformed lines are skipped."""
    return spark.read.schema(FEEDBACK).option("mode", "DROPMALFORMED").json(path).where("kind is not null")


def xml_boxes(spark: SparkSession, path: str, most_mb: int = 50) -> DataFrame:
    """file, label, x0, y0, x1, y1 of every object of annotation files; larger files are left out by their size."""
    docs = spark.read.format("binaryFile").load(path).where(F.col("length") <= most_mb << 20)
    text = docs.select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("x"))
    get = lambda tag: F.xpath("x", F.lit(f"//object/{tag}/text()"))
    parts = F.arrays_zip(*[get(p).alias(n) for p, n in (("name", "label"), ("bndbox/xmin", "x0"), ("bndbox/ymin", "y0"), ("bndbox/xmax", "x1"), ("bndbox/ymax", "y1"))])
    rows = text.select("file", F.explode(parts).alias("o"))
    return rows.select("file", F.col("o.label").alias("label"), *[F.col(f"o.{c}").try_cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])


def simulation_log(spark: SparkSession, path: str) -> DataFrame:
    """completed, warnings, severe of an error log of a simulation run."""
    t = spark.read.text(path)
    return t.agg(F.coalesce(F.bool_or(F.col("value").contains("Completed Successfully")), F.lit(False)).alias("completed"), F.count_if(F.col("value").rlike(r"\*\* Warning \*\*")).alias("warnings"), F.count_if(F.col("value").rlike(r"\*\* Severe +\*\*")).alias("severe"))


def continuation_rows(rows: DataFrame, key: str, order: str, text: list[str]) -> DataFrame:
    """Rows without a key go on with the one before: their texts are joined by spaces."""
    r = running_sum(rows, [order], F.when(F.coalesce(F.trim(F.col(key)), F.lit("")) != "", 1).otherwise(0).cast("bigint"), "_g")
    joined = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("")).alias("t")))), lambda s: s.t), " ").alias(c) for c in text]
    out = r.groupBy("_g").agg(F.first(F.nullif(F.trim(F.col(key)), F.lit("")), ignorenulls=True).alias(key), F.min(order).alias(order), *joined)
    return out.select(key, order, *[F.trim(F.regexp_replace(c, r"\s+", " ")).alias(c) for c in text])


def without_repeated_headers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that say the header again go."""
    same = None
    for c in columns:
        hit = F.coalesce(F.upper(F.trim(F.col(c))) == c.upper(), F.lit(False))
        same = hit if same is None else same & hit
    return rows.where(~same)


def workbook(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, row, col, value of all cells of XLSX files, one file per task row at a time."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import re
        import zipfile
        from xml.etree import ElementTree as X

        import pandas as pd

        ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
        for pdf in batches:
            for at, content in zip(pdf["path"], pdf["content"]):
                z = zipfile.ZipFile(io.BytesIO(content))
                shared = [] if "xl/sharedStrings.xml" not in z.namelist() else ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in X.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
                links = {r.get("Id"): r.get("Target") for r in X.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
                out = []
                for s in X.fromstring(z.read("xl/workbook.xml")).find("m:sheets", ns):
                    target = links[s.get(f"{{{ns['r']}}}id")].lstrip("/")
                    sheet = X.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
                    for c in sheet.iter(f"{{{ns['m']}}}c"):
                        v, inline = c.find("m:v", ns), c.find("m:is", ns)
                        value = "".join(t.text or "" for t in inline.iter(f"{{{ns['m']}}}t")) if inline is not None else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                        letters, row = re.fullmatch(r"([A-Z]+)([0-9]+)", c.get("r")).groups()
                        col = 0
                        for ch in letters:
                            col = col * 26 + ord(ch) - 64
                        if value is not None:
                            out.append((at, s.get("name"), int(row), col, value))
                yield pd.DataFrame(out, columns=["file", "sheet", "row", "col", "value"])

    return files.mapInPandas(run, "file string, sheet string, row int, col int, value string")


def sheet_table(cells: DataFrame, sheet: str) -> DataFrame:
    """The rows of a sheet under its first row's headers, as maps: row, cells."""
    c = cells.where(F.col("sheet") == sheet)
    head = c.where("row = 1").select("file", "col", F.trim("value").alias("name"))
    body = c.where("row > 1").join(head, ["file", "col"])
    return body.groupBy("file", "row").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("cells"))


def sqlite_tables(spark: SparkSession, path: str, statement: str, schema: str) -> DataFrame:
    """The rows of a SELECT over SQLite files, file by file, values cast to the schema by name."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches):
        import sqlite3

        import pandas as pd

        for pdf in batches:
            for at, content in zip(pdf["path"], pdf["content"]):
                db = sqlite3.connect(":memory:")
                db.deserialize(content)
                rows = [(at, *r) for r in db.execute(statement)]
                db.close()
                yield pd.DataFrame(rows, columns=["file", *names])

    return files.mapInPandas(run, f"file string, {schema}")


def archcad_primitives(spark: SparkSession, path: str) -> DataFrame:
    """file, kind, points of the vector primitives of JSON drawings; circles and arcs as their centre and radius."""
    schema = "entities array<struct<type: string, start: array<double>, end: array<double>, center: array<double>, radius: double, points: array<array<double>>, semantic: string, instance: string>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.input_file_name().alias("file"), F.explode("entities").alias("e"))
    points = F.when(F.upper("e.type") == "LINE", F.array("e.start", "e.end")).when(F.upper("e.type").isin("CIRCLE", "ARC", "ELLIPSE"), F.array("e.center", F.array(F.col("e.radius"), F.lit(0.0)))).otherwise(F.col("e.points"))
    return rows.select("file", F.upper("e.type").alias("kind"), points.alias("points"), F.col("e.semantic").alias("category"))


def legend_tags(spark: SparkSession, path: str, kinds: list[str], schema: str) -> DataFrame:
    """description (normalised), kind of a side file of legend tags; another schema or an unknown kind is an error."""
    from planweave.functions.text import normalize_name

    d = spark.read.schema("schema string, tags map<string,string>").option("multiLine", True).json(path)
    checked = F.when(F.col("schema") == schema, F.col("tags")).otherwise(F.raise_error(F.concat(F.lit("another schema of legend tags: "), F.coalesce("schema", F.lit("none")))).cast("map<string,string>"))
    rows = d.select(F.explode(checked).alias("description", "kind"))
    known = F.when(F.col("kind").isin(*kinds), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown class: "), F.coalesce("kind", F.lit("null")))).cast("string"))
    return rows.select(normalize_name("description").alias("description"), known.alias("kind"))


SHEET = "page_number int, width_pt double, height_pt double, kind string, primitives array<struct<kind: string, segments: array<array<array<double>>>, bbox: array<double>, stroke_width: double, layer: string>>, text array<struct<text: string, bbox: array<double>>>, images array<struct<bbox: array<double>>>"


def sheets(spark: SparkSession, path: str) -> DataFrame:
    """file and the ingested sheets under a path, with their schema; files that are no sheet have no page number."""
    return spark.read.schema(SHEET).option("multiLine", True).json(path).withColumn("file", F.input_file_name())


def sheet_index(pages: DataFrame) -> DataFrame:
    """file, page_number, number, discipline, kind, level of each sheet: the lowest, rightmost text that is a sheet number, and the tallest that reads as a title."""
    from planweave.functions import text as X

    t = pages.select("file", "page_number", F.explode("text").alias("t")).select("file", "page_number", "t.text", "t.bbox")
    n = t.withColumn("s", X.sheet_number("text")).where("s is not null").groupBy("file", "page_number").agg(F.max_by("s", F.struct(F.col("bbox")[3], F.col("bbox")[2], "text")).alias("s"))
    title = t.withColumn("kind", X.sheet_type("text")).withColumn("level", X.level_of_title("text")).where("kind is not null or level is not null")
    title = title.groupBy("file", "page_number").agg(F.max_by(F.struct("kind", "level"), F.struct(F.round(F.col("bbox")[3] - F.col("bbox")[1], 1), F.col("bbox")[3], "text")).alias("k"))
    return pages.select("file", "page_number").join(n, ["file", "page_number"], "left").join(title, ["file", "page_number"], "left").select("file", "page_number", "s.number", "s.discipline", "k.kind", "k.level")
