"""Schedules out of a drawing's own entities: tables, attributed blocks and embedded sheets, one table for each TABLE entity.

A drawing is a row (file, body): JSON with lists of entities.  What breaks an
entity's shape lowers its confidence to DEFECT and is noted; nothing is dropped
but what has no type.  Blocks and sheets go to the entity that their owner's
handle names, else to the drawing's first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Confidences by source (fixed values); with defects DEFECT at most.
TABLE, UNHANDLED_TABLE, BLOCK, BARE_BLOCK, SHEET, DEFECT = 0.95, 0.70, 0.90, 0.75, 0.60, 0.5
_DATA = "struct<name: string, headers: array<string>, rows: array<string>>"
DRAWING = (
    f"struct<table_entities: array<struct<layer: string, handle: string, type: string, entity_type: string, owner_handle: string, data: string>>, "
    "block_refs: array<struct<block_name: string, handle: string, owner_handle: string, owner: string, table_handle: string, x: string, y: string, z: string, attributes: string>>, "
    "block_defs: map<string, struct<name: string>>, ole_entities: array<struct<type: string, source_entity: string, data: string>>>"
)


def drawings(rows: DataFrame, file: str = "file", body: str = "body") -> DataFrame:
    """file, d: the parsed drawings; what is no drawing has nulls."""
    return rows.select(F.col(file).alias("file"), F.from_json(body, DRAWING).alias("d"))


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _note(*defects: tuple[Column, str]) -> Column:
    return F.concat_ws("; ", *[F.when(hit, F.lit(text)) for hit, text in defects])


def _sure(base: Column, note: Column) -> Column:
    return F.when(note != "", F.least(base, F.lit(DEFECT))).otherwise(base)


def owner_handle(b: Column) -> Column:
    """The handle of the entity that a block belongs to: the first of its three ways to say so."""
    return F.coalesce(_some(b.owner_handle), _some(b.owner), _some(b.table_handle), F.lit(""))


def table_entities(d: DataFrame) -> DataFrame:
    """file, place, handle, layer, entity_type, owner_handle, name, headers, rows (JSON), note, confidence of each table entity."""
    e = d.select("file", F.posexplode("d.table_entities").alias("place", "e"))
    data = F.coalesce(F.col("e.data"), F.lit("{}"))
    parsed = F.from_json(data, _DATA)
    e = e.withColumn("data", F.when(data.startswith("{"), parsed)).withColumn("note", _note((F.col("e").isNull(), "entity payload is not a mapping"), (~data.startswith("{"), "table data is not a mapping")))
    handle = F.coalesce("e.handle", F.lit(""))
    return e.select(
        "file", "place", handle.alias("handle"), F.coalesce("e.layer", F.lit("")).alias("layer"), F.coalesce("e.type", "e.entity_type", F.lit("")).alias("entity_type"), F.coalesce("e.owner_handle", F.lit("")).alias("owner_handle"),
        F.coalesce("data.name", F.lit("")).alias("name"), F.col("data.headers").alias("headers"), F.col("data.rows").alias("rows"), "note", _sure(F.when(handle != "", TABLE).otherwise(UNHANDLED_TABLE), F.col("note")).alias("confidence"),
    )


def block_schedules(d: DataFrame) -> DataFrame:
    """file, place, owner, block_name, handle, tags, values, x, y, z, note, confidence of each attributed block."""
    b = d.select("file", F.col("d.block_defs").alias("defs"), F.posexplode("d.block_refs").alias("place", "b"))
    attributes = F.from_json(F.col("b.attributes"), "array<struct<tag: string, value: string>>")
    axis = lambda a: F.coalesce(F.col(f"b.{a}").try_cast("double"), F.lit(0.0)).alias(a)
    wrong = [(F.col(f"b.{a}").isNotNull() & F.col(f"b.{a}").try_cast("double").isNull(), f"non-numeric {a} coordinate") for a in "xyz"]
    there = F.filter(F.coalesce(attributes, F.array().cast("array<struct<tag: string, value: string>>")), lambda x: x.isNotNull())
    b = b.withColumn("there", there).withColumn("note", _note((F.col("defs").isNull(), "block definitions unavailable"), (F.col("b").isNull(), "block reference is not a mapping"), *wrong, (F.col("b.attributes").isNotNull() & ~F.col("b.attributes").startswith("["), "attributes is not a list")))
    values = F.transform("there", lambda x: F.coalesce(x.value, F.lit("")))
    name = F.coalesce(F.try_element_at(F.col("defs"), F.coalesce("b.block_name", F.lit("")))["name"], F.col("b.block_name"), F.lit(""))
    return b.select(
        "file", "place", owner_handle(F.col("b")).alias("owner"), name.alias("block_name"), F.coalesce("b.handle", F.lit("")).alias("handle"), F.transform("there", lambda x: F.coalesce(x.tag, F.lit(""))).alias("tags"), values.alias("values"), *[axis(a) for a in "xyz"],
        "note", _sure(F.when(F.size("there") > 0, BLOCK).otherwise(BARE_BLOCK), F.col("note")).alias("confidence"),
    )


def sheet_schedules(d: DataFrame) -> DataFrame:
    """file, place, owner, kind, headers, rows (JSON), confidence of each embedded sheet that states its type."""
    o = d.select("file", F.posexplode("d.ole_entities").alias("place", "o")).where(F.coalesce("o.type", F.lit("")) != "")
    data = F.when(F.coalesce("o.data", F.lit("")).startswith("{"), F.from_json("o.data", _DATA))
    return o.select("file", "place", F.coalesce("o.source_entity", F.lit("")).alias("owner"), F.col("o.type").alias("kind"), data["headers"].alias("headers"), data["rows"].alias("rows"), F.lit(SHEET).alias("confidence"))


def schedule_cells(d: DataFrame) -> DataFrame:
    """file, table, row, col, value, method, confidence of every cell; `table` is the entity's place, -1 in a drawing without one.

    A table's rows come first, then its blocks' and its sheets', each in their
    order.  A row that is no list is kept as a single cell and trusted less.
    """
    tables = table_entities(d).where("entity_type = 'TABLE'")
    first = tables.groupBy("file").agg(F.min("place").alias("first"))
    by_handle = tables.where("handle <> ''").groupBy("file", "handle").agg(F.max("place").alias("owned"))

    def owned(t: DataFrame) -> DataFrame:
        j = t.join(by_handle.withColumnRenamed("handle", "owner"), ["file", "owner"], "left").join(first, "file", "left")
        return j.withColumn("table", F.coalesce("owned", "first", F.lit(-1)))

    def listed(t: DataFrame, kind: int, method: str) -> DataFrame:
        r = t.select("file", "table", "place", "confidence", F.posexplode("rows").alias("at", "row"))
        cells = F.when(F.col("row").startswith("["), F.from_json("row", "array<string>")).when(F.col("row").isNotNull(), F.array("row")).otherwise(F.array().cast("array<string>"))
        sure = F.when(F.coalesce(F.col("row").startswith("["), F.lit(False)), F.col("confidence")).otherwise(F.least("confidence", F.lit(DEFECT)))
        return r.select("file", "table", F.lit(kind).alias("kind"), "place", "at", cells.alias("cells"), F.lit(method).alias("method"), sure.alias("confidence"))

    own = listed(tables.withColumn("table", F.col("place")), 0, "dwg_table_entity")
    blocks = owned(block_schedules(d)).where((F.upper("block_name").contains("SCHEDULE")) | (F.size("tags") > 0))
    blocks = blocks.select("file", "table", F.lit(1).alias("kind"), "place", F.lit(0).alias("at"), F.col("values").alias("cells"), F.lit("dwg_block_schedule").alias("method"), "confidence")
    sheets = listed(owned(sheet_schedules(d)), 2, "ole_spreadsheet")
    rows = own.unionByName(blocks).unionByName(sheets)
    rows = rows.withColumn("row", F.row_number().over(Window.partitionBy("file", "table").orderBy("kind", "place", "at")) - 1)
    return rows.select("file", "table", "row", F.posexplode("cells").alias("col", "value"), "method", "confidence")


def schedule_tables(d: DataFrame) -> DataFrame:
    """file, table, name, headers, n_rows, confidence of every schedule: a sheet's headers over its blocks' tags over none."""
    tables = table_entities(d).where("entity_type = 'TABLE'").select("file", F.col("place").alias("table"), "name", "headers", "note", "confidence")
    rows = schedule_cells(d).groupBy("file", "table").agg((F.max("row") + 1).alias("n_rows"), F.min("confidence").alias("least"))
    j = tables.join(rows, ["file", "table"], "full_outer")
    return j.select("file", "table", F.coalesce("name", F.lit("")).alias("name"), F.array_join(F.coalesce("headers", F.array().cast("array<string>")), ",").alias("headers"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when((F.coalesce("note", F.lit("")) != "") | (F.coalesce("least", F.lit(1.0)) <= DEFECT), F.lit(DEFECT)).otherwise(F.when(F.col("confidence").isNotNull(), F.lit(TABLE)).otherwise(F.lit(BLOCK))).alias("confidence"))
