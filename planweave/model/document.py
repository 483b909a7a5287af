"""One row per model document, and the normalised tables that come out of it.

Documents state their version; older ones are brought forward, unknown ones are
refused.  Every fact keeps its provenance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "1.3"
KNOWN = ("1.0", "1.1", "1.2", "1.3")
_PROV = "struct<sheet_id: string, revision: int, method: string, confidence: double, bbox: array<double>, note: string>"
_OPENING = f"struct<id: string, tag: string, category: string, width_m: double, height_m: double, sill_m: double, head_m: double, host_facade: string, s_center_m: double, area_m2: double, provenance: {_PROV}, source_provenance: array<{_PROV}>>"
_SPACE = f"struct<name: string, number: string, level_id: string, polygon_m: array<array<double>>, area_m2: double, volume_m3: double, core_provenance: {_PROV}, openings: array<{_OPENING}>, zone_ids: array<string>>"
SCHEMA = (
    f"version string, name string, bearing_deg double, levels array<struct<id: string, name: string, elevation_z_m: double, wall_height_m: double>>, spaces map<string, {_SPACE}>, "
    f"envelope array<struct<id: string, level_id: string, facade: string, length_m: double, height_m: double, area_m2: double, u_si: double, construction: string, provenance: {_PROV}>>, "
    "zones map<string, struct<space_ids: array<string>, n_diffusers: bigint, unit: string>>, revision_log array<struct<seq: bigint, sheet_id: string, revision: bigint, action: string, note: string>>, "
    "review array<struct<id: string, kind: string, description: string, confidence: double, status: string, needs_review: boolean, acknowledged: boolean>>"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """model_id (the file) and the document, brought to the present version; an unknown version is an error."""
    d = spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("model_id", F.input_file_name())
    return migrate(d)


def migrate(d: DataFrame) -> DataFrame:
    """Before 1.3 openings had no list of sources: their provenance becomes its only entry."""
    checked = F.when(F.col("version").isin(*KNOWN), F.col("version")).otherwise(F.raise_error(F.concat(F.lit("unknown model version: "), F.coalesce("version", F.lit("null")))).cast("string"))
    seed = lambda o: o.withField("source_provenance", F.coalesce(o.source_provenance, F.when(o.provenance.isNotNull(), F.array(o.provenance)).otherwise(F.array().cast(f"array<{_PROV}>"))))
    spaces = F.transform_values("spaces", lambda k, s: s.withField("openings", F.transform(s.openings, seed)))
    d = d.withColumn("version", checked)
    return d.withColumn("spaces", F.when(F.col("version") != VERSION, spaces).otherwise(F.col("spaces"))).withColumn("version", F.when(F.col("version").isNotNull(), F.lit(VERSION)))


def tables(d: DataFrame) -> dict[str, DataFrame]:
    """Levels, spaces, openings, walls, zones, both bridges, the log and the review queue, keyed by model_id."""
    s = d.select("model_id", F.explode("spaces").alias("id", "s"))
    o = s.select("model_id", F.col("id").alias("space_id"), F.col("s.level_id").alias("level_id"), F.explode("s.openings").alias("o"))
    z = d.select("model_id", F.explode("zones").alias("id", "z"))
    w = d.select("model_id", F.inline("envelope"))
    return {
        "levels": d.select("model_id", F.inline("levels")),
        "spaces": s.select("model_id", "id", "s.*").withColumn("sheet_id", F.col("core_provenance.sheet_id")),
        "openings": o.select("model_id", "space_id", "level_id", "o.*").withColumn("sheet_id", F.col("provenance.sheet_id")),
        "walls": w.withColumn("sheet_id", F.col("provenance.sheet_id")),
        "zones": z.select("model_id", "id", "z.n_diffusers", "z.unit"),
        "zone_spaces": z.select("model_id", F.col("id").alias("zone_id"), F.explode("z.space_ids").alias("space_id")),
        "space_zones": s.select("model_id", F.col("id").alias("space_id"), F.explode("s.zone_ids").alias("zone_id")),
        "revision_log": d.select("model_id", F.inline("revision_log")),
        "review": d.select("model_id", F.inline("review")),
    }
