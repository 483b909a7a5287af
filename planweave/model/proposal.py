"""Proposals: typed building sketches, checked and mapped to the model's tables with a reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.functions import geometry as G

SCHEMA = (
    "schema string, version string, units string, id string, levels array<struct<id: string, name: string, elevation_m: double, height_m: double, "
    "walls: array<struct<id: string, points: array<array<double>>, closed: boolean, thickness_m: double, height_m: double, openings: array<struct<id: string, kind: string, offset_m: double, sill_m: double, width_m: double, height_m: double>>>>, "
    "spaces: array<struct<number: string, name: string, polygon: array<array<double>>, usage: string>>, slabs: array<struct<id: string, polygon: array<array<double>>, thickness_m: double, base_offset_m: double>>>>"
)
UNITS = ("m",)
KINDS = ("window", "door", "void")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path).withColumn("file", F.input_file_name())


def _parts(d: DataFrame) -> dict[str, DataFrame]:
    lv = d.select("file", F.explode("levels").alias("l"))
    w = lv.select("file", F.col("l.id").alias("level_id"), F.col("l.height_m").alias("level_height"), F.explode("l.walls").alias("w"))
    return {
        "levels": lv.select("file", "l.id", "l.name", "l.elevation_m", "l.height_m"),
        "walls": w.select("file", "level_id", "level_height", "w.*"),
        "openings": w.select("file", "level_id", F.col("w.id").alias("wall_id"), F.coalesce("w.height_m", "level_height").alias("wall_height"), F.col("w.points").alias("points"), F.col("w.closed").alias("closed"), F.explode("w.openings").alias("o")).select("*", "o.*").drop("o"),
        "spaces": lv.select("file", F.col("l.id").alias("level_id"), F.col("l.height_m").alias("level_height"), F.explode("l.spaces").alias("s")).select("file", "level_id", "level_height", "s.*"),
    }


def _length(points: str, closed: str) -> F.Column:
    """The length of an open or closed line of points."""
    n = F.size(points)
    last = F.hypot(F.element_at(points, -1)[0] - F.col(points)[0][0], F.element_at(points, -1)[1] - F.col(points)[0][1])
    return G.perimeter(points) - F.when(F.coalesce(F.col(closed), F.lit(False)) | (n < 3), F.when(n < 3, last).otherwise(0.0)).otherwise(last)


def diagnostics(d: DataFrame) -> DataFrame:
    """file, path, problem of everything that keeps a proposal from being mapped."""
    p = _parts(d)
    found = [
        d.where(F.coalesce(~F.col("units").isin(*UNITS), F.lit(True))).select("file", F.lit("units").alias("path"), F.lit("unknown unit").alias("problem")),
        d.where(F.size(F.coalesce("levels", F.array().cast(d.schema["levels"].dataType))) == 0).select("file", F.lit("levels"), F.lit("no levels")),
        p["levels"].where("height_m is null or height_m <= 0").select("file", F.concat(F.lit("levels/"), "id"), F.lit("height must be above 0")),
        p["walls"].where(F.size(F.coalesce("points", F.array().cast("array<array<double>>"))) < 2).select("file", F.concat(F.lit("walls/"), "id"), F.lit("needs two points")),
        p["spaces"].where(F.coalesce(G.area("polygon") <= 1e-6, F.lit(True))).select("file", F.concat(F.lit("spaces/"), "number"), F.lit("no area")),
        p["openings"].where(F.coalesce(~F.col("kind").isin(*KINDS), F.lit(True))).select("file", F.concat(F.lit("openings/"), "id"), F.lit("unknown kind")),
        p["openings"].where("width_m <= 0 or height_m <= 0 or sill_m < 0").select("file", F.concat(F.lit("openings/"), "id"), F.lit("size out of range")),
        p["openings"].where(F.col("sill_m") + F.col("height_m") > F.col("wall_height") + 1e-6).select("file", F.concat(F.lit("openings/"), "id"), F.lit("higher than its wall")),
        p["openings"].where(F.col("offset_m") + F.col("width_m") > _length("points", "closed") + 1e-6).select("file", F.concat(F.lit("openings/"), "id"), F.lit("beyond its wall")),
    ]
    return reduce(DataFrame.union, found)


def mapped(d: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables of the proposals without problems; file, proposed, mapped, reconciles: spaces by proposal)."""
    bad = diagnostics(d).select("file").distinct()
    p = _parts(d.join(bad, "file", "left_anti"))
    a = G.area("polygon")
    spaces = p["spaces"].select("file", F.concat_ws("-", "level_id", "number").alias("id"), "level_id", "name", "number", F.col("polygon").alias("polygon_m"), a.alias("area_m2"), (a * F.col("level_height")).alias("volume_m3"))
    walls = p["walls"].select("file", "id", "level_id", _length("points", "closed").alias("length_m"), F.coalesce("height_m", "level_height").alias("height_m"))
    openings = p["openings"].select("file", "id", "level_id", "wall_id", F.col("kind").alias("category"), "width_m", "height_m", "sill_m", (F.col("sill_m") + F.col("height_m")).alias("head_m"), (F.col("width_m") * F.col("height_m")).alias("area_m2"))
    n = lambda t, c: t.groupBy("file").agg(F.count("*").alias(c))
    r = n(_parts(d)["spaces"], "proposed").join(n(spaces, "mapped"), "file", "left").na.fill(0, ["mapped"])
    return {"levels": p["levels"], "spaces": spaces, "walls": walls, "openings": openings}, r.withColumn("reconciles", F.col("proposed") == F.col("mapped"))
