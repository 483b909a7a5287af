"""Exports of a model and the records that go with them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.checks import rules
from planweave.functions import geometry as G


def canonical_json(d: DataFrame) -> DataFrame:
    """model_id, body, sha256 of each document."""
    body = F.to_json(F.struct(*[c for c in d.columns if c != "model_id"]))
    return d.select("model_id", body.alias("body")).withColumn("sha256", F.sha2("body", 256))


def write_json(d: DataFrame, path: str) -> None:
    d.write.mode("overwrite").json(path)


def _e(name: str, *inner, **attributes) -> F.Column:
    """An element as text; null parts vanish."""
    attr = [F.concat(F.lit(f' {k}="'), F.regexp_replace(F.regexp_replace(F.regexp_replace(v.cast("string"), "&", "&amp;"), "<", "&lt;"), '"', "&quot;"), F.lit('"')) for k, v in attributes.items()]
    return F.concat(F.lit(f"<{name}"), *[F.coalesce(a, F.lit("")) for a in attr], F.lit(">"), *[F.coalesce(i, F.lit("")) for i in inner], F.lit(f"</{name}>"))


def _text(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c.cast("string"), "&", "&amp;"), "<", "&lt;")


def gbxml(t: dict[str, DataFrame]) -> DataFrame:
    """model_id, body: storeys, spaces with area, volume and floor polygon, and walls as surfaces.

    Plan y runs down on drawings; here it points north, so polygons are turned over.
    """
    loop = F.array_join(F.transform(G.counter_clockwise(F.transform("polygon_m", lambda v: F.array(v[0], -v[1]))), lambda v: F.concat(F.lit("<CartesianPoint>"), F.concat(F.lit("<Coordinate>"), v[0].cast("string"), F.lit("</Coordinate><Coordinate>"), v[1].cast("string"), F.lit("</Coordinate>")), F.lit("</CartesianPoint>"))), "")
    space = _e("Space", _e("Name", _text("name")), _e("Area", _text("area_m2")), _e("Volume", _text("volume_m3")), _e("PlanarGeometry", _e("PolyLoop", loop)), id=F.col("id"), buildingStoreyIdRef=F.col("level_id"))
    storey = _e("BuildingStorey", _e("Name", _text("name")), _e("Level", _text("elevation_z_m")), id=F.col("id"))
    wall = _e("Surface", _e("Area", _text(F.coalesce("area_m2", F.col("length_m") * F.col("height_m")))), id=F.col("id"), surfaceType=F.lit("ExteriorWall"))
    joined = lambda rows, x, name: rows.select("model_id", "id", x.alias("x")).groupBy("model_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "x"))), lambda s: s.x), "").alias(name))
    j = joined(t["spaces"], space, "spaces").join(joined(t["levels"], storey, "storeys"), "model_id", "full_outer").join(joined(t["walls"], wall, "walls"), "model_id", "full_outer")
    building = _e("Building", F.col("storeys"), F.col("spaces"), id=F.lit("building"), buildingType=F.lit("Unknown"))
    body = _e("gbXML", _e("Campus", building, F.col("walls"), id=F.lit("campus")), version=F.lit("8.01"), lengthUnit=F.lit("Meters"), areaUnit=F.lit("SquareMeters"), volumeUnit=F.lit("CubicMeters"))
    return j.select("model_id", body.alias("body"))


def building_sync(t: dict[str, DataFrame]) -> DataFrame:
    """model_id, body: a site with floor area and number of floors."""
    g = t["spaces"].groupBy("model_id").agg(F.round(F.sum("area_m2"), 3).alias("area"), F.count_distinct("level_id").alias("floors"))
    area = _e("FloorAreas", _e("FloorArea", _e("FloorAreaType", F.lit("Gross")), _e("FloorAreaValue", _text("area"))))
    body = _e("BuildingSync", _e("Facilities", _e("Facility", _e("Sites", _e("Site", _e("Buildings", _e("Building", area, _e("FloorsAboveGrade", _text("floors")))))))), version=F.lit("2.4.0"))
    return g.select("model_id", body.alias("body"))


def manifest(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """role, file, bytes, sha256 of every file under the paths."""
    out = None
    for role, path in paths.items():
        m = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.lit(role).alias("role"), F.col("path").alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        out = m if out is None else out.unionByName(m)
    return out


def drift(recorded: DataFrame, present: DataFrame) -> DataFrame:
    """file, drift: added, missing or changed since the manifest."""
    j = recorded.select("file", F.col("sha256").alias("a")).join(present.select("file", F.col("sha256").alias("b")), "file", "full_outer")
    return j.withColumn("drift", F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "changed")).where("drift is not null").select("file", "drift")


def publish(df: DataFrame, path: str, accept: Callable[[DataFrame], bool]) -> bool:
    """Write beside the target, look at what was written, and put it in place only if it is accepted."""
    spark = df.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    fs = fs_path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not accept(spark.read.parquet(staged)):
        fs.delete(fs_path(staged), True)
        return False
    old = fs_path(f"{staged}.old")
    if fs.exists(fs_path(path)):
        fs.rename(fs_path(path), old)
    fs.rename(fs_path(staged), fs_path(path))
    fs.delete(old, True)
    return True


def gated_publish(model: rules.Model, exports: DataFrame, path: str) -> bool:
    """publish() behind the export gate."""
    report = rules.run(model)
    if not rules.gate(report, model.review).first()["may_export"]:
        return False
    return publish(exports, path, lambda written: written.count() == exports.count())


def trust_report(model: rules.Model, report: DataFrame) -> DataFrame:
    """number, value, source: the report's numbers, each with the table and field it comes from."""
    rows = [("spaces", model.spaces, F.count("*"), "spaces"), ("floor_area_m2", model.spaces, F.round(F.sum("area_m2"), 3), "spaces.area_m2"), ("walls", model.walls, F.count("*"), "walls"), ("openings", model.openings, F.count("*"), "openings"), ("errors", report, F.count_if(F.col("severity") == "error"), "report.severity"), ("open_review_items", model.review, F.count_if(F.col("status") == "open"), "review.status")]
    out = None
    for name, t, agg, source in rows:
        one = t.agg(agg.cast("double").alias("value")).select(F.lit(name).alias("number"), "value", F.lit(source).alias("source"))
        out = one if out is None else out.unionByName(one)
    return out


def convention_report(model: rules.Model) -> DataFrame:
    """volume_bias, non_room_area, n_defaulted: how far stated conventions move the figures."""
    c = model.conventions.agg((F.sum("exterior_m3") / F.nullif(F.sum("interior_m3"), F.lit(0.0)) - 1).alias("volume_bias"))
    s = model.spaces.agg(F.sum(F.when(F.col("poly_type") != "room", F.col("area_m2")).otherwise(0.0)).alias("non_room_area"))
    return c.crossJoin(s)
