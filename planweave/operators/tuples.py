"""The n-tuple classifier as joins: counts by class, tuple and address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def thermometer(values: Column, thresholds: list[float]) -> Column:
    """Bits of each value, one for each threshold that it is above."""
    return F.flatten(F.transform(values, lambda x: F.array(*[(x > t).cast("int") for t in thresholds])))


def addresses(rows: DataFrame, id: str, bits: str, width: int, keep: list[str] = ()) -> DataFrame:
    """id, k, address: consecutive tuples of `width` bits as numbers."""
    at = lambda k: F.aggregate(F.slice(F.col(bits), k * width + 1, width), F.lit(0), lambda s, b: s * 2 + b)
    n = F.floor(F.size(bits) / width).cast("int")
    return rows.select(id, *keep, F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), at)).alias("k", "address"))


def fit(addressed: DataFrame, label: str) -> DataFrame:
    """label, k, address, n."""
    return addressed.groupBy(label, "k", "address").agg(F.count("*").alias("n"))


def predict(addressed: DataFrame, model: DataFrame, id: str, label: str, least: int = 1) -> DataFrame:
    """id, label, score: the class with most tuples seen at least `least` times, ties to the smaller label (bleaching raises `least`)."""
    hits = addressed.join(model.where(F.col("n") >= least), ["k", "address"]).groupBy(id, label).agg(F.count("*").alias("score"))
    w = Window.partitionBy(id).orderBy(F.desc("score"), label)
    return hits.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(id, label, "score")
