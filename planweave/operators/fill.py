"""Fill what is missing, never overwrite; look up by key, band or breakpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_missing(rows: DataFrame, defaults: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with nulls filled by key and a `filled` list of column names, counts: column, filled, kept, unmatched)."""
    d = defaults.select(F.col(key), F.lit(True).alias("_known"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = rows.join(d, key, "left")
    filled = F.filter(F.array(*[F.when(F.col(c).isNull() & F.col(f"_{c}").isNotNull(), F.lit(c)) for c in columns]), lambda x: x.isNotNull())
    out = j.withColumn("filled", filled)
    counts = out.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.array_contains("filled", c).alias("f"), F.col(c).isNotNull().alias("k"), F.col("_known").isNull().alias("u")) for c in columns])).alias("m")).select("m.*")
    counts = counts.groupBy("column").agg(F.count_if("f").alias("filled"), F.count_if("k").alias("kept"), F.count_if(F.col("u") & ~F.col("k")).alias("unmatched"))
    return out.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in rows.columns], "filled"), counts


def pick_band(rows: DataFrame, bands: DataFrame, value: str, top: str = "upper", out: str = "band") -> DataFrame:
    """rows with the least band whose upper bound isn't below the value; above all bands the last one; null stays null."""
    b = bands.agg(F.array_sort(F.collect_list(F.struct(F.col(top).alias("u"), F.col(out).alias("b")))).alias("_bands"))
    j = rows.crossJoin(F.broadcast(b))  # a table of bands is one small row
    fits = F.filter("_bands", lambda x: x.u >= F.col(value))
    return j.withColumn(out, F.when(F.col(value).isNotNull(), F.when(F.size(fits) > 0, fits[0].b).otherwise(F.element_at("_bands", -1).b))).drop("_bands")


def interpolate(value: Column, points: list[tuple[float, float]]) -> Column:
    """Straight lines between breakpoints, flat outside; null stays null."""
    pts = sorted(points)
    out = F.when(value <= pts[0][0], F.lit(float(pts[0][1])))
    for (x0, y0), (x1, y1) in zip(pts, pts[1:]):
        out = out.when(value <= x1, y0 + (value - x0) * (y1 - y0) / (x1 - x0))
    return F.when(value.isNotNull(), out.otherwise(F.lit(float(pts[-1][1]))))


def lookup_with_fallback(rows: DataFrame, table: DataFrame, key: str, value: str, fallback: str) -> DataFrame:
    """rows with value by key, or that of the fallback key; `exact` says which."""
    t = table.select(F.col(key), F.col(value).alias("_v"))
    f = table.where(F.col(key) == fallback).agg(F.max(value).alias("_f"))
    j = rows.join(t, key, "left").crossJoin(F.broadcast(f))
    return j.withColumn(value, F.coalesce("_v", "_f")).withColumn("exact", F.col("_v").isNotNull()).drop("_v", "_f")


def precedence(*layers: Column) -> Column:
    """The first value that is there: explicit over project over default."""
    return F.coalesce(*layers)


def spaces_by_thresholds(area: Column, cooling: Column, heating: Column, cool_least: float, heat_least: float, heat_semi: float) -> Column:
    """conditioned, semiheated, unconditioned or review, by capacity per area; unknown capacities only matter where they could decide."""
    per = lambda x: x / F.nullif(area, F.lit(0.0))
    c, h = per(cooling), per(heating)
    return (
        F.when(area.isNull() | (area <= 0), F.lit("review"))
        .when((c >= cool_least) | (h >= heat_least), F.lit("conditioned"))
        .when(c.isNull() | h.isNull(), F.lit("review"))
        .when(h >= heat_semi, F.lit("semiheated"))
        .otherwise(F.lit("unconditioned"))
    )
