"""Sheet coordinates to building coordinates, and openings seen more than once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions import geometry as G


UNTAGGED = "@untagged"


def opening_place(o) -> F.Column:
    """The centre of an opening along its facade: as stated, else the middle of its interval (a column of structs)."""
    return F.coalesce(o.s_center_m, (o.host_interval_m[0] + o.host_interval_m[1]) / 2)


def opening_height(o, elevation) -> F.Column:
    """struct(z0, z1) of an opening, null without a sill; the top is its head, else its sill and height."""
    top = F.coalesce(o.head_m, o.sill_m + F.coalesce(o.height_m, F.lit(0.0)))
    return F.when(o.sill_m.isNotNull(), F.struct((elevation + o.sill_m).alias("z0"), (elevation + top).alias("z1")))


def opening_group(o) -> F.Column:
    """What openings must share to be one: facade, tag or none, category."""
    return F.struct(o.host_facade.alias("facade"), F.coalesce(F.nullif(o.tag, F.lit("")), F.lit(UNTAGGED)).alias("tag"), o.category.alias("category"))


def wall_area(area, length, height) -> F.Column:
    """A wall segment's own area, else its length times its height."""
    return F.coalesce(area, length * height)


def fit_affine(ties: DataFrame, by: list[str]) -> DataFrame:
    """by, a..f, rms, n of x' = a x + b y + c, y' = d x + e y + f, by least squares over tie points (x, y, tx, ty);
    nulls for fewer than three points or points on one line."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ties.select(*by).schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.column_stack([pdf["x"], pdf["y"], np.ones(len(pdf))])
        t = pdf[["tx", "ty"]].to_numpy(float)
        if len(pdf) < 3 or np.linalg.matrix_rank(m - m.mean(axis=0)) < 2:
            out = [None] * 7
        else:
            k, *_ = np.linalg.lstsq(m, t, rcond=None)
            out = [*k[:, 0], *k[:, 1], float(np.sqrt(((m @ k - t) ** 2).sum(axis=1).mean()))]
        return pd.DataFrame([[*(pdf[c].iloc[0] for c in by), *out, len(pdf)]], columns=[*by, *"abcdef", "rms", "n"])

    return ties.groupBy(*by).applyInPandas(run, f"{fields}, a double, b double, c double, d double, e double, f double, rms double, n bigint")


def register_grid(bubbles: DataFrame, grid: DataFrame, by: list[str], good_m: float = 0.05) -> DataFrame:
    """by, scale, offset, residual_m, confidence of s = scale * u + offset over grid labels that both sides have.

    Two labels at least; 0.95 where the largest residual is small, else 0.85.
    """
    j = bubbles.select(*by, "label", F.col("u").cast("double").alias("u")).join(grid.select("label", F.col("s").cast("double").alias("s")), "label")
    f = j.groupBy(*by).agg(F.regr_slope("s", "u").alias("scale"), F.regr_intercept("s", "u").alias("offset"), F.count_distinct("label").alias("n")).where("n >= 2 and scale is not null")
    r = j.join(f, by).groupBy(*by).agg(F.max(F.abs(F.col("s") - F.col("scale") * F.col("u") - F.col("offset"))).alias("residual_m"))
    return f.join(r, by).select(*by, "scale", "offset", "residual_m", F.when(F.col("residual_m") <= good_m, 0.95).otherwise(0.85).alias("confidence"))


def register_by_wall(sheets: DataFrame) -> DataFrame:
    """scale, offset at 0.65 from the drawn wall's start and the sheet's scale; north and east elevations run backwards."""
    back = F.lower("facade").isin("north", "east")
    k = 1.0 / F.nullif(F.col("px_per_m"), F.lit(0.0))
    return sheets.withColumn("scale", F.when(back, -k).otherwise(k)).withColumn("offset", F.when(back, F.col("facade_length_m") + F.col("wall_u0_px") * k).otherwise(-F.col("wall_u0_px") * k)).withColumn("confidence", F.lit(0.65))


def dedupe_openings(openings: DataFrame, levels: DataFrame, sources: int = 2) -> tuple[DataFrame, DataFrame]:
    """(one opening of each cluster with its sources, the sources beyond `sources` for review).

    Two are one if they share facade, tag and category, lie on the same or adjacent levels, their centres are within
    5 cm, their widths within 15 cm, and they touch vertically.  The surest, then the tallest, then the least id stands.
    """
    from planweave.operators.components import connected_components

    rank = levels.withColumn("rank", F.row_number().over(Window.orderBy("elevation_z_m", "id"))).select(F.col("id").alias("level_id"), "rank", "elevation_z_m")
    o = openings.join(rank, "level_id").withColumn("z0", F.col("elevation_z_m") + F.col("sill_m")).withColumn("z1", F.col("elevation_z_m") + F.col("head_m"))
    key = [F.coalesce("host_facade", F.lit("")).alias("k1"), F.coalesce("tag", F.lit("@untagged")).alias("k2"), F.coalesce("category", F.lit("")).alias("k3")]
    cell = F.floor(F.col("s_center_m") / 0.05)
    cols = ["id", "rank", "s_center_m", "width_m", "z0", "z1"]
    a = o.select(*key, *cols, F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    b = o.select(*key, *[F.col(c).alias(f"{c}_b") for c in cols], cell.alias("cell"))
    j = a.join(b, ["k1", "k2", "k3", "cell"]).where("id < id_b")
    near = (F.abs(F.col("rank") - F.col("rank_b")) <= 1) & (F.abs(F.col("s_center_m") - F.col("s_center_m_b")) <= 0.05) & (F.abs(F.col("width_m") - F.col("width_m_b")) <= 0.15)
    touch = (F.col("rank") == F.col("rank_b")) | (G.interval_overlap(F.col("z0") - 0.05, F.col("z1") + 0.05, "z0_b", "z1_b") > 0)
    labels = connected_components(j.where(near & touch).select(F.col("id").alias("a"), F.col("id_b").alias("b")))
    c = o.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("cluster", F.coalesce("component", "id"))
    order = [F.col("confidence").desc_nulls_last(), (F.col("z1") - F.col("z0")).desc_nulls_last(), F.col("id")]
    c = c.withColumn("place", F.row_number().over(Window.partitionBy("cluster").orderBy(*order)))
    kept = F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= sources, F.struct("place", "sheet_id")))), lambda s: s.sheet_id)
    told = c.groupBy("cluster").agg(kept.alias("sources"), F.count("*").alias("n"))
    primary = c.where("place = 1").select("cluster", *openings.columns)
    return primary.join(told, "cluster").drop("cluster"), c.where(F.col("place") > sources).select(F.col("cluster").alias("of"), "id", "sheet_id")


def place_openings(rows: DataFrame, by: list[str], gap: float = 0.1) -> DataFrame:
    """rows (id, width_m, s_m or null, wall_m) with start_m and reason, wall by wall.

    Stated places stand; the others go, widest first, into the first free stretch that holds them; what fits nowhere is null.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wall = float(pdf["wall_m"].iloc[0])
        stated = pdf[pdf["s_m"].notna()].sort_values(["s_m", "id"])
        taken = [(s - w / 2, s + w / 2) for s, w in zip(stated["s_m"], stated["width_m"])]
        start = {i: s - w / 2 for i, s, w in zip(stated["id"], stated["s_m"], stated["width_m"])}
        for i, w in pdf[pdf["s_m"].isna()].sort_values(["width_m", "id"], ascending=[False, True])[["id", "width_m"]].itertuples(index=False):
            at = gap
            for a, b in sorted(taken):
                if at + w + gap <= a:
                    break
                at = max(at, b + gap)
            if at + w + gap <= wall + 1e-9:
                start[i] = at
                taken.append((at, at + w))
        out = pdf.copy()
        out["start_m"] = [start.get(i) for i in pdf["id"]]
        out["reason"] = [None if i in start else "no room" for i in pdf["id"]]
        return out

    return rows.groupBy(*by).applyInPandas(run, f"{fields}, start_m double, reason string")
