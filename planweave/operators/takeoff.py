"""Takeoffs: detections joined to schedules, counted and measured, every miss in a named output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions.text import normalize_tag


@dataclass
class Takeoff:
    """lines: counted and measured tags; unmatched: tags the schedule lacks; untagged: by label; review: weak tags."""

    lines: DataFrame
    unmatched: DataFrame
    untagged: DataFrame
    review: DataFrame


def last_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key; order must be total for the result to be one."""
    w = Window.partitionBy(*key).orderBy(*[o.desc_nulls_last() for o in order])
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def last_wins_noted(rows: DataFrame, tag: str, order: list[Column]) -> DataFrame:
    """The last row of each normalised tag, with a note that names the one before it where there was one."""
    w = Window.partitionBy("key").orderBy(*[o.asc_nulls_first() for o in order])
    r = rows.withColumn("key", normalize_tag(tag)).withColumn("_before", F.lag(tag).over(w)).withColumn("_after", F.lead(F.lit(1)).over(w)).where("_after is null")
    return r.withColumn("note", F.when(F.col("_before").isNotNull(), F.concat(F.lit("duplicate of "), "_before", F.lit("; the last row wins")))).drop("_before", "_after")


def first_wins(rows: DataFrame, key: list[str], order: list[Column], values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the first row of each key, later rows whose values differ from it)."""
    w = Window.partitionBy(*key).orderBy(*[o.asc_nulls_last() for o in order])
    v = F.struct(*values)
    ranked = rows.withColumn("_rank", F.row_number().over(w)).withColumn("_first", F.first(v).over(w))
    kept = ranked.where("_rank = 1").drop("_rank", "_first")
    return kept, ranked.where((F.col("_rank") > 1) & ~v.eqNullSafe(F.col("_first"))).drop("_rank", "_first")


def rollup(detections: DataFrame, schedule: DataFrame, tag: str = "tag", label: str = "label", score: str | None = "tag_score", review_below: float = 0.8) -> Takeoff:
    """Count x width x height by tag.

    schedule has tag, width_m and height_m, one row per normalised tag.  The
    detections are counted by tag before the join, so what meets the schedule is
    a row per tag and a common tag needs no shuffle of its detections.
    """
    d = detections.withColumn("tag", normalize_tag(tag))
    tagged = d.where("tag <> ''")
    counts = tagged.groupBy("tag").agg(F.count("*").alias("n"))
    s = schedule.select(normalize_tag("tag").alias("tag"), "width_m", "height_m")
    lines = counts.join(s, "tag").select("tag", F.col("n").alias("count"), F.round(F.col("n") * F.col("width_m") * F.col("height_m"), 3).alias("area_m2"))
    unmatched = counts.join(s, "tag", "left_anti").select("tag", F.col("n").alias("count"))
    untagged = d.where("tag = ''").groupBy(label).agg(F.count("*").alias("count"))
    review = tagged.where(F.col(score) < review_below).select("tag", F.col(label), F.col(score)) if score else tagged.limit(0).select("tag", label)
    return Takeoff(lines, unmatched, untagged, review)


def measure(regions: DataFrame, category: str, area_px2: str, m_per_px: Column | None) -> DataFrame:
    """Regions and their area by category; square metres are null without a scale."""
    out = regions.groupBy(category).agg(F.count("*").alias("count"), F.sum(area_px2).alias("area_px2"))
    scale = F.lit(None).cast("double") if m_per_px is None else m_per_px
    return out.withColumn("area_m2", F.col("area_px2") * scale * scale)


def scale_from_reference(regions: DataFrame, width_px: str, known_m: float) -> DataFrame:
    """m_per_px from the median width of things whose width is known; null if there are none or it is 0."""
    return regions.agg(F.median(width_px).alias("median_px")).select((F.lit(known_m) / F.nullif("median_px", F.lit(0.0))).alias("m_per_px"))


def lighting_density(fixtures: DataFrame, spaces: DataFrame, space: str = "space_id", watts: str = "watts", area: str = "area_m2") -> DataFrame:
    """Watts and watts per square metre of every space; no fixture is 0 watts, an unknown area a null density.

    Fixtures whose watts aren't known count in n_unknown and leave the total null.
    """
    total = fixtures.groupBy(space).agg(F.count("*").alias("n"), F.count_if(F.col(watts).isNull()).alias("n_unknown"), F.sum(watts).alias("w"))
    out = spaces.join(total, space, "left").withColumn("total_w", F.when(F.coalesce("n_unknown", F.lit(0)) == 0, F.coalesce("w", F.lit(0.0))))
    return out.select(space, F.coalesce("n", F.lit(0)).alias("n_fixtures"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"), "total_w", (F.col("total_w") / F.nullif(F.col(area), F.lit(0.0))).alias("lpd_w_m2"))


def reconcile_counts(a: DataFrame, b: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Keys whose counts differ between two tables, a missing one counting 0: key, n_a, n_b, delta."""
    x = a.select(F.col(key), F.col(n).alias("n_a")).join(b.select(F.col(key), F.col(n).alias("n_b")), key, "full_outer").na.fill(0, ["n_a", "n_b"])
    return x.withColumn("delta", F.col("n_b") - F.col("n_a")).where("delta <> 0")


def review_queue(rows: DataFrame, confidence: str, order: list[str], below: float = 0.8) -> DataFrame:
    """Rows whose confidence is below the bar, with ids RVW-001, ... in the order given."""
    from planweave.operators.ordered import numbered

    return numbered(rows.where(F.col(confidence) < below), order, "_n").withColumn("review_id", F.format_string("RVW-%03d", F.col("_n"))).drop("_n")


def worst_first(items: DataFrame) -> list[Column]:
    """Open items first, then the most urgent, the least sure, and by id."""
    return [F.col("status") != "open", F.col("urgency").desc(), F.col("confidence").asc(), F.col("id").asc()]
