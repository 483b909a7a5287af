"""An ordered table of patterns and five deterministic aggregates.

The first pattern in the order of the table decides; what fits none gets a null
answer and says so.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planweave.checks.rules import Model
from planweave.functions.geometry import cardinal
from planweave.operators.aggregates import envelope_summary

# Ordered: pattern, method (fixed values).
PATTERNS = [
    (r"\bcount\s+the\s+spaces?\b", "count_spaces"),
    (r"\bcount\s+spaces?\b", "count_spaces"),
    (r"\bhow\s+many\s+spaces?\b", "count_spaces"),
    (r"\bnumber\s+of\s+spaces?\b", "count_spaces"),
    (r"\btotal\s+floor\s+area\b", "total_floor_area"),
    (r"\bfloor\s+area\b", "total_floor_area"),
    (r"\bconditioned\s+area\b", "total_floor_area"),
    (r"\bbuilding\s+orientation\b", "building_orientation"),
    (r"\borientation\b", "building_orientation"),
    (r"\bwhich\s+direction\b", "building_orientation"),
    (r"\bcompass\b", "building_orientation"),
    (r"\bzones?\b", "zone_list"),
    (r"\blist\s+zones?\b", "zone_list"),
    (r"\bthermal\s+zones?\b", "zone_list"),
    (r"\benvelope\b", "envelope_summary"),
    (r"\bwindow.*wall\b", "envelope_summary"),
    (r"\bwwr\b", "envelope_summary"),
    (r"\bwindow.*area\b", "envelope_summary"),
]


def dispatch(text: str | None) -> str | None:
    """The method of the first pattern found, in any case."""
    return next((m for p, m in PATTERNS if re.search(p, text or "", re.I)), None)


def dispatch_column(text: Column) -> Column:
    """dispatch() of a column of questions."""
    out = None
    for p, m in PATTERNS:
        hit = F.coalesce(text, F.lit("")).rlike(f"(?i){p}")
        out = F.when(hit, F.lit(m)) if out is None else out.when(hit, F.lit(m))
    return out


def plain_number(x: Column) -> Column:
    """A double, rounded to thousandths before, in figures: no exponent under 1e16 (Spark's cast has one from 1e7)."""
    cast = x.cast("string")
    figures = F.regexp_replace(x.cast("decimal(38,3)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(x) < 1e16, figures).otherwise(F.regexp_replace(cast, r"(\.0)?E", "e+"))


class Engine:
    """Questions over one model; bearing_deg is the building's, clockwise from north."""

    def __init__(self, model: Model, bearing_deg: float | None = None):
        self.model, self.bearing = model, bearing_deg

    def available(self) -> list[str]:
        return sorted({m for _, m in PATTERNS})

    def count_spaces(self) -> DataFrame:
        return self.model.spaces.agg(F.count("*").cast("string").alias("answer"))

    def total_floor_area(self) -> DataFrame:
        return self.model.spaces.agg(plain_number(F.round(F.sum(F.coalesce("area_m2", F.lit(0.0))), 3)).alias("answer"))

    def building_orientation(self) -> DataFrame:
        return self.model.spark.range(1).select(cardinal(F.lit(self.bearing).cast("double")).alias("answer"))

    def zone_list(self) -> DataFrame:
        z = self.model.zone_spaces.groupBy("zone_id").agg(F.array_sort(F.collect_list("space_id")).alias("s"))
        return z.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("zone_id", "s"))))).alias("answer"))

    def envelope_summary(self) -> DataFrame:
        return envelope_summary(self.model.walls, self.model.openings).select(F.to_json(F.struct("wall_area", "window_area", "wwr", "n_walls", "n_windows", "facades")).alias("answer"))

    def query(self, text: str) -> DataFrame:
        """One row: answer (a string or JSON, null if nothing fits) and method."""
        method = dispatch(text)
        if method is None:
            return self.model.spark.range(1).select(F.lit(None).cast("string").alias("answer"), F.lit("query_dispatch").alias("method"))
        return getattr(self, method)().withColumn("method", F.lit(method))

    def space_by_number(self, number: str, level: str = "L1") -> DataFrame:
        return self.model.spaces.where(F.col("id") == f"{level}-{number}")

    def zones_of_space(self, space_id: str) -> DataFrame:
        return self.model.zone_spaces.where(F.col("space_id") == space_id).select("zone_id")

    def spaces_of_zone(self, zone_id: str) -> DataFrame:
        return self.model.zone_spaces.where(F.col("zone_id") == zone_id).select("space_id")
