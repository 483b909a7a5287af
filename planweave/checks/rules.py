"""The battery: one small frame per rule, in a fixed order, and the export gate.

A rule is a function of Model, a set of named tables; it returns a Finding, which
becomes one row (check_id, name, severity, n_bad, message, entities).  Severities
are pass, warn, error and skip.  A rule that fails to run becomes an error row
and the battery goes on.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from planweave.functions import geometry as G
from planweave.operators.polygons import union_areas
from planweave.session import discard, local, release, stored

SCHEMA = "check_id string, name string, severity string, n_bad bigint, message string, entities string"
RULES: list[tuple[str, str, Callable]] = []
W_PER_FT2 = 10.7639

# Columns by table, for tables that a model leaves out.
TABLES = {
    "levels": "id string, name string, elevation_z_m double, wall_height_m double",
    "spaces": "id string, level_id string, name string, number string, polygon_m array<array<double>>, area_m2 double, volume_m3 double, poly_type string, sheet_id string, lpd_w_m2 double, lpd_w_ft2 double, total_w double",
    "walls": "id string, level_id string, facade string, length_m double, height_m double, area_m2 double, construction string, u_si double, sheet_id string, stated_u double",
    "openings": "id string, space_id string, tag string, category string, width_m double, height_m double, sill_m double, head_m double, host_facade string, s_center_m double, s0_m double, s1_m double, area_m2 double, level_id string, sheet_id string, u_si double, shgc double, stated_count bigint",
    "schedules": "tag string, category string, width_m double, height_m double, watts double, count bigint, area_m2 double",
    "fixtures": "id string, space_id string, tag string, watts double, x_m double, y_m double, sheet_id string",
    "zones": "id string, n_diffusers bigint, unit string, system string, efficiency double, size_class string",
    "zone_spaces": "zone_id string, space_id string",
    "space_zones": "space_id string, zone_id string",
    "components": "id string, space_id string, sheet_id string",
    "roofs": "id string, space_id string, level_id string, polygon_m array<array<double>>, area_m2 double, tilt_deg double, azimuth_deg double, u_si double, construction string",
    "roofs_before": "id string, area_m2 double, tilt_deg double, azimuth_deg double",
    "daylight": "id string, space_id string, kind string, polygon_m array<array<double>>, area_m2 double",
    "shading": "id string, host_id string, depth_m double",
    "review": "id string, kind string, description string, confidence double, status string, needs_review boolean, acknowledged boolean, sheet_id string",
    "revision_log": "seq bigint, sheet_id string, revision bigint, action string, note string",
    "export_spaces": "id string, area_m2 double, volume_m3 double",
    "export_surfaces": "id string, area_m2 double",
    "export_openings": "id string, surface_id string",
    "ifc_counts": "kind string, n bigint",
    "footprints": "level_id string, area_m2 double, perimeter_m double",
    "simplified": "level_id string, area_before double, area_after double, offset_m double, budget double",
    "limits": "surface string, class string, u_max double",
    "lpd_limits": "name string, lpd_max double",
    "efficiency_limits": "system string, size_class string, least double",
    "conventions": "interior_m3 double, exterior_m3 double, thickness_m double",
    "shells": "id string, faces array<array<array<double>>>",
}


class Model:
    """Named tables; those that are missing, and columns that a table lacks, are empty or null."""

    def __init__(self, spark: SparkSession, **tables: DataFrame):
        self.spark, self.tables = spark, tables
        self._whole: dict[str, DataFrame] = {}
        self._empty: dict[int, bool] = {}
        self._made: dict[str, DataFrame] = {}
        self._making, self._naming = Lock(), Lock()

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        with self._naming:  # rules that are built side by side take one and the same frame
            if name not in self._whole:
                schema = StructType.fromDDL(TABLES[name])
                if name in self.tables:
                    t = self.tables[name]
                    self._whole[name] = t.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in t.columns})
                else:
                    self._whole[name] = local(self.spark, [], TABLES[name])
                    self._empty[id(self._whole[name])] = True
            return self._whole[name]

    def is_empty(self, rows: DataFrame) -> bool:
        """Whether there are no rows; asked once for each of the model's own tables."""
        if not any(rows is t for t in list(self._whole.values())):
            return rows.isEmpty()
        if id(rows) not in self._empty:
            self._empty[id(rows)] = rows.isEmpty()
        return self._empty[id(rows)]

    def counted(self, rows: DataFrame, n: int) -> None:
        """Remember what a pass has found of one of the model's own tables."""
        if any(rows is t for t in list(self._whole.values())):
            self._empty[id(rows)] = not n

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What several rules derive from the tables, written once; run() deletes it when it is done."""
        with self._making:
            if name not in self._made:
                self._made[name] = stored(build(), name)
            return self._made[name]

    def forget(self) -> None:
        """Delete what once() wrote."""
        while self._made:
            discard(self._made.popitem()[1])


def rule(check_id: str, name: str):
    def register(f):
        RULES.append((check_id, name, f))
        return f

    return register


@dataclass
class Finding:
    """What a rule found: the rows that break it, and those that it looked at (None: always something).

    A row with _n stands for so many findings of its entity.  Where there is a
    cheaper way to their number than counting `bad`, it is in parts or tally;
    the number is the same.
    """

    bad: DataFrame
    entity: str
    severity: str = "error"
    seen: DataFrame | None = None
    why: str = ""
    nothing: tuple[str, str] = ("skip", "")  # severity and message where there was nothing to look at
    within: bool = False  # what is bad was seen, so that nothing need be asked of `seen` where something is bad
    parts: tuple[tuple[DataFrame, Column, Column], ...] = ()  # (a table, which rows are looked at, which of those are bad): counted with other rules' over one pass of the table
    tally: Callable[[], DataFrame] | None = None  # one row (n): the number of all that is bad
    shares: str = ""  # the name of what its tally takes from Model.once()

    def counted(self) -> tuple[int, int]:
        """The number of what is bad, and how much of it are errors: one aggregate."""
        if self.tally is not None:
            n = self.tally().first().n or 0
            return n, n if self.severity == "error" else 0
        e = self._named()
        return tuple(e.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("s") == "error")).first())

    def _named(self) -> DataFrame:
        return self.bad.select(F.col(self.entity).cast("string").alias("e"), (F.col("_severity") if "_severity" in self.bad.columns else F.lit(self.severity)).alias("s"), (F.col("_n") if "_n" in self.bad.columns else F.lit(1)).cast("bigint").alias("n"))

    def row(self, model: Model, keep: int = 20, known: tuple[int, int] | None = None) -> tuple[str, int, str, str]:
        """(severity, n_bad, message, the least `keep` ids): ids are looked for only where there are any and some are asked for.

        known: (number of bad rows, of rows looked at), where one pass has counted them for several rules.
        """
        if known is not None:
            n, errors, none = known[0], known[0] if self.severity == "error" else 0, self.seen is not None and (model.is_empty(self.seen) if not self.within else not known[1])
        else:
            none = self.seen is not None and not self.within and model.is_empty(self.seen)
            n, errors = (0, 0) if none else self.counted()
            none = none or (self.within and not n and model.is_empty(self.seen))
        if none:
            return (self.nothing[0], 0, self.nothing[1], "")
        if not n:
            return ("pass", 0, "", "")
        first = self._named().select("e", "n").orderBy("e").limit(keep).collect() if keep else []
        named = [x.e for x in first for _ in range(min(x.n, keep))][:keep]
        return ("error" if errors else "warn", n, self.why, ",".join(x for x in named if x is not None))


verdict = Finding


def each(*parts: tuple[DataFrame, Column | None, Column], severity: str = "error", seen: DataFrame | None = None, why: str = "", nothing: tuple[str, str] = ("skip", ""), within: bool = False) -> Finding:
    """A rule on rows alone: of each (table, rows looked at or None for all, rows that are bad).  Without `seen`, within: what is looked at."""
    parts = tuple((t, F.lit(True) if looked is None else looked, bad) for t, looked, bad in parts)
    if within:
        seen = reduce(DataFrame.unionByName, [t.where(looked).select("id") for t, looked, _ in parts])
    return Finding(reduce(DataFrame.unionByName, [t.where(looked & bad).select("id") for t, looked, bad in parts]), "id", severity, seen, why, nothing, within, parts)


def relative_error(actual: Column, expected: Column) -> Column:
    """0 for 0 of 0, infinite for anything else of 0."""
    return F.when(expected == 0, F.when(actual == 0, 0.0).otherwise(float("inf"))).otherwise(F.abs(actual - expected) / F.abs(expected))


def relative_error_strict(actual: Column, expected: Column) -> Column:
    """Infinite whenever 0 is expected."""
    return F.when(expected == 0, float("inf")).otherwise(F.abs(actual - expected) / F.abs(expected))


def _off(actual: Column, expected: Column, tolerance: float) -> Column:
    return F.coalesce(relative_error(actual, expected) > tolerance, F.lit(True))


def _sorted(rows: DataFrame) -> DataFrame:
    """A join's side that grows with the building: never broadcast, as its file tells Spark little of its size."""
    return rows.hint("merge")


def _hashed(rows: DataFrame, *keys: str) -> DataFrame:
    """With _h, a hash of the keys, to stand before them wherever they are sorted: ids begin alike, and their first eight bytes tell few apart."""
    return rows.withColumn("_h", F.xxhash64(*keys))


def _met(rows: DataFrame, other: DataFrame, key: str, how: str) -> DataFrame:
    """A join on one key whose right side grows with the building."""
    h = lambda t: t if "_h" in t.columns else _hashed(t, key)
    return h(rows).join(_sorted(h(other)), ["_h", key], how).drop("_h")


@rule("C01", "space area matches polygon")
def _(m):
    off = F.get(F.transform(F.array(G.area("polygon_m")), lambda a: _off(F.col("area_m2"), a, 0.001)), F.lit(0))  # the polygon's area is taken once
    bad = F.col("polygon_m").isNull() | F.col("area_m2").isNull() | off
    return each((m.spaces, None, bad), severity="warn", seen=m.spaces, why="area and polygon differ by over 0.1 %", nothing=("error", "no spaces"))


def _footprints(m) -> DataFrame:
    """Stated footprints, else the union of a level's space polygons."""
    if "footprints" in m.tables:
        return m.footprints
    u = union_areas(m.spaces.where("polygon_m is not null and level_id is not null").withColumnRenamed("polygon_m", "polygon"), ["level_id"])
    return u.select("level_id", F.col("union_area").alias("area_m2"), F.lit(None).cast("double").alias("perimeter_m"))


@rule("C02", "area conservation by level")
def _(m):
    got = m.spaces.where("level_id is not null").groupBy("level_id").agg(F.sum("area_m2").alias("a"))
    off = got.join(_footprints(m), "level_id", "left").where(_off(F.col("a"), F.col("area_m2"), 0.03)).select(F.col("level_id").alias("e"))
    lost = m.spaces.where("level_id is null").select(F.col("id").alias("e"))
    return verdict(off.unionByName(lost), "e", seen=m.spaces, why="space areas and footprint differ by over 3 %, or a space has no level")


@rule("C03", "volume matches area and height")
def _(m):
    j = m.spaces.join(m.levels.select(F.col("id").alias("level_id"), "wall_height_m"), "level_id", "left")
    return verdict(j.where(_off(F.col("volume_m3"), F.col("area_m2") * F.col("wall_height_m"), 0.001)), "id", "warn", m.spaces, "volume is not area times height")


@rule("C04", "volume conservation by level")
def _(m):
    got = m.spaces.where("level_id is not null").groupBy("level_id").agg(F.sum("volume_m3").alias("v"))
    j = got.join(_footprints(m), "level_id", "left").join(m.levels.select(F.col("id").alias("level_id"), "wall_height_m"), "level_id", "left")
    return verdict(j.where(_off(F.col("v"), F.col("area_m2") * F.col("wall_height_m"), 0.03)), "level_id", seen=m.spaces, why="volumes differ from the footprint's by over 3 %")


@rule("C05", "convention bias")
def _(m):
    c = m.conventions
    bad = c.where(~F.col("thickness_m").between(0.05, 1.2) | _off(F.col("interior_m3"), F.col("exterior_m3"), 0.10)).withColumn("e", F.lit("convention"))
    return verdict(bad, "e", "warn", c, "interior and exterior volumes differ by over 10 %, or the wall thickness is not plausible")


@rule("C06", "skylights within roof")
def _(m):
    sky = m.openings.where("category = 'skylight'").groupBy("space_id").agg(F.sum("area_m2").alias("s"))
    roof = m.roofs.groupBy("space_id").agg(F.sum("area_m2").alias("r"))
    return verdict(sky.join(roof, "space_id", "left").where(F.col("s") > F.coalesce("r", F.lit(0.0)) + 1e-6), "space_id", seen=sky, why="skylights larger than the roof", within=True)


@rule("C07", "roof covers the top footprint once")
def _(m):
    # Planes are projected by their tilt.
    r = m.roofs.agg(F.sum(F.col("area_m2") * F.cos(F.radians(F.coalesce("tilt_deg", F.lit(0.0))))).alias("a"))
    top = m.levels.agg(F.max_by("id", "elevation_z_m").alias("level_id")).join(_footprints(m), "level_id")
    return verdict(r.crossJoin(top).where(_off(F.col("a"), F.col("area_m2"), 0.01)), "level_id", seen=m.roofs, why="roof and top footprint differ by over 1 %")


@rule("C08", "roof solar aperture kept")
def _(m):
    from planweave.operators.polygons import solar_aperture

    a, b = solar_aperture(m.roofs, 45.0).withColumnRenamed("aperture", "x"), solar_aperture(m.roofs_before, 45.0)
    j = a.join(b, "orientation", "full_outer").na.fill(0.0)
    return verdict(j.where(_off(F.col("x"), F.col("aperture"), 0.02)), "orientation", seen=m.roofs_before, why="solar aperture changed by over 2 %")


@rule("C09", "daylight zones add up")
def _(m):
    got = _hashed(m.daylight, "space_id").groupBy("_h", "space_id").agg(F.sum("area_m2").alias("d"))
    j = _met(got, m.spaces.select(F.col("id").alias("space_id"), F.col("area_m2").alias("a")), "space_id", "left")
    return verdict(j.where(F.coalesce(F.col("d") > F.col("a") * 1.001, F.lit(True))), "space_id", seen=m.daylight, why="daylight zones larger than their space", within=True)


@rule("C10", "wall constructions")
def _(m):
    unset, off = F.col("construction").isNull(), _off(F.col("u_si"), F.col("stated_u"), 1e-6)
    return each((m.walls, None, unset), (m.walls, F.expr("stated_u is not null and u_si is not null"), off), severity="warn", seen=m.walls, why="walls without a construction, or with another U than theirs")


@rule("C11", "shading hosts")
def _(m):
    no = m.shading.join(m.walls.select(F.col("id").alias("host_id")), "host_id", "left_anti").select("id")
    deep = m.shading.where("depth_m > 5").select("id")
    return verdict(no.unionByName(deep).distinct(), "id", seen=m.shading, why="shading without its host, or deeper than 5 m")


@rule("C12", "space types")
def _(m):
    ok = ["room", "shaft", "closet", "corridor", "stair", "elevator_core", "void"]
    return each((m.spaces, None, F.col("poly_type").isNotNull() & ~F.col("poly_type").isin(ok)), seen=m.spaces, why="space type outside the list")


@rule("C13", "envelope area matches perimeter")
def _(m):
    w = m.walls.where("level_id is not null").groupBy("level_id").agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("w"))
    j = w.join(_footprints(m).where("perimeter_m is not null"), "level_id").join(m.levels.select(F.col("id").alias("level_id"), "wall_height_m"), "level_id")
    return verdict(j.where(_off(F.col("w"), F.col("perimeter_m") * F.col("wall_height_m"), 0.01)), "level_id", "warn", j, "walls and perimeter differ by over 1 %", within=True)


@rule("I01", "simplification within budget")
def _(m):
    s = m.simplified
    return verdict(s.where((relative_error(F.col("area_after"), F.col("area_before")) > F.col("budget")) | (F.col("offset_m") > 0.5)), "level_id", seen=s, why="simplified outline drifted beyond its budget")


@rule("I02", "openings fit their facade")
def _(m):
    held = m.openings.where("category in ('window', 'door')")
    o = held.groupBy(F.col("host_facade").alias("facade")).agg(F.sum("area_m2").alias("o"))
    w = m.walls.groupBy("facade").agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("w"))
    return verdict(o.join(w, "facade", "full_outer").where(F.coalesce("o", F.lit(0.0)) > F.coalesce("w", F.lit(0.0)) + F.greatest(F.coalesce("w", F.lit(0.0)) * 0.005, F.lit(1e-6))), "facade", seen=held, why="openings larger than their facade")


@rule("I03", "takeoff counts reconcile")
def _(m):
    o = m.openings.where("tag is not null").groupBy("tag").agg(F.count("*").alias("n"), F.sum("area_m2").alias("a"))
    j = o.join(m.schedules.select("tag", "width_m", "height_m"), "tag")
    return verdict(j.where(_off(F.col("a"), F.col("n") * F.col("width_m") * F.col("height_m"), 1e-6)), "tag", seen=j, why="count times size isn't the area", within=True)


def _unscheduled(m, rows: DataFrame, value: Column, kind: str) -> Finding:
    flagged = m.review.where(F.col("kind") == kind).agg((F.count("*") > 0).alias("_flagged"))
    bad = rows.where(value).crossJoin(flagged).withColumn("_severity", F.when(F.col("_flagged"), "warn").otherwise("error"))
    return verdict(bad, "id", seen=rows, why=f"{kind}: not in the schedule", within=True)


@rule("I04", "fixtures in schedule")
def _(m):
    j = m.fixtures.drop("watts").join(m.schedules.select("tag", "watts"), "tag", "left")
    return _unscheduled(m, j, F.col("watts").isNull(), "fixture_unmatched")


@rule("I05", "openings in schedule")
def _(m):
    j = m.openings.where("category in ('window', 'door')").select("id", "tag").join(m.schedules.select("tag", "width_m", "height_m"), "tag", "left")
    return _unscheduled(m, j, F.col("width_m").isNull() | F.col("height_m").isNull(), "opening_unmatched")


@rule("I06", "no negative areas")
def _(m):
    return each((m.spaces, None, F.expr("area_m2 < 0 or volume_m3 < 0")), (m.openings, None, F.expr("width_m <= 0 or height_m <= 0")), why="negative or zero sizes")


@rule("I07", "lighting density bounds")
def _(m):
    n = _hashed(m.fixtures.select(F.col("space_id").alias("id")), "id").groupBy("_h", "id").agg(F.count("*").alias("n"))
    s = m.spaces.where("lpd_w_m2 is not null")
    j = _met(s, n, "id", "left")
    return verdict(j.where((F.col("lpd_w_m2") > 25) | ((F.col("lpd_w_m2") <= 0) & (F.col("n") > 0))), "id", "warn", s, "lighting density out of bounds", within=True)


@rule("I08", "lighting density units")
def _(m):
    both = F.expr("lpd_w_m2 is not null and lpd_w_ft2 is not null")
    return each((m.spaces, both, F.abs(F.col("lpd_w_ft2") - F.col("lpd_w_m2") / W_PER_FT2) > 1e-6), why="W/ft2 and W/m2 disagree", within=True)


_PLACE = ["host_facade", "tag", "category", "r", "s_center_m", "width_m"]
_STATED, _OUT_OF_WALL = "sill_m is not null and head_m is not null", "(sill_m < 0 or head_m <= sill_m or head_m > wall_height_m + 0.01D)"


def _ranked(m) -> DataFrame:
    return m.levels.withColumn("r", F.row_number().over(Window.orderBy("elevation_z_m", "id"))).select(F.col("id").alias("lv"), "r", "wall_height_m")


def _places(m) -> DataFrame:
    """Openings by place and level, with how many break I09 and I12: their one join with the spaces serves three rules."""

    def build():
        s = m.spaces.select(F.col("id").alias("space_id"), F.col("level_id").alias("lv"), F.lit(True).alias("found"))
        o = _met(m.openings.select("space_id", "host_facade", "tag", "category", "s_center_m", "width_m", "sill_m", "head_m"), s, "space_id", "left").join(_ranked(m), "lv", "left")
        return o.groupBy(*_PLACE).agg(F.count("*").alias("n"), F.count_if(F.expr(f"{_STATED} and {_OUT_OF_WALL}")).alias("out"), F.count_if(F.col("found").isNull()).alias("free"))

    return m.once("places", build)


@rule("I09", "sill and head")
def _(m):
    o = m.openings.where(_STATED)
    j = _met(o, m.spaces.select(F.col("id").alias("space_id"), F.col("level_id").alias("lv")), "space_id", "left").join(m.levels.select(F.col("id").alias("lv"), "wall_height_m"), "lv", "left")
    return verdict(j.where(_OUT_OF_WALL), "id", seen=o, why="sill or head out of the wall", within=True, tally=lambda: _places(m).agg(F.sum("out").alias("n")), shares="places")


@rule("I10", "zone coverage")
def _(m):
    served = _hashed(m.space_zones.select(F.col("space_id").alias("id")), "id").select("_h", "id").distinct()  # in this order the join sorts them
    free = _met(m.spaces, served, "id", "left_anti")
    share = free.agg(F.sum("area_m2").alias("f")).crossJoin(m.spaces.agg(F.sum("area_m2").alias("a")))
    over = free.crossJoin(share).where(F.col("f") > 0.05 * F.col("a"))

    def count():
        j = _met(m.spaces.select("id", "area_m2"), served.withColumn("served", F.lit(True)), "id", "left")
        open_ = F.col("served").isNull()
        return j.agg(F.sum(F.when(open_, F.col("area_m2"))).alias("f"), F.sum("area_m2").alias("a"), F.count_if(open_).alias("free")).select(F.when(F.col("f") > 0.05 * F.col("a"), F.col("free")).otherwise(0).alias("n"))

    return verdict(over, "id", "warn", m.zones, "over 5 % of the area is in no zone", tally=count)


def _repeats(n: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of places with their number of openings: (those with how many one level up, _n), (the number of all pairs, bad, if over 1 % of openings)."""
    # Places meet over cells of twice the reach: no pair of openings is made.
    n = n.withColumn("cell", F.floor(F.col("s_center_m") / 0.1))
    key = _PLACE[:3]
    b = n.select(*key, *[F.col(x).alias(f"{x}_b") for x in ("r", "s_center_m", "width_m", "n")], F.explode(F.array(*[F.col("cell") + k for k in (-1, 0, 1)])).alias("cell"))
    near = (F.abs(F.col("s_center_m") - F.col("s_center_m_b")) <= 0.05) & (F.abs(F.col("width_m") - F.col("width_m_b")) <= 0.15)
    up = n.drop("n").withColumn("r_b", F.col("r") + 1).join(b, [*key, "r_b", "cell"]).where(near).groupBy(*_PLACE).agg(F.sum("n_b").alias("_n"))
    over = up.join(n, _PLACE).agg(F.sum(F.col("_n") * F.col("n")).alias("bad")).crossJoin(n.agg(F.sum("n").alias("n"))).where("bad > 0.01 * n")
    return up, over.select("bad")


@rule("I11", "no opening twice on adjacent levels")
def _(m):
    o = _met(m.openings, m.spaces.select(F.col("id").alias("space_id"), F.col("level_id").alias("lv")), "space_id", "inner").join(_ranked(m).drop("wall_height_m"), "lv")
    up, over = _repeats(o.groupBy(*_PLACE).agg(F.count("*").alias("n")))
    pairs = lambda: _repeats(_places(m).where("r is not null").select(*_PLACE, "n"))[1].agg(F.sum("bad").alias("n"))
    return verdict(o.join(up, _PLACE).crossJoin(over), "id", "warn", o, "openings that repeat one level up", within=True, tally=pairs, shares="places")


@rule("I12", "openings attached to spaces")
def _(m):
    free = _met(m.openings, m.spaces.select(F.col("id").alias("space_id")), "space_id", "left_anti")
    return verdict(free, "id", "warn", m.openings, "openings in no space", tally=lambda: _places(m).agg(F.sum("free").alias("n")), shares="places")


@rule("E01", "components in one space")
def _(m):
    return verdict(m.components.where("space_id is not null").groupBy("id").agg(F.count_distinct("space_id").alias("n")).where("n > 1"), "id", seen=m.components, why="component in several spaces")


@rule("E02", "zones not empty")
def _(m):
    n = m.zone_spaces.groupBy(F.col("zone_id").alias("id")).agg(F.count("*").alias("n"))
    return verdict(m.zones.join(n, "id", "left").where("coalesce(n, 0) = 0 or coalesce(n_diffusers, 0) = 0"), "id", seen=m.zones, why="zone without spaces or diffusers")


@rule("E03", "zones and spaces refer to each other")
def _(m):
    pairs = lambda t, c: t.select("zone_id", "space_id", F.lit(c == "there").alias("there"), F.lit(c == "back").alias("back"))
    both = _hashed(pairs(m.zone_spaces, "there").unionByName(pairs(m.space_zones, "back")), "space_id").groupBy("_h", "zone_id", "space_id").agg(F.max("there").alias("there"), F.max("back").alias("back"))
    known = lambda t, c, *h: t.select(*h, F.col("id").alias(c)).distinct().withColumn(f"_{c}", F.lit(True))
    j = _met(both, known(_hashed(m.spaces, "id"), "space_id", "_h"), "space_id", "left").join(known(m.zones, "zone_id"), "zone_id", "left")
    bad = j.where((F.col("there") != F.col("back")) | (F.col("there") & F.col("_space_id").isNull()) | (F.col("back") & F.col("_zone_id").isNull()))
    return verdict(bad.select(F.concat_ws("/", "zone_id", "space_id").alias("e")), "e", seen=m.zones, why="references that don't resolve or aren't returned")


@rule("E04", "space ids and numbers")
def _(m):
    shape = m.spaces.where(F.col("id") != F.concat_ws("-", "level_id", "number")).select(F.col("id").alias("e"))
    twice = m.spaces.where("number is not null").groupBy("number").agg(F.count("*").alias("n"), F.min("id").alias("e")).where("n > 1").select("e")
    return verdict(shape.unionByName(twice).distinct(), "e", "warn", m.spaces, "ids that aren't level-number, or numbers used twice over all levels")


@rule("E05", "elevation placement")
def _(m):
    stated = F.expr("head_m is not null and sill_m is not null and height_m is not null")
    bad = (F.abs(F.col("head_m") - F.col("sill_m") - F.col("height_m")) > 0.01) | (F.col("s_center_m") < F.col("s0_m")) | (F.col("s_center_m") > F.col("s1_m")) | (F.abs(F.col("area_m2") - F.col("width_m") * F.col("height_m")) > 0.01)
    return each((m.openings, stated, bad), why="placement and sizes disagree", within=True)


@rule("E06", "windows linked twice")
def _(m):
    group = ("space_id", "tag", "host_facade")
    o = m.openings.where("category = 'window' and s_center_m is not null")
    near = lambda t, *order: t.withColumn("d", F.lead("s_center_m").over(Window.partitionBy("_h", *group).orderBy(*order)) - F.col("s_center_m")).where("d < 0.15")
    places = _hashed(o.select(*group, "s_center_m"), *group)  # which of those at one place comes first changes no number
    return verdict(near(_hashed(o, *group), "s_center_m", "id").drop("_h"), "id", seen=o, why="two links to one window", within=True, tally=lambda: near(places, "s_center_m").agg(F.count("*").alias("n")))


@rule("E07", "windows have tags")
def _(m):
    return each((m.openings, F.expr("category = 'window'"), F.expr("coalesce(trim(tag), '') = ''")), severity="warn", why="windows without a tag", within=True)


@rule("E08", "provenance complete")
def _(m):
    facts = [m.spaces, m.walls, m.openings, m.fixtures, m.components]
    return each(*[(t, None, F.expr("coalesce(trim(sheet_id), '') = ''")) for t in facts], why="facts without a sheet", within=True)


@rule("E09", "review queue sound")
def _(m):
    bad = F.col("kind").isNull() | F.col("description").isNull() | F.coalesce(~F.col("status").isin("open", "confirm", "reject", "edit", "auto"), F.lit(True))
    return each((m.review, None, bad), seen=m.review, why="review items with missing or unknown fields")


@rule("E10", "review queue acknowledged")
def _(m):
    return each((m.review, None, F.expr("needs_review and not coalesce(acknowledged, false)")), severity="warn", seen=m.review, why="items that nobody acknowledged")


@rule("E11", "revision log present")
def _(m):
    n = m.revision_log.agg(F.count("*").alias("n")).where("n = 0").withColumn("e", F.lit("revision_log"))
    return verdict(n, "e", why="no revision was logged")


def _count(t: DataFrame, name: str) -> DataFrame:
    return t.agg(F.count("*").alias(name))


@rule("X01", "exported spaces")
def _(m):
    n = _count(m.export_spaces, "a").crossJoin(_count(m.spaces, "b")).where("a <> b").select(F.lit("count").alias("e"))
    bad = m.export_spaces.where("coalesce(area_m2, 0) <= 0 or coalesce(volume_m3, 0) <= 0").select(F.col("id").alias("e"))
    return verdict(n.unionByName(bad), "e", seen=m.export_spaces, why="other count of spaces, or sizes not above 0")


@rule("X02", "exported openings have surfaces")
def _(m):
    free = lambda t: t.join(_sorted(m.export_surfaces.select(F.col("id").alias("surface_id"))), "surface_id", "left_anti")
    by_surface = lambda: free(m.export_openings.groupBy("surface_id").agg(F.count("*").alias("n"))).agg(F.sum("n").alias("n"))
    return verdict(free(m.export_openings), "id", seen=m.export_openings, why="openings without their surface", tally=by_surface)


@rule("X03", "exported wall areas")
def _(m):
    j = m.export_surfaces.agg(F.sum("area_m2").alias("a")).crossJoin(m.walls.agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("b"))).where(_off(F.col("a"), F.col("b"), 0.01)).withColumn("e", F.lit("walls"))
    return verdict(j, "e", seen=m.export_surfaces, why="exported walls differ by over 1 %")


@rule("X04", "IFC counts")
def _(m):
    c = m.ifc_counts
    n = c.where("kind = 'IfcSpace'").crossJoin(_count(m.spaces, "b")).where("n <> b").select(F.col("kind").alias("e"))
    return verdict(n.unionByName(c.where("kind = 'IfcWall' and n <= 0").select(F.col("kind").alias("e"))), "e", seen=c, why="IFC counts differ")


def _u_limit(m, rows: DataFrame, surface: str) -> Finding:
    """Over its class's limit is an error; of an unknown class, over the loosest limit is an error and under it a warning."""
    limits = m.limits.where(F.col("surface") == surface)
    loosest = limits.agg(F.max("u_max").alias("_loosest"))
    j = rows.where("u_si is not null").join(limits.select(F.col("class").alias("construction"), "u_max"), "construction", "left").crossJoin(loosest)
    limit = F.coalesce("u_max", "_loosest")
    j = j.withColumn("_severity", F.when(F.col("u_si") > limit, "error").when(F.col("u_max").isNull(), "warn"))
    return verdict(j.where("_severity is not null"), "id", seen=limits, why=f"{surface} U above its limit, or unconfirmed")


@rule("A01", "wall U-factors")
def _(m):
    return _u_limit(m, m.walls, "wall")


@rule("A02", "roof U-factors")
def _(m):
    return _u_limit(m, m.roofs, "roof")


@rule("A03", "window U-factors")
def _(m):
    return _u_limit(m, m.openings.where("category = 'window'").withColumn("construction", F.lit("window")), "window")


@rule("A04", "lighting density limits")
def _(m):
    t = m.lpd_limits.select(F.lower("name").alias("n"), "lpd_max")
    other = t.where("n = 'other'").agg(F.max("lpd_max").alias("_other"))
    j = m.spaces.where("lpd_w_m2 is not null").join(t, F.lower("name") == F.col("n"), "left").crossJoin(other)
    return verdict(j.where(F.col("lpd_w_m2") > F.coalesce("lpd_max", "_other")), "id", "warn", m.lpd_limits, "lighting density above its limit")


@rule("A05", "equipment efficiency")
def _(m):
    t = m.efficiency_limits
    any_ = t.where("system = '*' and size_class = '*'").agg(F.max("least").alias("_any"))
    j = m.zones.where("efficiency is not null").join(t, ["system", "size_class"], "left").crossJoin(any_).dropDuplicates(["id"])
    return verdict(j.where(F.col("efficiency") < F.coalesce("least", "_any")), "id", seen=t, why="efficiency below its minimum")


@rule("K01", "area closure")
def _(m):
    j = m.spaces.agg(F.sum("area_m2").alias("a")).crossJoin(_footprints(m).agg(F.sum("area_m2").alias("b"))).where(_off(F.col("a"), F.col("b"), 0.03)).withColumn("e", F.lit("building"))
    return verdict(j, "e", seen=m.spaces, why="areas don't close within 3 %")


@rule("K02", "volume closure")
def _(m):
    h = m.levels.select(F.col("id").alias("level_id"), "wall_height_m")
    b = _footprints(m).join(h, "level_id", "left").crossJoin(m.levels.agg(F.avg("wall_height_m").alias("_h"))).agg(F.sum(F.col("area_m2") * F.coalesce("wall_height_m", "_h")).alias("b"))
    j = m.spaces.agg(F.sum("volume_m3").alias("a")).crossJoin(b).where(_off(F.col("a"), F.col("b"), 0.05)).withColumn("e", F.lit("building"))
    return verdict(j, "e", seen=m.spaces, why="volumes don't close within 5 %")


@rule("K03", "envelope closure")
def _(m):
    w = m.walls.groupBy("facade").agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("w"))
    o = m.openings.where("category in ('window', 'door')").groupBy(F.col("host_facade").alias("facade")).agg(F.sum("area_m2").alias("o"))
    j = w.join(o, "facade", "left")
    return verdict(j.where((F.col("w") <= 0) | (F.coalesce("o", F.lit(0.0)) > 1.01 * F.col("w"))), "facade", seen=m.walls, why="openings beyond 101 % of a facade, or a facade without area")


@rule("K04", "shells closed")
def _(m):
    """Every edge of a closed shell is used once in each direction."""
    f = m.shells.select("id", F.explode("faces").alias("f"))
    e = f.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.size("f")), lambda i: F.struct(F.element_at("f", i).alias("p"), F.element_at(F.col("f"), (i % F.size("f") + 1).cast("int")).alias("q")))).alias("e")).select("id", F.to_json("e.p").alias("p"), F.to_json("e.q").alias("q"))
    back = e.select("id", F.col("q").alias("p"), F.col("p").alias("q"))
    open_ = e.exceptAll(back).select("id").unionByName(m.shells.where(G.shell_volume("faces") <= 0).select("id")).distinct()
    return verdict(open_, "id", seen=m.shells, why="shell not closed, or inside out")


def _together(model: Model, found: list, pool: ThreadPoolExecutor) -> list[tuple[list[int], Future]]:
    """Findings in parts: one aggregate for each table.  (Places in `found`, what will hold the number of rows that are bad and looked at, for each; None: it failed.)"""
    tables: dict[int, tuple[DataFrame, list]] = {}
    for k, finding in enumerate(found):
        for t, looked, bad in getattr(finding, "parts", ()):
            tables.setdefault(id(t), (t, []))[1].append((k, looked, bad))

    def count(t: DataFrame, parts: list) -> list | None:
        try:
            n, *rest = t.agg(F.count("*"), *[c.alias(f"{x}{i}") for i, (_, looked, bad) in enumerate(parts) for x, c in (("bad", F.count_if(looked & bad)), ("seen", F.count_if(looked)))]).first()
            model.counted(t, n)
            return rest
        except Exception:
            return None

    return [([k for k, _, _ in parts], pool.submit(count, t, parts)) for t, parts in tables.values()]


def _known(passes: list[tuple[list[int], Future]], k: int) -> tuple[int, int] | None:
    """(bad, looked at) of one finding in parts, over all its tables; None if a pass of one failed."""
    n = (0, 0)
    for places, counted in passes:
        for i in [i for i, x in enumerate(places) if x == k]:
            if counted.result() is None:
                return None
            n = tuple(a + b for a, b in zip(n, counted.result()[2 * i : 2 * i + 2], strict=True))
    return n


def run(model: Model, only: list[str] | None = None, at_once: int = 4, keep: int = 20) -> DataFrame:
    """The report: one row per rule, in the battery's order, with the least `keep` entities (0: none are looked for).

    What rules count row by row is counted in one pass of each table; should
    that fail, by each rule alone.  The others run side by side, each as jobs of
    its own that end in its one row, so that one that can't be planned or fails
    while it runs is a finding and the others go on; none waits for a slower one
    but for what they share, which is made first.  Rules differ in number only,
    so what reaches the driver is fixed.
    """
    rules = [r for r in RULES if not only or r[0] in only]

    def guarded(f: Callable):
        try:
            return f()
        except Exception as failed:
            return failed

    def one(k: int) -> tuple:
        row = found[k] if isinstance(found[k], Exception) else guarded(lambda: found[k].row(model, keep, _known(passes, k) if found[k].parts else None))
        return (*rules[k][:2], *(("error", 0, f"the rule failed: {type(row).__name__}", "") if isinstance(row, Exception) else row))

    with ThreadPoolExecutor(at_once) as pool:
        found = list(pool.map(lambda r: guarded(lambda: r[2](model)), rules))
        shared = {getattr(f, "shares", ""): k for k, f in reversed(list(enumerate(found)))}
        first = [k for name, k in shared.items() if name]
        ahead = {k: pool.submit(one, k) for k in first}
        passes = _together(model, found, pool)
        ahead |= {k: pool.submit(one, k) for k in sorted(set(range(len(rules))) - set(first), key=lambda k: (bool(getattr(found[k], "parts", ())), k))}
        for n, _ in enumerate(as_completed(ahead.values()), 1):
            if not n % 12:  # what the plans of some rules held, on the driver and of shuffles, goes while the next run
                release(model.spark)
    model.forget()
    return local(model.spark, [ahead[k].result() for k in range(len(rules))], SCHEMA)


def summary(report: DataFrame) -> DataFrame:
    """Counts by severity; ok means no error."""
    n = lambda s: F.count_if(F.col("severity") == s)
    return report.agg(n("error").alias("errors"), n("warn").alias("warnings"), n("pass").alias("passed"), n("skip").alias("skipped"), (n("error") == 0).alias("ok"))


def gate(report: DataFrame, review: DataFrame | None = None, least_confidence: float | None = None) -> DataFrame:
    """may_export: no error and no review item that needs one and isn't acknowledged (of the stated confidence or more)."""
    ok = report.agg((F.count_if(F.col("severity") == "error") == 0).alias("ok"))
    if review is None:
        return ok.select(F.col("ok").alias("may_export"))
    waiting = review.where("needs_review and not coalesce(acknowledged, false)")
    if least_confidence is not None:
        waiting = waiting.where(F.coalesce(F.nullif("confidence", F.lit(0.0)), F.lit(1.0)) >= least_confidence)
    return ok.crossJoin(waiting.agg(F.count("*").alias("n"))).select((F.col("ok") & (F.col("n") == 0)).alias("may_export"))
