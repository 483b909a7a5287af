"""Classification by agreement, keywords and learned descriptions; guarded lookups; payload rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equipment families by the letters of a tag, by words in a description, the most particular first, and by category (fixed values).
TAG_FAMILIES = {"AC": "fan_coil", "ACCU": "condensing_unit", "ACC": "condensing_unit", "AHU": "ahu", "RTU": "rtu", "FCU": "fan_coil", "EF": "exhaust_fan", "ERV": "erv", "VAV": "vav_box", "HP": "heat_pump", "P": "pump", "B": "boiler", "CH": "chiller"}
TEXT_FAMILIES = [
    (r"(?i)fan\s*coil", "fan_coil"),
    (r"(?i)chiller", "chiller"),
    (r"(?i)boiler", "boiler"),
    (r"(?i)heat\s*pump", "heat_pump"),
    (r"(?i)air\s*handl|\bAHU\b", "ahu"),
    (r"(?i)\bRTU\b|rooftop", "rtu"),
    (r"(?i)\bVAV\b", "vav_box"),
    (r"(?i)supply\s*diffuser", "supply_diffuser"),
    (r"(?i)return\s*diffuser", "return_diffuser"),
    (r"(?i)exhaust", "exhaust_fan"),
    (r"(?i)energy\s*recovery|\bERV\b", "erv"),
    (r"(?i)condens(?:ing|er)\s*unit", "condensing_unit"),
    (r"(?i)heat(?:ing)?\s*coil", "heating_coil"),
    (r"(?i)cool(?:ing)?\s*coil", "cooling_coil"),
    (r"(?i)\bcoil\b", "coil"),
    (r"(?i)air\s*separator", "air_separator"),
    (r"(?i)expansion\s*tank", "expansion_tank"),
    (r"(?i)\bfan\b", "fan"),
    (r"(?i)\bpump\b", "pump"),
    (r"(?i)diffuser|grille|grill|louver", "terminal"),
]
CATEGORY_FAMILIES = [(r"(?i)\btanks?,?\s+reservoirs\b", "tank")]
FANS = ("exhaust_fan", "fan")


def equipment_family(tag: Column, text: Column, category: Column | None = None) -> Column:
    """struct(family, confidence): tag and text agree, high; both fans, the exhaust fan if either is one, high; they differ, none and low;
    one alone, medium; neither, the category's, medium; else none."""
    from planweave.functions.text import first_rule

    letters = F.regexp_replace(F.regexp_extract(tag, r"^([A-Z][A-Z0-9]{0,5})-\d+[A-Za-z]?$", 1), r"\d+$", "")
    by_tag = F.try_element_at(F.create_map(*[F.lit(x) for kv in TAG_FAMILIES.items() for x in kv]), letters)
    by_text, by_category = first_rule(text, TEXT_FAMILIES), first_rule(F.lit(None).cast("string") if category is None else category, CATEGORY_FAMILIES)
    s = lambda f, c: F.struct(f.alias("family"), F.lit(c).alias("confidence"))
    either = (by_tag == FANS[0]) | (by_text == FANS[0])
    return (
        F.when(by_tag == by_text, s(by_tag, "high"))
        .when(by_tag.isin(*FANS) & by_text.isin(*FANS), s(F.when(either, F.lit(FANS[0])).otherwise(F.lit(FANS[1])), "high"))
        .when(by_tag.isNotNull() & by_text.isNotNull(), s(F.lit(None).cast("string"), "low"))
        .when(F.coalesce(by_tag, by_text, by_category).isNotNull(), s(F.coalesce(by_tag, by_text, by_category), "medium"))
        .otherwise(s(F.lit(None).cast("string"), "none"))
    )


# Construction classes by what a text names; framing governs over cladding (fixed values).
WALL_FRAMING = [
    (r"metal\s+building|pre-?engineered|insulated\s+metal\s+panel|\bimp\b", "Metal Building"),
    (r"(steel|metal|mtl\.?|light[- ]gau?ge|cold[- ]formed)\s+(stud|framing|framed)", "SteelFramed"),
    (r"wood\s+(stud|framing|framed)|\b2\s*x\s*[468]\s+stud", "WoodFramed"),
]
WALL_MASS = r"\bcmu\b|concrete|masonry|\bbrick\b|\bblock\b|tilt[- ]?up|precast|\bmass\s+wall"
ROOF_CLASSES = [
    (r"\biead\b|(insulation|insul\.?)\s+(entirely\s+)?above\s+(the\s+)?deck|rigid\s+(roof\s+)?insulation\s+(on|over)\s+(metal|steel|concrete)\s+deck", "IEAD"),
    (r"metal\s+building|standing\s+seam", "Metal Building"),
    (r"\battic\b|wood\s+(joist|truss)", "Attic and Other"),
]


def construction_class(text: Column, surface: Column) -> Column:
    """struct(value, reason) of the one construction class that a text names for a wall or roof; several are ambiguous."""
    from planweave.functions.text import exactly_one_rule

    t = F.lower(F.coalesce(text, F.lit("")))
    wall, roof = exactly_one_rule(t, WALL_FRAMING), exactly_one_rule(t, ROOF_CLASSES)
    mass = F.struct(F.lit("Mass").alias("value"), F.lit(None).cast("string").alias("reason"))
    return F.when(surface == "ExteriorWall", F.when((wall.reason == "none") & t.rlike(WALL_MASS), mass).otherwise(wall)).when(surface == "ExteriorRoof", roof).otherwise(F.struct(F.lit(None).cast("string").alias("value"), F.lit("surface").alias("reason")))


# Conductivities in W/mK by the words that a material's name must have (fixed values); names of air have none.
CONDUCTIVITIES = [
    (["gypsum"], 0.16), (["plasterboard"], 0.16), (["drywall"], 0.16), (["plywood"], 0.12), (["osb"], 0.091), (["oriented", "strand"], 0.091), (["fiberboard"], 0.07), (["wood"], 0.15), (["timber"], 0.15), (["brick"], 0.89),
    (["concrete"], 1.95), (["lightweight", "concrete"], 0.53), (["concrete", "block"], 1.11), (["cmu"], 1.11), (["lightweight", "concrete", "block"], 0.50), (["stucco"], 0.72), (["render"], 0.72), (["stone"], 3.17),
    (["metal"], 45.28), (["steel"], 45.28), (["mineral", "wool"], 0.05), (["rock", "wool"], 0.05), (["glass", "wool"], 0.05), (["fiberglass"], 0.05), (["batt"], 0.05), (["insulation", "board"], 0.03), (["eps"], 0.036),
    (["xps"], 0.029), (["extruded", "polystyrene"], 0.029), (["polyiso"], 0.0245), (["polyisocyanurate"], 0.0245), (["pir"], 0.0245), (["polyurethane"], 0.0245), (["cellular", "glass"], 0.05),
]
AIR_WORDS = r"(?i)\b(air|cavity|void|gap)\b"


def conductivities(materials: DataFrame, id: str = "id", name: str = "name") -> DataFrame:
    """id, value: the conductivity that a material's name stands for; null for air, unknown and ambiguous names."""
    table = materials.sparkSession.createDataFrame(CONDUCTIVITIES, "keys array<string>, value double")
    named = materials.select(id, F.when(~F.col(name).rlike(AIR_WORDS), F.col(name)).alias("_name"))
    return keyword_lookup(named, table, id, "_name").select(id, "value")


# Units by the slot that they name, and families by what an unqualified unit can mean on them (fixed values).
AIRFLOW_UNITS = {"cfm": "CFM", "l/s": "L/s"}
WATER_UNITS = {"gpm": "GPM"}
POWER_UNITS = {"kw": "kW", "w": "W", "watt": "W", "watts": "W"}
HEAD_UNITS = {"ft": "ft", "m": "m", "kpa": "kPa", "psi": "psi"}
NO_UNITS = ("x", "mm", "cm", "m", "ft", "in")
THERMAL_FAMILIES = {"chiller": "cooling_capacity", "boiler": "heating_capacity", "cooling_coil": "cooling_capacity", "heating_coil": "heating_capacity"}
AMBIGUOUS_FAMILIES = ("coil", "heat_pump", "ahu", "fan_coil", "condensing_unit", "erv", "rtu")
POWER_FAMILIES = ("pump", "fan", "exhaust_fan", "vav_box", "ahu", "erv")


def value_slot(family: Column, unit: Column, qualifier: Column) -> Column:
    """struct(slot, unit, confidence, reason) of a stated value: the unit names the slot, else the qualifier, else the family, else a reason; dimensions have none of these."""
    from planweave.functions.text import CAPACITY_UNITS

    u = F.lower(unit)
    known = lambda m: F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), u)
    told = lambda slot, unit_, sure: F.struct(slot.alias("slot"), unit_.alias("unit"), F.lit(sure).alias("confidence"), F.lit(None).cast("string").alias("reason"))
    none = F.lit(None).cast("string")
    refused = lambda why: F.struct(none.alias("slot"), none.alias("unit"), none.alias("confidence"), (F.lit(why) if why else none).alias("reason"))
    thermal = known(CAPACITY_UNITS)
    q, capacity = qualifier, F.concat(qualifier, F.lit("_capacity"))
    by_family = F.try_element_at(F.create_map(*[F.lit(x) for kv in THERMAL_FAMILIES.items() for x in kv]), family)
    heating = F.coalesce(q.isin("cooling", "heating"), F.lit(False))
    return (
        F.when(known(AIRFLOW_UNITS).isNotNull(), told(F.when(q == "min", "airflow_min").when(q == "max", "airflow_max").otherwise("airflow"), known(AIRFLOW_UNITS), "high"))
        .when(known(WATER_UNITS).isNotNull(), told(F.lit("water_flow"), known(WATER_UNITS), "high"))
        .when(known(POWER_UNITS).isNotNull(), F.when(q == "motor", told(F.lit("power"), known(POWER_UNITS), "high")).when(heating, told(capacity, known(POWER_UNITS), "high")).when(family.isin(*POWER_FAMILIES), told(F.lit("power"), known(POWER_UNITS), "medium")).otherwise(refused("power or thermal capacity")))
        .when(known(HEAD_UNITS).isNotNull(), F.when(q == "head", told(F.lit("head"), known(HEAD_UNITS), "high")).otherwise(refused(None)))
        .when(u.isin(*NO_UNITS), refused(None))
        .when(heating, told(capacity, thermal, "high"))
        .when(by_family.isNotNull(), told(by_family, thermal, "medium"))
        .when(family.isin(*AMBIGUOUS_FAMILIES), refused("cooling or heating"))
        .otherwise(refused("no slot"))
    )


# Rooms by their evidence: the first rule that holds, with how sure it is (fixed values).
def polygon_class(area: Column, has_number: Column, label: Column, adjacent: Column, doors: Column, aspect: Column) -> Column:
    """struct(kind, confidence) of a room polygon: area and number first, then the label's words, then neighbours, doors and shape."""
    t = F.lower(F.coalesce(label, F.lit("")))
    told = lambda kind, sure: F.struct(F.lit(kind).alias("kind"), F.lit(sure).alias("confidence"))
    return (
        F.when((area < 2) & ~has_number, told("shaft", 0.95))
        .when((area >= 2) & (area < 8) & ~has_number, told("closet", 0.90))
        .when(has_number & (area >= 8), told("room", 0.95))
        .when(has_number & (area < 8), told("room", 0.80))
        .when(t.rlike("elev"), told("elevator_core", 0.90))
        .when(t.rlike("stair"), told("elevator_core", 0.90))
        .when(t.rlike("shaft|chase"), told("shaft", 0.90))
        .when(t.rlike("closet|storage|utility"), told("closet", 0.85))
        .when((adjacent > 2) & (area < 15), told("room", 0.75))
        .when((doors > 2) & (area < 15), told("room", 0.85))
        .when((aspect > 5) & (area < 20), told("shaft", 0.88))
        .when((aspect > 3) & (area < 10), told("closet", 0.88))
        .when(area < 4, told("closet", 0.70))
        .otherwise(told("unassigned", 0.50))
    )


def keyword_lookup(rows: DataFrame, table: DataFrame, id: str, text: str, keys: str = "keys", value: str = "value") -> DataFrame:
    """id, value, reason: entries all of whose key words are in the text, without those whose words another's include; one distinct value or none.

    table.keys holds distinct words in lower case; rows meet entries by a shared word, not all by all.
    """
    r = rows.select(F.col(id), F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1))).alias("words"))
    e = table.select(F.array_sort(keys).alias("keys"), F.col(value).alias("value")).withColumn("first", F.col("keys")[0])
    hit = r.select(id, "words", F.explode("words").alias("first")).join(e, "first").where(F.size(F.array_except("keys", "words")) == 0)
    g = hit.groupBy(id).agg(F.collect_set(F.struct("keys", "value")).alias("h"))
    inside = lambda a, b: (F.size(F.array_except(a.keys, b.keys)) == 0) & (F.size(a.keys) < F.size(b.keys))
    kept = F.filter("h", lambda a: ~F.exists("h", lambda b: inside(a, b)))
    g = g.withColumn("v", F.array_distinct(F.transform(kept, lambda a: a.value)))
    out = rows.select(id).join(g.select(id, "v"), id, "left")
    return out.select(id, F.when(F.size("v") == 1, F.col("v")[0]).alias("value"), F.when(F.col("v").isNull(), F.lit("unknown")).when(F.size("v") > 1, F.lit("ambiguous")).alias("reason"))


def learned_or_rules(rows: DataFrame, learned: DataFrame, text: str, rules: list[tuple[str, str]], key: str = "description", kind: str = "kind") -> DataFrame:
    """rows with kind: what was learned for the very description, else the first rule that fits, else null."""
    from planweave.functions.text import first_rule

    k = learned.where(F.col(kind).isNotNull()).select(F.lower(F.trim(key)).alias("_k"), F.col(kind).alias("_v"))
    return rows.join(k, F.lower(F.trim(F.col(text))) == F.col("_k"), "left").withColumn(kind, F.coalesce("_v", first_rule(text, rules))).drop("_k", "_v")


def heated_slabs(equipment: DataFrame, tag: str = "tag", cells: str = "values") -> DataFrame:
    """tags, rooms: rows that tell of a heated floor; rooms only if every such row names one.

    Words of melting or cooling alone rule a row out.
    """
    text = F.lower(F.concat_ws(" ", F.map_values(cells)))
    is_one = text.rlike(r"radiant|in[- ]?floor|heated (slab|floor)|floor heating|hydronic slab") & ~text.rlike(r"snow|melt|ceiling") & ~(text.rlike(r"cool") & ~text.rlike(r"heat"))
    serving = F.map_filter(cells, lambda k, v: k.rlike(r"(?i)serv|room|space"))
    rooms = F.regexp_extract_all(F.concat_ws(" ", F.map_values(serving)), F.lit(r"\b([A-Z]?\d{2,4}[A-Z]?)\b"), F.lit(1))
    d = equipment.where(is_one).select(F.col(tag).alias("tag"), rooms.alias("r"))
    every = F.bool_and(F.size("r") > 0)
    return d.agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"), F.when(every, F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("r")))), ",")).alias("rooms"))


def payload_violations(payloads: DataFrame, id: str, body: str, known: list[str], required: list[str], excluded: str, longest: int = 200) -> DataFrame:
    """id, violation: unknown, missing and excluded keys of flat JSON payloads, and the first key whose text is too long."""
    p = payloads.select(F.col(id).alias("id"), F.from_json(body, "map<string,string>").alias("m"))
    keys = F.array_sort(F.map_keys("m"))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    long = F.filter(keys, lambda k: F.length(F.try_element_at("m", k)) > longest)
    found = F.concat(
        F.when(F.col("m").isNull(), F.array(F.lit("not an object"))).otherwise(F.array().cast("array<string>")),
        F.coalesce(F.transform(F.array_except(keys, lit(known)), lambda k: F.concat(F.lit("unknown: "), k)), F.array().cast("array<string>")),
        F.coalesce(F.transform(F.array_except(lit(required), keys), lambda k: F.concat(F.lit("missing: "), k)), F.array().cast("array<string>")),
        F.coalesce(F.transform(F.filter(keys, lambda k: k.rlike(excluded)), lambda k: F.concat(F.lit("excluded: "), k)), F.array().cast("array<string>")),
        F.coalesce(F.transform(F.slice(long, 1, 1), lambda k: F.concat(F.lit("too long: "), k)), F.array().cast("array<string>")),
    )
    return p.select("id", F.explode(found).alias("violation"))


def triage(scored: DataFrame, probability: str = "probability", urgency: str = "urgency", sure: float = 0.95) -> DataFrame:
    """scored with needs_human: only what is sure and not urgent resolves itself."""
    auto = (F.col(probability) >= sure) & (F.col(urgency) < 2)
    return scored.withColumn("needs_human", F.coalesce(~auto, F.lit(True)))


def zone_loops(groups: DataFrame, served: DataFrame, loops: DataFrame, group: str = "group", space: str = "space_id", zone: str = "zone", loop: str = "unit") -> DataFrame:
    """group, loop: the loop that all zones serving a group name; spaces that no zone serves don't hinder."""
    z = groups.join(served, space).select(group, zone).distinct().join(loops, zone, "left")
    g = z.groupBy(group).agg(F.count_distinct(loop).alias("n"), F.count_if(F.col(loop).isNull()).alias("none"), F.max(loop).alias("u"))
    return groups.select(group).distinct().join(g, group, "left").select(group, F.when((F.col("n") == 1) & (F.col("none") == 0), F.col("u")).alias(loop))


def exterior_vestibules(rooms: DataFrame, doors: DataFrame, most_m2: float = 15.0, lobby: str = r"(?i)lobby|corridor|hall|reception") -> DataFrame:
    """id of small rooms whose first outer door leads to them and that a lobby-like room lies behind.

    doors: id, room, other (null outside), place (their order).
    """
    small = rooms.where(F.col("area_m2") <= most_m2).select(F.col("id").alias("room"))
    outer = doors.where("other is null").join(small, "room", "left_semi").select("room").distinct()
    beyond = doors.where("other is not null").select("room", "other").unionByName(doors.where("other is not null").select(F.col("other").alias("room"), F.col("room").alias("other")))
    lobbies = rooms.where(F.col("name").rlike(lobby)).select(F.col("id").alias("other"))
    return outer.join(beyond.join(lobbies, "other", "left_semi"), "room", "left_semi").select(F.col("room").alias("id"))


def linings(walls: DataFrame, by: list[str], near: float, share: float = 0.9) -> DataFrame:
    """by, a, b: parallel walls on lines at most `near` apart that overlap over most of the shorter.

    walls: id, angle (whole degrees), offset, lo, hi.
    """
    from planweave.functions.geometry import interval_overlap

    cell = F.floor(F.col("offset") / near)
    a = walls.select(*by, "id", "angle", "offset", "lo", "hi", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    b = walls.select(*by, "angle", cell.alias("cell"), *[F.col(c).alias(f"{c}_b") for c in ("id", "offset", "lo", "hi")])
    j = a.join(b, [*by, "angle", "cell"]).where((F.col("id") < F.col("id_b")) & (F.abs(F.col("offset") - F.col("offset_b")) <= near))
    shorter = F.least(F.col("hi") - F.col("lo"), F.col("hi_b") - F.col("lo_b"))
    return j.where(interval_overlap("lo", "hi", "lo_b", "hi_b") >= share * shorter).select(*by, F.col("id").alias("a"), F.col("id_b").alias("b"))


def atria(rooms: DataFrame, levels: DataFrame, cell: float = 10.0) -> DataFrame:
    """id, from_level, to_level: rooms whose stated top passes higher levels, up to below the first level with a room in their way."""
    from planweave.operators.adjacency import overlaps

    tops = rooms.join(levels.select(F.col("id").alias("level_id"), F.col("elevation_z_m").alias("z")), "level_id").where("top_m is not null")
    # Rooms and levels meet by steps of 4 m of height.
    steps = F.sequence(F.floor(F.col("z") / 4), F.floor((F.col("z") + F.col("top_m")) / 4))
    higher = levels.select(F.col("id").alias("up"), F.col("elevation_z_m").alias("uz"), F.floor(F.col("elevation_z_m") / 4).alias("step"))
    above = tops.where("top_m >= 0").withColumn("step", F.explode(steps)).join(higher, "step").drop("step").where("uz > z + 1e-6 and uz < z + top_m - 1e-6")
    at = above.select(F.col("up").alias("lv"), F.col("id"), "polygon_m")
    there = rooms.select(F.col("level_id").alias("lv"), "id", "polygon_m")
    hit = overlaps(at, there, ["lv"], cell).where("a <> b").join(levels.select(F.col("id").alias("lv"), F.col("elevation_z_m").alias("bz")), "lv").groupBy(F.col("a").alias("id")).agg(F.min("bz").alias("block"))
    free = above.join(hit, "id", "left").where("block is null or uz < block")
    return free.groupBy("id").agg(F.min_by("up", "uz").alias("from_level"), F.max_by("up", "uz").alias("to_level"))
