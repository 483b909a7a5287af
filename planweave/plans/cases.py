"""Functions held against stated values: the SQL of each query is the list of what must come out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.functions import text as T
from planweave.functions import units as U
from planweave.operators import classify as C
from planweave.plans.registry import query
from planweave.query.engine import dispatch_column

_DUCK = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


def _literal(v, kind: str) -> str:
    if v is None:
        return f"CAST(NULL AS {_DUCK[kind]})"
    return f"CAST('{str(v).replace(chr(39), chr(39) * 2)}' AS {_DUCK[kind]})"


def cases(name: str, doc: str, inputs: str, outputs: str, rows: list[tuple], made: Callable[[], list[Column]]) -> None:
    """Register a query of `made` over the rows' inputs, with a number; its SQL lists the rows' outputs."""
    split = lambda s: [tuple(f.split()) for f in s.split(", ")]
    into, out = split(inputs), split(outputs)
    values = ", ".join("(" + ", ".join([f"{i}::BIGINT", *(_literal(v, k) for v, (_, k) in zip(r[len(into) :], out))]) + ")" for i, r in enumerate(rows))

    def build(t):
        given = t.spark.createDataFrame([(i, *r[: len(into)]) for i, r in enumerate(rows)], f"id bigint, {inputs}")
        return given.select("id", *[(F.round(c, 6) if k == "double" else c.cast(k)).alias(n) for c, (n, k) in zip(made(), out)])

    build.__doc__ = doc
    query(f"SELECT * FROM (VALUES {values}) v(id, {', '.join(n for n, _ in out)})", name)(build)


FT = 0.3048
m = lambda x: round(x, 6)
cases("text_length", "Written lengths in metres; what is none is null.", "text string", "metres double", [
    ("12'-6\"", m(12.5 * FT)), ("12'-6 1/2\"", m(150.5 / 12 * FT)), ("12' 6\"", m(12.5 * FT)), ("3'", m(3 * FT)), ('6"', m(0.5 * FT)), ('1 1/2"', m(1.5 * 0.0254)), ("10’-11 3/4”", m(131.75 / 12 * FT)), ("3600 mm", 3.6), ("3.6 m", 3.6), ("90 cm", 0.9), ("4'-½\"", m((48.5) * 0.0254)),
    ("101", None), ("A-101", None), ("12'-14\"", None), ("OFFICE", None), ("", None), (None, None),
], lambda: [T.length_m("text")])
cases("text_scale", "Scale notes: how many times larger, or not to scale.", "text string", "ratio double, nts boolean", [
    ("SCALE: 1/8\" = 1'-0\"", 96, False), ("1/4\"=1'-0\"", 48, False), ("3/32\" = 1’-0”", 128, False), ("1 1/2\" = 1'-0\"", 8, False), ("SCALE: 1\" = 20'-0\"", 240, False), ("1\" = 20'", 240, False), ("SCALE 1:100", 100, False), ("1:50", 50, False),
    ("N.T.S.", None, True), ("SCALE: NOT TO SCALE", None, True), ("SCALE: AS NOTED", None, False), ("ROOM 1:1", None, False), ("12'-6\"", None, False), (None, None, False),
], lambda: [T.scale_note("text").ratio, T.scale_note("text").nts])
cases("text_sheet_number", "Sheet numbers in their canonical form; other texts and unknown letters are none.", "text string", "number string, discipline string, sequence string, type_digit string", [
    ("A-101", "A-101", "A", "101", "1"), ("A101", "A-101", "A", "101", "1"), ("M-601", "M-601", "M", "601", "6"), ("A1.01", "A-1.01", "A", "101", "1"), ("FP-101", "FP-101", "F", "101", "1"), ("A-501A", "A-501A", "A", "501A", "5"), ("E-1", "E-1", "E", "1", None),
    *[(x, None, None, None, None) for x in ("101", "OFFICE", "5/A-501", "A-101 FIRST", "K-101", "12'-6\"", None)],
], lambda: [T.sheet_number("text")[c] for c in ("number", "discipline", "sequence", "type_digit")])
cases("text_sheet_type", "Sheet types by title.", "text string", "kind string", [
    ("FIRST FLOOR PLAN", "floor_plan"), ("FIRST FLOOR REFLECTED CEILING PLAN", "rcp"), ("ENLARGED TOILET PLANS", "enlarged_plan"), ("PARTIAL FIRST FLOOR PLAN - AREA A", "partial_plan"), ("FIRST FLOOR PLAN - AREA B", "partial_plan"), ("ROOF PLAN", "roof_plan"), ("SITE PLAN", "site_plan"),
    ("BUILDING ELEVATIONS", "elevation"), ("WALL SECTIONS", "section"), ("MECHANICAL SCHEDULES", "schedule"), ("DOOR AND WINDOW SCHEDULE", "schedule"), ("TYPICAL DETAILS", "detail"), ("PLUMBING RISER DIAGRAM", "diagram"), ("SYMBOLS AND ABBREVIATIONS", "general"), ("COVER SHEET", "cover"), ("MEDICAL CLINIC", None),
], lambda: [T.sheet_type("text")])
cases("text_level", "Levels by title.", "text string", "level string", [
    ("FIRST FLOOR PLAN", "L1"), ("GROUND FLOOR PLAN", "L1"), ("SECOND FLOOR MECHANICAL PLAN", "L2"), ("3RD FLOOR PLAN", "L3"), ("LEVEL 02 PLAN", "L2"), ("LEVEL B1 PLAN", "B1"), ("BASEMENT PLAN", "B1"), ("MEZZANINE PLAN", "MEZZ"), ("ROOF PLAN", "ROOF"), ("PENTHOUSE PLAN", "PH"), ("LOWER LEVEL PLAN", "B1"), ("BUILDING ELEVATIONS", None),
], lambda: [T.level_of_title("text")])
cases("text_room_label", "Room labels: name, number and how sure.", "text string", "name string, number string, confidence double", [
    ("OPEN OFFICE 201", "OPEN OFFICE", "201", 0.95), ("RM 301", "", "301", 1.0), ("101", "", "101", 1.0), ("LOBBY", "LOBBY", "", 0.9), ("2O5", "", "205", 1.0), ("not a room label at all!", "NOT A ROOM LABEL AT ALL!", "", 0.5), ("RESTRO0M 105", "RESTROOM", "105", 0.95), ("0FFICE 201", "OFFICE", "201", 0.95),
    ("C0RRIDOR", "CORRIDOR", "", 0.9), ("OPEN 0FFICE 201", "OPEN OFFICE", "201", 0.95), ("201A", "", "201A", 1.0), ("C1", "", "C1", 1.0), ("B-102", "B", "102", 0.95), ("B2", "", "B2", 1.0), ("W12X72", "W12", "X72", 0.95), ("", "", "", 0.0), (None, "", "", 0.0),
], lambda: [T.room_label("text")[c] for c in ("name", "number", "confidence")])
cases("text_dimension", "Texts that are dimensions.", "text string", "dimension boolean", [("5 X 5", True), ("W12X72", True), ("17'-6\"", True), ("1/2\"", True), ("@ 16 O.C.", True), ("120 SF", True), ("RESTRO0M 105", False), ("OPEN OFFICE 201", False), (None, False)], lambda: [T.looks_like_dimension("text")])
cases("text_space_type", "Space types by room name.", "text string, poly_type string", "kind string, confidence double", [
    *[(n, "room", k, 0.7) for n, k in (("OPEN OFFICE", "open_office"), ("OFFICE 101", "closed_office"), ("CONF. RM", "conference"), ("ELEVATOR LOBBY", "elevator_lobby"), ("LOBBY", "lobby"), ("MEN'S TOILET", "restroom"), ("ELEC.", "mechanical_electrical"), ("IDF", "it_room"), ("CORRIDOR", "corridor"), ("STAIR 2", "stair"), ("BREAK ROOM", "break_room"), ("RESTROOM", "restroom"), ("OFFICE", "closed_office"))],
    ("ROOM 7", "room", "office_whole_building", 0.4), ("RESTRO0M", "room", "office_whole_building", 0.4), ("SHAFT", "shaft", None, 0.0), ("", "elevator_core", None, 0.0), ("CL", "closet", "storage", 0.7),
], lambda: [T.space_type("text", "poly_type").type, T.space_type("text", "poly_type").confidence])
cases("text_storey", "Storeys that level marks name.", "text string", "ordinal int", [("FIRST FLOOR", 1), ("GROUND FLOOR", 1), ("2ND FLOOR", 2), ("LEVEL 3", 3), ("5TH FLOOR", 5), ("BASEMENT", 0), ("ROOF", None), (None, None)], lambda: [T.storey_ordinal("text")])
cases("text_facade", "Facades by title.", "text string", "facade string", [
    ("SOUTH ELEVATION", "south"), ("NORTH  ELEVATION", "north"), ("East Elevation", "east"), ("EXTERIOR ELEVATIONS", None), ("NORTH & SOUTH ELEVATIONS", None), ("FIRST FLOOR PLAN", None), ("SOUTH ELEVATION - EAST HALF", "south"), ("EAST ELEVATION - NORTH HALF", "east"), (None, None),
], lambda: [T.facade_of_title("text")])
cases("text_tag", "Equipment tags in component names.", "text string", "tag string", [("AC Unit Type 1 AC-1", "AC-1"), ("Fan- EF1-1", "EF1-1"), ("ACCU-1", "ACCU-1"), ("AHU-1 of AHU-2", "AHU-2"), ("Supply Diffuser 600 Face 1A02", None), (None, None)], lambda: [T.equipment_tag("text")])
cases("text_capacity", "Stated capacities, unconverted.", "text string", "value double, unit string, raw string", [
    ("63300000 J", 63300000.0, "J", "63300000 J"), ("633-703 kW", None, "kW", "633-703 kW"), ("600 x 600 Face 300 x 300 Connection", None, None, None), ("200 mm", None, None, None), ("", None, None, None), (None, None, None, None), ("5 tons", 5.0, "ton", "5 tons"),
    ("cooling capacity 12000 kJ/h", 12000.0, "kJ/h", "12000 kJ/h"), ("10000-12000 kJ/h", None, "kJ/h", "10000-12000 kJ/h"), ("2500 Watt", 2500.0, "W", "2500 Watt"), ("2.5 kW", 2.5, "kW", "2.5 kW"), ("200 mm, 1,200 CFM", 1200.0, "CFM", "1,200 CFM"),
], lambda: [T.capacity("text")[c] for c in ("value", "unit", "raw")])
cases("text_number", "First numbers.", "text string", "value double", [("1,250 cfm", 1250.0), ("about 3.5", 3.5), ("none", None), (None, None)], lambda: [T.number("text")])
cases("text_size", "Sizes of two lengths.", "text string", "width_m double, height_m double", [("3'-0\" x 7'-0\"", 0.9144, 2.1336), ("900 mm X 2100 mm", 0.9, 2.1), ("3'-0\"", None, None), ("a x b", None, None)], lambda: [T.size_m("text").width_m, T.size_m("text").height_m])
cases("text_level_key", "Level ids in order.", "text string", "key double", [("B2", -1.0), ("B1", 0.0), ("L1", 1.0), ("L12", 12.0), ("MEZZ", 9000.0), ("ROOF", 9001.0), ("PH", 9002.0), ("X", None)], lambda: [T.level_key("text")])
cases("text_thermal", "Stated U, SHGC and VT of schedule rows.", "u_head string, u string, shgc string, vt string, feet boolean", "u_w_m2k double, u_confidence double, s double, v double", [
    ("U-FACTOR (BTU/HR-SF-F)", "0.36", "0.38", "0.42", True, round(0.36 * 5.678263, 4), 0.9, 0.38, 0.42), ("u_value_w_m2k", "2.0", "0.38", "", False, 2.0, 0.9, 0.38, None), ("U-FACTOR", "0.36", "1.5", "0.42", True, round(0.36 * 5.678263, 4), 0.75, None, 0.42), ("U-FACTOR", "0.36", "0", "1", False, None, None, None, 1.0), ("MARK", "0.36", "0.5", "0.5", True, None, None, 0.5, 0.5),
], lambda: [T.thermal_fields(F.array("u_head", F.lit("SHGC"), F.lit("VT")), F.array("u", "shgc", "vt"), "feet")[c] for c in ("u_w_m2k", "u_confidence", "shgc", "vt")])
cases("zone_thresholds", "Heating thresholds of climate zones.", "zone string", "thresholds string, number string", [
    ("0A", "5.0", "0"), ("1", "5.0", "1"), ("2B", "5.0", "2"), ("3A", "9.0", "3"), ("3C", "7.0", "3"), ("3", "7.0,9.0", "3"), ("4b", "10.0", "4"), ("4C", "8.0", "4"), ("4", "8.0,10.0", "4"), ("5A", "12.0", "5"), ("CZ6", "14.0", "6"), ("7", "16.0", "7"), ("8", "19.0", "8"),
    ("", "5.0,7.0,8.0,9.0,10.0,12.0,14.0,16.0,19.0", None), ("9", None, None), ("4D", None, None), ("hot", None, None), ("A4", None, None),
], lambda: [F.array_join(T.heated_thresholds("zone").cast("array<string>"), ","), T.climate_zone_number("zone")])
cases("unit_btuh", "Capacities in Btu/h.", "value double, unit string", "btuh double", [(12.0, "MBH", 12000.0), (12000.0, "BTUH", 12000.0), (12000.0, "Btu/h", 12000.0), (3.0, "tons", 36000.0), (1.0, "kW", 3412.141633), (100.0, "W", 341.214163), (None, "W", None)], lambda: [U.to_btuh("value", "unit")])
cases("unit_same_quantity", "Whether two stated values are one quantity.", "a double, unit_a string, b double, unit_b string", "same boolean", [(10.0, "kW", 10000.0, "W", True), (10.0, "kW", 10050.0, "W", False), (1.0, "MJ", 1000.0, "kJ", True), (5.0, "ft", 5.0, "CFM", True), (5.0, "CFM", 6.0, "ft", False)], lambda: [U.same_quantity("a", "unit_a", "b", "unit_b")])
cases("unit_air_layer", "Resistance of still air layers.", "thickness_m double", "sideways double, up double", [(0.005, 0.11, 0.11), (0.006, 0.12, 0.12), (0.02, 0.175, 0.16), (0.3, 0.18, 0.16), (0.31, None, None), (0.0, None, None), (None, None, None)], lambda: [U.air_layer_resistance("thickness_m"), U.air_layer_resistance("thickness_m", "upward")])
cases("unit_lighting_watts", "Fixture watts, else density times area.", "w double, lpd double, area double", "watts double", [(64.0, 9.0, 10.0, 64.0), (0.0, 9.0, 10.0, 90.0), (None, 9.0, 10.0, 90.0)], lambda: [U.watts_of("w", "lpd", "area")])
cases("unit_layer", "What is left of 1/U less the films.", "u double", "r double", [(0.5, 1.85), (1.0, 0.85), (10.0, None), (0.0, None), (None, None)], lambda: [U.layer_resistance("u", 0.15)])
cases("compass_points", "Bearings in eight sectors and four quarters.", "bearing double", "point string, facing string, quarter string", [
    (0.0, "N", "north", "N"), (22.4, "N", "north", "N"), (22.5, "NE", "north", "N"), (45.0, "NE", "east", "E"), (90.0, "E", "east", "E"), (134.9, "SE", "east", "E"), (135.0, "SE", "south", "S"), (180.0, "S", "south", "S"), (225.0, "SW", "west", "W"), (270.0, "W", "west", "W"), (315.0, "NW", "north", "N"), (337.5, "N", "north", "N"), (-90.0, "W", "west", "W"), (720.0, "N", "north", "N"), (None, "unknown", None, None),
], lambda: [G.cardinal("bearing"), G.facing("bearing"), G.quadrant("bearing")])
cases("plane_buckets", "The quarter that a plane faces, and its normal.", "tilt double, azimuth double", "bucket string, east double, north double, up double", [(0.4, 90.0, "flat", m(0.006981260), 0.0, m(0.999975631)), (90.0, 90.0, "E", 1.0, 0.0, 0.0), (90.0, 180.0, "S", 0.0, -1.0, 0.0), (30.0, 0.0, "N", 0.0, 0.5, m(0.8660254038)), (None, 10.0, "flat", None, None, None), (45.0, None, "flat", 0.0, m(0.7071067812), m(0.7071067812))], lambda: [G.orientation_bucket("tilt", "azimuth"), *[F.round(c, 6) + 0.0 for c in G.plane_normal("tilt", "azimuth")]])
cases("edge_azimuths", "Outward azimuths of the edges of a ring.", "x0 double, y0 double, x1 double, y1 double", "azimuth double", [(0.0, 0.0, 1.0, 0.0, 180.0), (1.0, 0.0, 1.0, 1.0, 90.0), (1.0, 1.0, 0.0, 1.0, 0.0), (0.0, 1.0, 0.0, 0.0, 270.0)], lambda: [G.outward_azimuth("x0", "y0", "x1", "y1")])
cases("equipment_families", "Families by tag and text.", "tag string, text string, category string", "family string, confidence string", [
    ("AC-1", "Fan Coil unit", "", "fan_coil", "high"), ("AHU-1", "Air handling unit", "", "ahu", "high"), ("EF1-1", "exhaust fan", "", "exhaust_fan", "high"), ("EF-2", "roof fan", "", "exhaust_fan", "high"), ("", "VAV 200 mm", "", "vav_box", "medium"), ("HP-1", "", "", "heat_pump", "medium"), ("ERV-1", "energy recovery", "", "erv", "high"), ("ACCU-1", "condensing unit", "", "condensing_unit", "high"),
    ("P-1", "boiler", "", None, "low"), ("", "Boilout", "tanks, reservoirs", "tank", "medium"), ("", "desk", "furniture", None, "none"), ("XX-1", "Supply Diffuser", "", "supply_diffuser", "medium"), ("", "expansion tank", "", "expansion_tank", "medium"),
], lambda: [C.equipment_family(F.col("tag"), F.col("text"), F.col("category"))[c] for c in ("family", "confidence")])
cases("construction_classes", "Construction classes named by texts.", "text string, surface string", "class string", [
    ("brick veneer on steel stud", "ExteriorWall", "SteelFramed"), ("8in CMU", "ExteriorWall", "Mass"), ("wood framed wall", "ExteriorWall", "WoodFramed"), ("insulated metal panel", "ExteriorWall", "Metal Building"), ("steel framing and wood stud", "ExteriorWall", None), ("curtain wall", "ExteriorWall", None),
    ("insulation above deck", "ExteriorRoof", "IEAD"), ("standing seam", "ExteriorRoof", "Metal Building"), ("attic with wood truss", "ExteriorRoof", "Attic and Other"), ("membrane", "ExteriorRoof", None), ("concrete", "Floor", None), (None, "ExteriorWall", None),
], lambda: [C.construction_class(F.col("text"), F.col("surface")).value])
cases("nl_dispatch", "Questions to the method of the first pattern that fits.", "question string", "method string", [
    *[(q, "count_spaces") for q in ("how many spaces are there", "count the spaces", "count spaces", "number of spaces", "COUNT Spaces", "HOW MANY SPACES")], *[(q, "total_floor_area") for q in ("total floor area", "floor area", "conditioned area", "what is the total floor area")],
    *[(q, "building_orientation") for q in ("building orientation", "orientation of the building", "which direction does the building face", "compass bearing")], *[(q, "zone_list") for q in ("zones", "list zones", "thermal zones", "zone list", "list all zones")], *[(q, "envelope_summary") for q in ("envelope summary", "window to wall ratio", "wwr", "window area")], ("what is the meaning of life", None), (None, None),
], lambda: [dispatch_column(F.col("question"))])
_MATERIALS = [("13mm gypsum board", 0.16), ("Lightweight concrete block", 0.5), ("concrete block", 1.11), ("concrete", 1.95), ("brick veneer", 0.89), ("brick and wood", None), ("air gap", None), ("mineral wool batt", 0.05), ("unobtainium", None), (None, None)]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {_literal(v, 'double')})" for i, (_, v) in enumerate(_MATERIALS)) + ") v(id, value)")
def material_conductivity(t):
    """Conductivities of materials by name."""
    return C.conductivities(t.spark.createDataFrame([(i, n) for i, (n, _) in enumerate(_MATERIALS)], "id bigint, name string"))
