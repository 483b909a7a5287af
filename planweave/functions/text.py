"""Text expressions: tags, names, sheet numbers, levels, lengths, ordered pattern rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOOT_M = 0.3048
INCH_M = 0.0254


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_tag(tag) -> Column:
    """All white space gone, upper case; null becomes the empty tag."""
    return F.upper(F.regexp_replace(F.coalesce(_c(tag).cast("string"), F.lit("")), r"\s+", ""))


def normalize_name(name) -> Column:
    """Trimmed, upper case, runs of white space as one space."""
    return F.upper(F.regexp_replace(F.trim(_c(name)), r"\s+", " "))


def name_tokens(name) -> Column:
    """The distinct words of a normalised name, in order; none for an empty name."""
    return F.filter(F.array_distinct(F.split(normalize_name(name), " ")), lambda t: t != "")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets given as arrays; 0 where both are empty."""
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0))


def first_rule(text, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The value of the first rule (pattern, value) whose pattern is found, in the order given."""
    out = None
    for pattern, value in rules:
        hit = _c(text).rlike(pattern)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def exactly_one_rule(text, rules: list[tuple[str, str]]) -> Column:
    """struct(value, reason): the value of the only rule that matches, else null and why."""
    hits = F.array_distinct(F.filter(F.array(*[F.when(_c(text).rlike(p), F.lit(v)) for p, v in rules]), lambda x: x.isNotNull()))
    n = F.size(hits)
    return F.struct(F.when(n == 1, hits[0]).alias("value"), F.when(n == 0, F.lit("none")).when(n > 1, F.lit("ambiguous")).alias("reason"))


def number(text) -> Column:
    """The first number of a text, thousands separated by commas or not."""
    return F.regexp_replace(F.regexp_extract(_c(text), r"[-+]?[0-9][0-9,]*(?:[.][0-9]+)?", 0), ",", "").try_cast("double")


def _float(x: Column) -> Column:
    return x.try_cast("double")


def _let(value: Column, f) -> Column:
    """f of a value that is worked out once; a plain nesting would repeat its expression wherever f uses it."""
    return F.transform(F.array(value), f)[0]


def _group(t: Column, pattern: str, i: int) -> Column:
    """A group of the first match, null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(t, pattern, i), F.lit(""))


FRACTIONS = {"½": " 1/2", "¼": " 1/4", "¾": " 3/4", "⅛": " 1/8", "⅜": " 3/8", "⅝": " 5/8", "⅞": " 7/8"}


def drawing_text(text) -> Column:
    """Straight quotes and hyphens, written-out fractions, single spaces, upper case."""
    t = F.regexp_replace(F.regexp_replace(_c(text), "[‘’′´`]", "'"), "[“”″]|''", '"')
    for sign, written in FRACTIONS.items():
        t = F.replace(t, F.lit(sign), F.lit(written))
    return F.upper(F.trim(F.regexp_replace(F.regexp_replace(t, "[–—]", "-"), r"\s+", " ")))


# Written lengths (fixed patterns): feet and inches, inches, metric.
_N = r"(\d+(?:\.\d+)?)"
_FEET = rf"""^{_N}\s*'\s*(?:-\s*|\s)?(?:(\d+)(?:\s*-?\s*(\d+)/(\d+)|\s+(\d+)/(\d+))?|(\d+)/(\d+))?\s*"?$"""
_INCHES = rf"""^(?:(\d+)(?:\s*-\s*|\s+)(\d+)/(\d+)|(\d+)/(\d+)|{_N})\s*"$"""
_METRIC = rf"^{_N}\s*(MM|CM|M)$"


def _parts(t: Column, pattern: str, whole: list[int], fractions: list[tuple[int, int]]) -> Column:
    """The sum of a pattern's whole groups and fractions; groups that are absent add nothing."""
    total = F.lit(0.0)
    for i in whole:
        total = total + F.coalesce(_float(_group(t, pattern, i)), F.lit(0.0))
    for n, d in fractions:
        total = total + F.coalesce(_float(_group(t, pattern, n)) / F.nullif(_float(_group(t, pattern, d)), F.lit(0.0)), F.lit(0.0))
    return total


def length_m(text) -> Column:
    """Metres of `3'-6 1/2"`, `42"`, `12'`, `900 mm`, `90 cm`, `0.9 m`; null for anything else, bare numbers too, and for 12 inches or more after feet."""

    def metres(t: Column) -> Column:
        unit = F.regexp_extract(t, _METRIC, 2)
        scale = F.when(unit == "MM", 0.001).when(unit == "CM", 0.01).otherwise(1.0)
        feet = lambda inches: F.when(inches < 12, (_parts(t, _FEET, [1], []) * 12 + inches) * INCH_M)
        return (
            F.when(t.rlike(_FEET), _let(_parts(t, _FEET, [2], [(3, 4), (5, 6), (7, 8)]), feet))
            .when(t.rlike(_INCHES), _parts(t, _INCHES, [1, 6], [(2, 3), (4, 5)]) * INCH_M)
            .when(t.rlike(_METRIC), _float(F.regexp_extract(t, _METRIC, 1)) * scale)
        )

    return _let(drawing_text(text), metres)


def size_m(text) -> Column:
    """struct(width_m, height_m) of `3'-0" x 7'-0"`; nulls for anything else."""
    sides = F.transform(F.split(F.trim(_c(text)), r"\s*[xX×]\s*"), length_m)
    return _let(sides, lambda s: F.struct(F.when(F.size(s) == 2, s[0]).alias("width_m"), F.when(F.size(s) == 2, F.try_element_at(s, F.lit(2))).alias("height_m")))


# Scale notes (fixed patterns).
_NTS = r"\bN\.?\s?T\.?\s?S\.?(?![A-Z])|\bNOT\s+TO\s+SCALE\b"
_RATIO = r"(?<![\d/])1\s*:\s*(\d+(?:\.\d+)?)(?![\d:])"
_EQUALS = r"""([\d\s/.]+\s*")\s*=\s*([\d\s'"\-/.]+)"""


def scale_note(text) -> Column:
    """struct(ratio, nts): how many times larger the building is than the drawing, and whether the note says not to scale."""

    def read(t: Column) -> Column:
        nts, stated = F.coalesce(t.rlike(_NTS), F.lit(False)), _float(_group(t, _RATIO, 1))
        sides = F.array(*[length_m(F.trim(F.regexp_extract(t, _EQUALS, i))) for i in (1, 2)])
        equal = _let(sides, lambda s: F.when((s[0] > 0) & (s[1] > s[0]), s[1] / s[0]))
        ratio = F.coalesce(equal, F.when((stated > 1) & (t.contains("SCALE") | t.startswith("1")), stated))
        return F.struct(F.when(~nts, ratio).alias("ratio"), nts.alias("nts"))

    return _let(drawing_text(text), read)


def scale_ratio(text) -> Column:
    """The ratio of a scale note; null for NTS and anything else."""
    return scale_note(text).ratio


# Disciplines by the letter that a sheet number starts with (fixed values).
DISCIPLINES = {
    "G": "general", "H": "hazardous materials", "V": "survey/mapping", "B": "geotechnical", "C": "civil", "L": "landscape", "S": "structural", "A": "architectural", "I": "interiors", "Q": "equipment",
    "F": "fire protection", "P": "plumbing", "D": "process", "M": "mechanical", "E": "electrical", "W": "distributed energy", "T": "telecommunications", "R": "resource", "X": "other disciplines",
    "Z": "contractor/shop drawings", "O": "operations",
}
SHEET_NUMBER = r"^([A-Z]{1,2})[-.\s]?(\d{1,3}(?:\.\d{1,3})?)([A-Z]?)$"


def sheet_number(text) -> Column:
    """struct(number, prefix, discipline, sequence, type_digit) of `A-101b` or `M2.01`; null if it is no sheet number or its letter no discipline's."""

    def read(t: Column) -> Column:
        prefix, digits, suffix = (F.regexp_extract(t, SHEET_NUMBER, i) for i in (1, 2, 3))
        plain = F.replace(digits, F.lit("."), F.lit(""))
        kind = F.when(digits.contains(".") | (F.length(plain) >= 3), F.substring(digits, 1, 1))
        found = F.struct(F.concat(prefix, F.lit("-"), digits, suffix).alias("number"), prefix.alias("prefix"), F.substring(prefix, 1, 1).alias("discipline"), F.concat(plain, suffix).alias("sequence"), kind.alias("type_digit"))
        return F.when(F.substring(prefix, 1, 1).isin(*DISCIPLINES), found)

    return _let(drawing_text(text), read)


# Ordered title rules: the first that is found names the sheet's type (fixed values).
TITLE_RULES = [
    (r"\b(COVER\s*SHEET|TITLE\s*SHEET|COVER)\b", "cover"),
    (r"\b(REFLECTED\s+CEILING\s+PLAN|RCP|CEILING\s+PLAN)\b", "rcp"),
    (r"\b(ENLARGED|BLOW[- ]?UP)\b.*\bPLANS?\b", "enlarged_plan"),
    (r"\bPARTIAL\b.*\bPLANS?\b|\bPLANS?\b.*\b(AREA|PART|SECTOR)\s+[A-Z0-9]\b", "partial_plan"),
    (r"\bROOF\s+PLAN\b", "roof_plan"),
    (r"\bSITE\s+PLAN\b", "site_plan"),
    (r"\bSCHEDULES?\b", "schedule"),
    (r"\bELEVATIONS?\b", "elevation"),
    (r"\b(BUILDING|WALL)?\s*SECTIONS?\b", "section"),
    (r"\bDETAILS?\b", "detail"),
    (r"\b(DIAGRAMS?|RISERS?)\b", "diagram"),
    (r"\b(LEGENDS?|SYMBOLS|ABBREVIATIONS|GENERAL\s+NOTES|NOTES)\b", "general"),
    (r"\b(FLOOR\s+PLAN|PLAN)S?\b", "floor_plan"),
]
# Storeys by ordinal word (fixed values), and how a title names a level, in order.
ORDINALS = {"GROUND": 1, "FIRST": 1, "SECOND": 2, "THIRD": 3, "FOURTH": 4, "FIFTH": 5, "SIXTH": 6, "SEVENTH": 7, "EIGHTH": 8, "NINTH": 9, "TENTH": 10}
_STOREY = r"(?:FLOOR|LEVEL|STORY|STOREY)"
MARK_WORDS = {"GROUND": 1, "FIRST": 1, "1ST": 1, "SECOND": 2, "2ND": 2, "THIRD": 3, "3RD": 3, "FOURTH": 4, "FIFTH": 5, "SIXTH": 6}


def _lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def sheet_type(title) -> Column:
    return _let(drawing_text(title), lambda t: first_rule(t, TITLE_RULES))


def storey_ordinal(name) -> Column:
    """0 for BASEMENT, n for LEVEL n and a leading 4TH to 9TH, else the first word's ordinal; null otherwise."""
    t = F.trim(F.upper(_c(name)))
    level, th = _group(t, r"LEVEL\s*(\d+)", 1), _group(t, r"^([4-9])TH\b", 1)
    return F.when(t.contains("BASEMENT"), F.lit(0)).otherwise(F.coalesce(level.try_cast("int"), th.try_cast("int"), _lookup(MARK_WORDS, F.regexp_extract(t, r"^(\S+)", 1))))


def level_key(level) -> Column:
    """A sortable key: B2 -1, B1 0, L1 1, ...; mezzanine, roof and penthouse above all numbered levels."""
    t = normalize_name(level)
    below, above = F.regexp_extract(t, r"^B(\d+)$", 1), F.regexp_extract(t, r"^L?(\d+)$", 1)
    return F.when(below != "", 1.0 - _float(below)).when(above != "", _float(above)).when(t.rlike(r"^MEZZ"), F.lit(9000.0)).when(t.rlike(r"^ROOF"), F.lit(9001.0)).when(t.rlike(r"^PH|^PENT"), F.lit(9002.0))


def level_of_title(title) -> Column:
    """The level id that a title names: B1, L2, MEZZ, PH, ROOF; null if none."""
    return _let(drawing_text(title), _level)


def _level(t: Column) -> Column:
    cellar = r"\b(?:BASEMENT|CELLAR)\s*(\d)?\b"
    low = _group(t, r"\b(?:LEVEL|FLOOR|LVL)\s*[-#]?\s*B(\d)\b", 1)
    word = _lookup(ORDINALS, F.regexp_extract(t, rf"\b({'|'.join(ORDINALS)})\s+{_STOREY}\b", 1))
    th = _group(t, rf"\b(\d{{1,2}})(?:ST|ND|RD|TH)\s+{_STOREY}\b", 1)
    number = _group(t, r"\b(?:LEVEL|FLOOR|LVL)\s*[-#]?\s*(\d{1,2})\b", 1)
    level = lambda n: F.concat(F.lit("L"), n.cast("int").cast("string"))
    return (
        F.when(t.rlike(cellar), F.concat(F.lit("B"), F.coalesce(_group(t, cellar, 1), F.lit("1"))))
        .when(t.rlike(r"\bLOWER\s+LEVEL\b"), F.lit("B1")).when(low.isNotNull(), F.concat(F.lit("B"), low))
        .when(t.rlike(r"\bMEZZANINE\b"), F.lit("MEZZ")).when(t.rlike(r"\bPENTHOUSE\b"), F.lit("PH"))
        .when(word.isNotNull(), level(word)).when(th.isNotNull(), level(th)).when(number.isNotNull(), level(number))
        .when(t.rlike(r"\bROOF\b"), F.lit("ROOF"))
    )


# Which end a partial elevation shows, and the facade of an elevation's title (fixed patterns).
PART_END = r"\b(NORTH|SOUTH|EAST|WEST|LEFT|RIGHT)\s+(?:HALF|END|PART|PORTION|WING)\b"
FACADE = r"\b(NORTH|SOUTH|EAST|WEST)\b[^A-Z]*\bELEVATION\b"


def facade_of_title(title) -> Column:
    """north, south, east or west if a title names the elevation of exactly one; the end of a partial one is none."""
    t = F.regexp_replace(F.upper(_c(title)), PART_END, " ")
    found = F.array_distinct(F.regexp_extract_all(t, F.lit(FACADE), F.lit(1)))
    return F.when(F.size(found) == 1, F.lower(found[0]))


# Equipment tags (fixed pattern).
TAG = r"\b([A-Z][A-Z0-9]{0,5}-\d+[A-Za-z]?)\b"


def equipment_tag(text) -> Column:
    """The last `AC-1` like tag in a text; null if there is none."""
    return F.try_element_at(F.regexp_extract_all(_c(text), F.lit(TAG), F.lit(1)), F.lit(-1))


# Units that a stated capacity may have, as they are recorded (fixed values).
CAPACITY_UNITS = {"kw": "kW", "w": "W", "watt": "W", "watts": "W", "j": "J", "kj": "kJ", "mj": "MJ", "kj/h": "kJ/h", "btu": "BTU", "btu/h": "BTU/h", "mbh": "MBH", "ton": "ton", "tons": "ton", "tr": "ton", "cfm": "CFM", "l/s": "L/s", "gpm": "GPM"}
_CAPACITY = r"(\d[\d,]*(?:\.\d+)?)(?:\s*-\s*(\d[\d,]*(?:\.\d+)?))?\s*([A-Za-z/]+)"


def capacity(text) -> Column:
    """struct(value, unit, raw) of the first number with a capacity's unit, unconverted; a stated range has no value; null without any."""
    found = lambda i: F.regexp_extract_all(_c(text), F.lit(_CAPACITY), F.lit(i))
    each = F.transform(F.arrays_zip(found(0).alias("raw"), found(1).alias("low"), found(2).alias("high"), found(3).alias("unit")), lambda m: F.struct(F.when(m.high == "", F.replace(m.low, F.lit(","), F.lit("")).try_cast("double")).alias("value"), _lookup(CAPACITY_UNITS, F.lower(m.unit)).alias("unit"), F.trim(m.raw).alias("raw")))
    return F.try_element_at(F.filter(each, lambda m: m.unit.isNotNull()), F.lit(1))


# How a room label reads, in order (fixed patterns).
_ROOM_NUMBER = r"[A-Z]?\d{1,4}[A-Z]?(?:[-/][A-Z]?\d{1,3}[A-Z]?)?"
_ROOM_NAME = r"[A-Z][A-Z0-9 .&'/\-]*"


def _label_text(text) -> Column:
    """Upper case, single spaces, a letter O beside a digit as a zero."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(_c(text)), r"(?<=\d)O|O(?=\d)", "0"), r"\s+", " "))


def _letters_for_zeros(name: Column) -> Column:
    """A zero inside a word that has no other digit is a letter O."""

    def word(w: Column) -> Column:
        fixed = F.replace(w, F.lit("0"), F.lit("O"))
        return F.when(w.contains("0") & w.rlike("[A-Z]") & F.regexp_replace(fixed, "[^A-Z0-9]", "").rlike("^[A-Z]+$"), fixed).otherwise(w)

    return F.array_join(F.transform(F.split(name, " "), word), " ")


def room_label(text) -> Column:
    """struct(name, number, confidence) of a room label, empty where it has none.

    `RM 101` and `101` 1.0, `NAME 101` and `101 NAME` 0.95, a name alone 0.9;
    anything else is a name at 0.5, an empty text nothing at 0.
    """
    t = _label_text(F.coalesce(_c(text), F.lit("")))
    told = lambda name, number, sure: F.struct(_letters_for_zeros(F.trim(name)).alias("name"), number.alias("number"), F.lit(sure).alias("confidence"))
    none = F.lit("")

    def read(x: Column) -> Column:
        room, bare = rf"^(?:RM|ROOM)\.?\s*({_ROOM_NUMBER})$", rf"^({_ROOM_NUMBER})$"
        after, before = rf"^({_ROOM_NAME}?)\s*[.\-]?\s*({_ROOM_NUMBER})$", rf"^({_ROOM_NUMBER})\s+({_ROOM_NAME})$"
        return (
            F.when(x.rlike(room), told(none, F.regexp_extract(x, room, 1), 1.0))
            .when(x.rlike(bare), told(none, F.regexp_extract(x, bare, 1), 1.0))
            .when(x.rlike(after), told(F.regexp_replace(F.regexp_extract(x, after, 1), r"^[ .\-]+|[ .\-]+$", ""), F.regexp_extract(x, after, 2), 0.95))
            .when(x.rlike(before), told(F.regexp_extract(x, before, 2), F.regexp_extract(x, before, 1), 0.95))
            .when(x.rlike(rf"^({_ROOM_NAME})$"), told(x, none, 0.9))
        )

    return _let(t, lambda x: F.when(x == "", told(none, none, 0.0)).otherwise(F.coalesce(read(x), _let(_letters_for_zeros(x), lambda y: F.coalesce(read(y), told(y, none, 0.5))))))


# Texts that are dimensions and never room labels (fixed patterns).
DIMENSIONS = [r"\d\s*['′]", r"\d\s*[\"″]", r"\d\s*/\s*\d", r"\d\s*[xX×]\s*\d", r"\b[O0]\.?C\.?\b", r"@", r"[°]", r"(?i)\b\d+\s*(?:SF|SQ\.?\s*FT)\b"]


def looks_like_dimension(text) -> Column:
    t = _label_text(text)
    return F.coalesce(t.rlike("|".join(DIMENSIONS)), F.lit(False))


# Space types by name, most particular first (fixed values).
SPACE_RULES = [
    (r"\bDATA ?(CENTER|CENTRE)\b|\bSERVER\b", "data_center"),
    (r"\bIT\b|\bIDF\b|\bMDF\b|\bTELECOM\b|\bTEL(E)? ?DATA\b|\bCOMM(S|UNICATIONS)? ROOM\b", "it_room"),
    (r"\b(ELEC|ELECT|ELECTRICAL|MECH|MECHANICAL|BOILER|PUMP|FAN|RISER|JANITOR|JAN|CUSTODIAL|UTILITY)\b", "mechanical_electrical"),
    (r"\bELEV(ATOR)? LOBBY\b", "elevator_lobby"),
    (r"\b(LOBBY|RECEPTION|VESTIBULE|ENTRY|FOYER|WAITING)\b", "lobby"),
    (r"\b(CONF|CONFERENCE|MEETING|BOARD ?ROOM|HUDDLE|TRAINING)\b", "conference"),
    (r"\b(BREAK|PANTRY|LOUNGE|COFFEE|WORK ?ROOM)\b", "break_room"),
    (r"\b(KITCHEN|SERVERY)\b", "kitchen"),
    (r"\b(DINING|CAFE|CAFETERIA|CANTEEN)\b", "dining"),
    (r"\b(PRINT|COPY|MAIL)\b", "print_room"),
    (r"\bVENDING\b", "vending"),
    (r"\b(TOILET|RESTROOM|WC|LAV|LAVATORY|MEN|WOMEN|MENS|WOMENS|SHOWER|LOCKER)\b", "restroom"),
    (r"\b(STAIR|STAIRS|STAIRWELL|STAIRWAY)\b", "stair"),
    (r"\b(CORR|CORRIDOR|HALL|HALLWAY|PASSAGE)\b", "corridor"),
    (r"\b(STOR|STORAGE|STORE ?ROOM|FILE|FILES|ARCHIVE|CLOSET|CLO)\b", "storage"),
    (r"\b(CLASSROOM|CLASS|SEMINAR)\b", "classroom"),
    (r"\b(LIBRARY|READING)\b", "library"),
    (r"\b(GYM|GYMNASIUM|FITNESS|EXERCISE)\b", "gym"),
    (r"\b(AUDITORIUM|THEATER|THEATRE|ASSEMBLY)\b", "auditorium"),
    (r"\b(RETAIL|SHOP|SALES)\b", "retail"),
    (r"\b(WAREHOUSE|LOADING)\b", "warehouse"),
    (r"\b(OPEN OFFICE|OPEN PLAN|WORKSTATIONS?|BULLPEN|OPEN AREA)\b", "open_office"),
    (r"\b(OFFICE|OFF|OFC|PRIVATE|MANAGER|DIRECTOR|EXEC|EXECUTIVE)\b", "closed_office"),
]
ANY_SPACE = "office_whole_building"


def space_type(name, poly_type=None) -> Column:
    """struct(type, confidence): shafts and elevator cores have none, closets are storage at 0.7, then the first name rule at 0.7, else the whole building's at 0.4."""
    told = lambda kind, sure: F.struct(F.lit(kind).alias("type"), F.lit(sure).alias("confidence"))
    t = F.concat(F.lit(" "), F.regexp_replace(F.upper(F.coalesce(_c(name), F.lit(""))), "[^A-Z0-9]+", " "), F.lit(" "))
    p = F.lit("room") if poly_type is None else F.coalesce(_c(poly_type), F.lit("room"))
    by_name = first_rule(t, SPACE_RULES)
    none = F.struct(F.lit(None).cast("string").alias("type"), F.lit(0.0).alias("confidence"))
    return F.when(p.isin("shaft", "elevator_core"), none).when(p == "closet", told("storage", 0.7)).when(by_name.isNotNull(), F.struct(by_name.alias("type"), F.lit(0.7).alias("confidence"))).otherwise(told(ANY_SPACE, 0.4))


# U-factors from Btu/(h ft2 F) to W/(m2 K), and the units that a header states (fixed values).
U_IP_TO_SI = 5.678263


def thermal_fields(headers, values, sizes_ft_in=None) -> Column:
    """struct(u_w_m2k, u_confidence, shgc, vt) of one schedule row, from its headers and cells.

    The U column's header states the unit (0.9); without one the U is read as IP
    where the schedule sizes its openings in feet and inches (0.75), else not at
    all.  SHGC and VT must lie over 0, up to 1.
    """
    canon = F.transform(_c(headers), lambda h: F.replace(F.upper(F.trim(h)), F.lit("_"), F.lit("-")))

    def column(*patterns: str) -> Column:
        at = None
        for p in patterns:
            place = F.array_position(F.transform(canon, lambda h: F.when(h.rlike(p), 1).otherwise(0)), 1)  # noqa: B023
            at = F.when(place > 0, place) if at is None else F.coalesce(at, F.when(place > 0, place))
        return at.cast("int")

    cell = lambda at: number(F.try_element_at(_c(values), at))
    u = column(r"U[-\s]?(FACTOR|VALUE)", r"^U$", r"^U\b")
    head, raw = F.try_element_at(canon, u), F.when(cell(u) > 0, cell(u))
    feet = F.lit(False) if sizes_ft_in is None else F.coalesce(_c(sizes_ft_in), F.lit(False))
    si, ip = head.rlike(r"W\s*[/_-]?\s*M|\bSI\b"), head.rlike(r"BTU|\bIP\b")
    value = F.when(si, raw).when(ip | feet, raw * U_IP_TO_SI)
    sure = F.when(raw.isNull(), F.lit(None)).when(si | ip, 0.9).when(feet, 0.75)
    ratio = lambda x: F.when((x > 0) & (x <= 1), x)
    return F.struct(F.round(value, 4).alias("u_w_m2k"), sure.alias("u_confidence"), ratio(cell(column(r"\bSHGC\b", r"SOLAR\s*HEAT"))).alias("shgc"), ratio(cell(column(r"\bVT\b", r"\bVLT\b", r"VISIBLE"))).alias("vt"))


# Heating output in Btu/h and square foot from which a space counts as heated, by climate zone (fixed values).
HEATED_FROM = {"0": 5.0, "1": 5.0, "2": 5.0, "3A": 9.0, "3B": 9.0, "3C": 7.0, "4A": 10.0, "4B": 10.0, "4C": 8.0, "5": 12.0, "6": 14.0, "7": 16.0, "8": 19.0}


def climate_zone_number(zone) -> Column:
    """The number of a climate zone such as `5A` or `CZ 7`; null if it is none."""
    return _group(F.lower(_c(zone)), r"^\s*(?:cz\s*)?([0-8])\s*([abc])?\s*$", 1)


def heated_thresholds(zone) -> Column:
    """The values that a climate zone could mean, lowest first; an empty text all of them, one that is no zone null."""
    cz = F.trim(F.upper(F.coalesce(_c(zone), F.lit(""))))
    number_, letter = _group(cz, r"^(?:CZ\s*)?([0-8])\s*([ABC])?$", 1), F.regexp_extract(cz, r"^(?:CZ\s*)?([0-8])\s*([ABC])?$", 2)
    table = F.create_map(*[F.lit(x) for kv in HEATED_FROM.items() for x in kv])
    exact = F.coalesce(F.try_element_at(table, number_), F.try_element_at(table, F.concat(number_, letter)))
    some = F.array_sort(F.array_distinct(F.map_values(F.map_filter(table, lambda k, v: F.substring(k, 1, 1) == number_))))
    every = F.array_sort(F.array_distinct(F.map_values(table)))
    return F.when(cz == "", every).when(exact.isNotNull(), F.array(exact)).when(number_.isNotNull() & (letter == ""), some)
