"""Units: conversion by a fixed table, comparison inside a unit family, never across."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit: family, factor to the family's base unit (fixed values).
UNITS = {
    "w": ("power", 1.0), "kw": ("power", 1000.0), "mw": ("power", 1e6), "btu/h": ("power", 0.29307107), "mbh": ("power", 293.07107), "ton": ("power", 3516.8528), "hp": ("power", 745.69987),
    "j": ("energy", 1.0), "kj": ("energy", 1000.0), "mj": ("energy", 1e6), "gj": ("energy", 1e9), "kwh": ("energy", 3.6e6), "btu": ("energy", 1055.05585),
    "cfm": ("airflow", 0.00047194745), "l/s": ("airflow", 0.001), "m3/s": ("airflow", 1.0), "m3/h": ("airflow", 1 / 3600),
    "m": ("length", 1.0), "mm": ("length", 0.001), "ft": ("length", 0.3048), "in": ("length", 0.0254),
    "m2": ("area", 1.0), "ft2": ("area", 0.09290304), "sf": ("area", 0.09290304),
}
BTUH_PER_W = 3.412141633
U_SI_PER_IP = 5.678263
FT2_PER_M2 = 10.7639


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map(i: int) -> Column:
    return F.create_map(*[F.lit(x) for u, v in UNITS.items() for x in (u, v[i])])


def unit_family(unit) -> Column:
    return F.try_element_at(_map(0), F.lower(F.trim(_c(unit))))


def to_base(value, unit) -> Column:
    """The value in its family's base unit; null where the unit is unknown."""
    return _c(value) * F.try_element_at(_map(1), F.lower(F.trim(_c(unit))))


# Btu/h of one of a capacity's units, and other spellings of the units (fixed values).
CAPACITY_BTUH = {"btuh": 1.0, "mbh": 1000.0, "w": BTUH_PER_W, "kw": 1000.0 * BTUH_PER_W, "ton": 12000.0}
CAPACITY_SPELLINGS = {"btuhr": "btuh", "btu": "btuh", "kbtuh": "mbh", "tons": "ton", "tr": "ton"}


def to_btuh(value, unit) -> Column:
    """A capacity in Btu/h; an unknown unit is an error, a null value stays null."""
    pairs = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    u = F.regexp_replace(F.lower(F.coalesce(_c(unit), F.lit(""))), r"[\s/\-.]", "")
    u = F.coalesce(F.try_element_at(pairs(CAPACITY_SPELLINGS), u), u)
    known = _c(value) * F.try_element_at(pairs(CAPACITY_BTUH), u)
    return F.when(_c(value).isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(known, F.raise_error(F.concat(F.lit("unknown power unit: "), F.coalesce(_c(unit), F.lit("null")))).cast("double")))


def same_quantity(value_a, unit_a, value_b, unit_b, tolerance: float = 1e-9) -> Column:
    """Equal inside one family after conversion; across families or for unknown units only if the raw values are equal."""
    both = (unit_family(unit_a) == unit_family(unit_b)) & unit_family(unit_a).isNotNull()
    a, b = to_base(value_a, unit_a), to_base(value_b, unit_b)
    return F.when(F.coalesce(both, F.lit(False)), F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))).otherwise(_c(value_a) == _c(value_b))


def u_factor_si(value, header, sizes_in_feet: bool = False) -> Column:
    """struct(u, confidence, reason) of a U-factor cell by its header's unit; without a unit only if sizes are in feet."""
    h = F.lower(_c(header))
    si, ip = h.rlike(r"w/ ?m"), h.rlike(r"btu")
    bare = F.lit(sizes_in_feet)
    u = F.when(si, _c(value)).when(ip | bare, _c(value) * U_SI_PER_IP)
    return F.struct(u.alias("u"), F.when(si | ip, 0.9).when(bare, 0.75).alias("confidence"), F.when(~(si | ip) & ~bare, F.lit("no unit")).alias("reason"))


# Resistance in m2K/W of still air layers by thickness in mm, for heat flowing sideways and up (fixed values).
AIR_LAYERS = {
    "horizontal": [(0.0, 0.00), (5.0, 0.11), (7.0, 0.13), (10.0, 0.15), (15.0, 0.17), (25.0, 0.18), (50.0, 0.18), (100.0, 0.18), (300.0, 0.18)],
    "upward": [(0.0, 0.00), (5.0, 0.11), (7.0, 0.13), (10.0, 0.15), (15.0, 0.16), (25.0, 0.16), (50.0, 0.16), (100.0, 0.16), (300.0, 0.16)],
}


def air_layer_resistance(thickness_m, direction: str = "horizontal") -> Column:
    """Resistance of a still air layer; null unless it is over 0 and up to 0.3 m thick."""
    from planweave.operators.fill import interpolate

    mm = _c(thickness_m) * 1000.0
    return F.when((mm > 0) & (mm <= 300.0 + 1e-9), interpolate(mm, AIR_LAYERS[direction]))


def layer_resistance(u, film_resistance: float, least: float = 0.01) -> Column:
    """1/U less the films; null where U isn't positive or too little is left."""
    r = 1.0 / F.nullif(_c(u), F.lit(0.0)) - film_resistance
    return F.when((_c(u) > 0) & (r > least), r)


def watts_of(total_w, density, area) -> Column:
    """Fixture watts if above 0, else density times area."""
    return F.when(_c(total_w) > 0, _c(total_w)).otherwise(_c(density) * _c(area))
