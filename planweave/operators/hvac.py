"""Air systems: who serves whom, shares, capacities and flows, null wherever a part is unknown."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from planweave.operators.aggregates import poisoned_sum


def box_shares(boxes: DataFrame, units: DataFrame, box: str = "box", unit: str = "unit", flow: str = "flow", fan: str = "fan_flow") -> DataFrame:
    """boxes with share and reason: a box's part of its unit's air flow, of the sum of the unit's boxes if the fan's isn't known.

    A share above 1 by more than rounding goes to review; an unknown flow gives none.
    """
    w = Window.partitionBy(unit)
    siblings = F.when(F.count(F.lit(1)).over(w) == F.count(flow).over(w), F.sum(flow).over(w))
    j = boxes.join(units.select(unit, F.col(fan).alias("_fan"), F.lit(True).alias("_known")), unit, "left")
    j = j.withColumn("_whole", F.coalesce("_fan", siblings)).withColumn("share", F.col(flow) / F.nullif(F.col("_whole"), F.lit(0.0)))
    why = F.when(F.col("_known").isNull(), F.lit("no unit")).when(F.col(flow).isNull(), F.lit("no flow")).when(F.col("share").isNull(), F.lit("no total")).when(F.col("share") > 1.0001, F.lit("over one"))
    return j.withColumn("reason", why).withColumn("share", F.when(why.isNull(), F.col("share"))).drop("_fan", "_known", "_whole")


def zone_capacities(shares: DataFrame, units: DataFrame, zone: str = "zone", unit: str = "unit", capacity: str = "capacity") -> DataFrame:
    """zone, capacity: shares of the units' capacities, null if any part is unknown."""
    j = shares.join(units.select(unit, F.col(capacity).alias("_cap")), unit, "left")
    return j.groupBy(zone).agg(poisoned_sum(F.col("share") * F.col("_cap")).alias(capacity))


def space_duties(bridge: DataFrame, areas: DataFrame, capacities: DataFrame, zone: str = "zone", space: str = "space_id", area: str = "area_m2", capacity: str = "capacity") -> DataFrame:
    """space, duty: each zone's capacity by area over its spaces, summed over the space's zones, null if any part is unknown."""
    j = bridge.join(areas.select(space, area), space, "left").join(capacities, zone, "left")
    w = Window.partitionBy(zone)
    whole = F.when(F.count(F.lit(1)).over(w) == F.count(area).over(w), F.sum(area).over(w))
    j = j.withColumn("_part", F.col(capacity) * F.col(area) / F.nullif(whole, F.lit(0.0)))
    return j.groupBy(space).agg(poisoned_sum("_part").alias("duty"))


def flow_per_area(members: DataFrame, served: DataFrame, flows: DataFrame, areas: DataFrame, group: str = "group", space: str = "space_id", zone: str = "zone", flow: str = "flow", area: str = "area_m2") -> DataFrame:
    """group, flow_per_area, reason: only where the zones that serve a group serve exactly its spaces and all is known."""
    want = members.groupBy(group).agg(F.array_sort(F.collect_set(space)).alias("want"))
    zones = members.join(served, space).select(group, zone).distinct()
    got = zones.join(served, zone).groupBy(group).agg(F.array_sort(F.collect_set(space)).alias("got"))
    q = zones.join(flows, zone, "left").groupBy(group).agg(poisoned_sum(flow).alias("q"))
    a = members.select(group, space).distinct().join(areas, space, "left").groupBy(group).agg(poisoned_sum(area).alias("a"))
    j = want.join(got, group, "left").join(q, group, "left").join(a, group, "left")
    missing, extra = F.size(F.array_except("want", F.coalesce("got", F.array().cast("array<string>")))), F.size(F.array_except(F.coalesce("got", F.array().cast("array<string>")), F.col("want")))
    why = F.when(missing > 0, F.lit("not all served")).when(extra > 0, F.lit("others served too")).when(F.col("q").isNull(), F.lit("no flow")).when(F.coalesce("a", F.lit(0.0)) <= 0, F.lit("no area"))
    return j.select(group, F.when(why.isNull(), F.col("q") / F.col("a")).alias("flow_per_area"), why.alias("reason"))


def one_claim(claims: DataFrame, key: str, unit: str) -> DataFrame:
    """key, unit, reason: the only unit claimed; several go to review, none has none."""
    g = claims.groupBy(key).agg(F.count_distinct(unit).alias("n"), F.max(unit).alias("u"))
    return g.select(key, F.when(F.col("n") == 1, F.col("u")).alias(unit), F.when(F.col("n") == 0, F.lit("none")).when(F.col("n") > 1, F.lit("several")).alias("reason"))


def air_loops(boxes: DataFrame, unit: str = "unit", box: str = "box", flow: str = "flow") -> DataFrame:
    """unit, boxes, flow: one loop for each unit, its flow only if every box's is known."""
    return boxes.groupBy(unit).agg(F.array_join(F.array_sort(F.collect_set(box)), ",").alias("boxes"), poisoned_sum(flow).alias("flow"))


LOAD_SLOTS = ("airflow", "airflow_min", "airflow_max", "outside_air_flow")  # fixed values: what zone loads are made of


def zone_load_inputs(rows: DataFrame, systems: DataFrame) -> DataFrame:
    """The values of a schedule that zone loads are made of, those of systems only where no row has them: equipment, field, value, unit, raw, sheet, row, cell."""
    cols = ["equipment", "field", "value", "unit", "raw", "sheet", "row", "cell"]
    keep = lambda t: t.where(F.col("field").isin(*LOAD_SLOTS)).select(cols)
    both = keep(rows).withColumn("_from", F.lit(0)).unionByName(keep(systems).withColumn("_from", F.lit(1)))
    w = Window.partitionBy("equipment", "field", "sheet", "cell").orderBy("_from", "row", "raw")
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(cols)


def sized(inputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(equipment, field, unit, total, n, issue; field, unit, total, n over all equipment): units never mix, an equipment whose stated values differ has no total."""
    from planweave.operators.aggregates import slot_totals

    by = ["equipment", "field", "unit"]
    n = inputs.groupBy(*by).agg(F.count("value").alias("n"))
    each = slot_totals(inputs.where("value is not null"), by, "value").join(n, by)
    whole = each.where("total is not null").groupBy("field", "unit").agg(F.sum("total").alias("total"), F.count("*").alias("n"))
    return each, whole


def load_properties(density, area, lighting_w, activity_w, equipment_w_m2) -> F.Column:
    """A space's load properties as a map, without those that aren't known or need an area that isn't above 0."""
    has = (F.coalesce(density, F.lit(0.0)) > 0) & (F.coalesce(area, F.lit(0.0)) > 0)
    known = F.create_map(
        F.lit("OccupancyNumber"), F.when(has, F.round(density * area, 3)), F.lit("AreaPerOccupant"), F.when(has, F.round(1.0 / density, 3)), F.lit("Lighting"), F.when(lighting_w > 0, F.round(lighting_w, 3)),
        F.lit("People"), F.when(has, F.round(density * area * activity_w, 3)), F.lit("EquipmentSensible"), F.when(F.coalesce(area, F.lit(0.0)) > 0, F.round(equipment_w_m2 * area, 3)),
    )
    return F.map_filter(known, lambda k, v: v.isNotNull())
