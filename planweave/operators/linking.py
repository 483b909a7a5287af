"""Links between sheets, schedules, rooms and revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions import geometry as G
from planweave.functions.text import normalize_name, normalize_tag
from planweave.operators.ordered import best_pairs
from planweave.operators.spatial import met_boxes


def find_tags(spans: DataFrame, known: DataFrame, text: str = "text", tag: str = "tag") -> DataFrame:
    """spans with tag: the known tag that is the whole text, else its first word; VAV-10 is no VAV-1.  Others go."""
    k = known.select(normalize_tag(tag).alias("tag")).where("tag <> ''").distinct()
    s = spans.withColumn("_whole", normalize_tag(text)).withColumn("_first", normalize_tag(F.split(F.trim(F.col(text)), r"\s+")[0]))
    j = s.join(k.select(F.col("tag").alias("_w")), F.col("_whole") == F.col("_w"), "left").join(k.select(F.col("tag").alias("_f")), F.col("_first") == F.col("_f"), "left")
    return j.withColumn("tag", F.coalesce("_w", "_f")).where("tag is not null").drop("_whole", "_first", "_w", "_f")


def link_rooms(references: DataFrame, rooms: DataFrame, ref: str = "room", key: str = "tag") -> DataFrame:
    """key, rooms: the rooms a reference names, by number if any has it, else by whole name; none is an empty list."""
    r = references.select(key, normalize_name(ref).alias("ref"))
    by_number = rooms.select(normalize_name("number").alias("ref"), F.col("id").alias("n_id"))
    by_name = rooms.select(normalize_name("name").alias("ref"), F.col("id").alias("m_id"))
    j = r.join(by_number, "ref", "left").join(by_name, "ref", "left")
    return j.groupBy(key).agg(F.array_sort(F.collect_set(F.coalesce("n_id", "m_id"))).alias("rooms"))


def served_by(equipment: DataFrame, units: DataFrame, tag: str = "tag", cells: str = "values") -> DataFrame:
    """tag, unit, note: the one scheduled central unit that a row's cells under a serving header name."""
    c = equipment.select(F.col(tag).alias("tag"), F.explode(cells).alias("header", "cell")).where(F.col("header").rlike(r"(?i)served by|ahu|air handl|\bunit\b|system"))
    hit = c.withColumn("unit", normalize_tag("cell")).join(units.select(normalize_tag("unit").alias("unit"), F.lit(True).alias("known")).distinct(), "unit", "left")
    g = hit.where("unit <> ''").groupBy("tag").agg(F.array_sort(F.collect_set(F.when(F.col("known"), F.col("unit")))).alias("u"), F.array_sort(F.collect_set(F.when(F.col("known").isNull(), F.col("unit")))).alias("x"))
    return g.select("tag", F.when(F.size("u") == 1, F.col("u")[0]).alias("unit"), F.when(F.size("u") > 1, F.concat(F.lit("several: "), F.array_join("u", ","))).when(F.size("u") == 0, F.concat(F.lit("not scheduled: "), F.array_join("x", ","))).alias("note"))


def moved_openings(old: DataFrame, new: DataFrame, by: list[str], id: str = "id", tag: str = "tag", box: str = "box", least: float = 0.5, cell: float = 10.0) -> DataFrame:
    """old_id, new_id, how: tags that are unique on both sides first, then boxes that overlap by `least`, best first, one to one.

    Boxes meet over a grid of `cell`, which should be a few times their size.
    """

    def once(t: DataFrame, s: str) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(*by, tag))
        return t.withColumn("_n", n).where(F.col("_n") == 1).where(F.coalesce(tag, F.lit("")) != "").select(*by, tag, F.col(id).alias(f"{s}_id"))

    sure = once(old, "old").join(once(new, "new"), [*by, tag]).select("old_id", "new_id").withColumn("how", F.lit("tag"))
    free = lambda t, s: t.join(sure.select(F.col(f"{s}_id").alias(id)), id, "left_anti")
    met = met_boxes(free(old, "old"), free(new, "new"), by, cell, id, box)
    pairs = met.select(F.col("a").alias("old_id"), F.col("b").alias("new_id"), G.box_iou(F.col("a_box"), F.col("b_box")).alias("score")).where(F.col("score") >= least)
    boxes = best_pairs(pairs, "old_id", "new_id", "score")
    return sure.unionByName(boxes.select("old_id", "new_id", F.lit("box").alias("how")))


def enlarged_plans(plans: DataFrame, bases: DataFrame, by: list[str], id: str = "id", box: str = "box", within: float = 0.8, ratio: float = 0.6, guard: float = 0.1, cell: float = 100.0) -> DataFrame:
    """plan, base, reason: the smallest base that holds most of a plan; `ambiguous` if another is within a tenth of its area.

    Plans and bases meet over a grid of `cell`.
    """
    size = lambda b: (F.col(f"{b}.x1") - F.col(f"{b}.x0")) * (F.col(f"{b}.y1") - F.col(f"{b}.y0"))
    p = plans.select(F.col(id).alias("plan"))
    met = met_boxes(plans, bases, by, cell, id, box).select(F.col("a").alias("plan"), F.col("b").alias("base"), F.col("a_box").alias("pb"), F.col("b_box").alias("bb"))
    j = met.where((F.col("plan") != F.col("base")) & (G.containment(F.col("pb"), F.col("bb")) >= within) & (size("pb") <= ratio * size("bb"))).withColumn("area", size("bb"))
    w = Window.partitionBy("plan").orderBy("area", "base")
    top = j.withColumn("r", F.row_number().over(w)).withColumn("next", F.lead("area").over(w)).where("r = 1")
    close = F.coalesce(F.col("next") <= (1 + guard) * F.col("area"), F.lit(False))
    out = p.select("plan").join(top.select("plan", F.when(~close, F.col("base")).alias("base"), F.when(close, F.lit("ambiguous")).alias("reason")), "plan", "left")
    return out.select("plan", "base", F.when(F.col("base").isNull() & F.col("reason").isNull(), F.lit("none")).otherwise(F.col("reason")).alias("reason"))


def nearest_untaken(plan: DataFrame, seen: DataFrame, by: list[str], plan_id: str, seen_id: str, s: str = "s", within: float = 0.3) -> DataFrame:
    """plan_id, seen_id, distance: openings of both views paired one to one, nearest first, within reach."""
    cell = F.floor(F.col(s) / within)
    p = plan.select(*by, F.col(plan_id), F.col(s).alias("ps"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    q = seen.select(*by, F.col(seen_id), F.col(s).alias("qs"), cell.alias("cell"))
    j = p.join(q, [*by, "cell"]).withColumn("score", -F.abs(F.col("ps") - F.col("qs"))).where(F.col("score") >= -within)
    return best_pairs(j.select(plan_id, seen_id, "score"), plan_id, seen_id, "score").select(plan_id, seen_id, (-F.col("score")).alias("distance"))


def merged_observations(views: DataFrame, by: list[str], within: float = 0.3, overlap: float = 0.5) -> DataFrame:
    """views (id, sheet, lo, hi, confidence, ...) with the group that observations of several sheets form.

    Two of different sheets are one if their centres are near and they share half of the narrower; groups are chained.
    """
    from planweave.operators.components import connected_components

    cell = F.floor((F.col("lo") + F.col("hi")) / 2 / within)
    a = views.select(*by, "id", "sheet", "lo", "hi", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    b = views.select(*by, *[F.col(c).alias(f"{c}_b") for c in ("id", "sheet", "lo", "hi")], cell.alias("cell"))
    near = F.abs((F.col("lo") + F.col("hi")) / 2 - (F.col("lo_b") + F.col("hi_b")) / 2) <= within
    share = G.interval_overlap("lo", "hi", "lo_b", "hi_b") >= overlap * F.least(F.col("hi") - F.col("lo"), F.col("hi_b") - F.col("lo_b"))
    links = a.join(b, [*by, "cell"]).where((F.col("sheet") != F.col("sheet_b")) & (F.col("id") < F.col("id_b")) & near & share).select(F.col("id").alias("a"), F.col("id_b").alias("b"))
    labels = connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("group"))
    return views.join(labels, "id", "left").withColumn("group", F.coalesce("group", "id"))


def group_means(grouped: DataFrame, by: list[str]) -> DataFrame:
    """group, lo, hi, confidence, tag, n: means weighted by confidence; tags that differ are all kept, joined by commas."""
    c = F.col("confidence")
    mean = lambda x: F.sum(F.col(x) * c) / F.nullif(F.sum(c), F.lit(0.0))
    return grouped.groupBy(*by, "group").agg(mean("lo").alias("lo"), mean("hi").alias("hi"), F.max(c).alias("confidence"), F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tag"), F.count("*").alias("n"))


def same_rows_agree(rows: DataFrame, keys: list[str], value: str, unit: str) -> DataFrame:
    """keys, value, confidence: stated several times a slot keeps its value only if all agree, units converted; else null and low."""
    from planweave.functions.units import to_base, unit_family

    base = F.coalesce(to_base(value, unit), F.col(value))
    kind = F.coalesce(unit_family(unit), F.col(unit), F.lit(""))
    g = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(base).alias("lo"), F.max(base).alias("hi"), F.count_distinct(kind).alias("kinds"), F.min_by(value, F.struct(value, unit)).alias("v"))
    agree = (F.col("kinds") == 1) & (F.abs(F.col("hi") - F.col("lo")) <= 1e-9 * F.greatest(F.abs("hi"), F.lit(1.0)))
    return g.select(*keys, F.when(agree, F.col("v")).alias("value"), F.when(agree, F.lit("high")).otherwise(F.lit("low")).alias("confidence"))


def title_matches(a: DataFrame, b: DataFrame, by: list[str], id: str = "id", title: str = "title", least: float = 0.85, few: int = 1000) -> DataFrame:
    """a_id, b_id, ratio: the title in b most like each in a by edit distance over the longer length, within blocks.

    In blocks of up to `few` titles in b every pair is compared.  In larger
    ones titles meet by a piece: one of n letters can differ from a partner by no
    more than d edits, so of its d + 1 pieces at least one stands in the partner,
    at most d places off.  Nothing that reaches `least` (over a half) is missed.
    A title has some thousand pieces, lengths and places, hence the first way.
    Both sides are sorted: their files tell Spark little of their size, and it would broadcast them.
    """
    if not 0.5 < least <= 1:
        raise ValueError("least must lie over a half, up to 1")
    x = a.select(*by, F.col(id).alias("a_id"), normalize_name(title).alias("x")).where("x is not null")
    y = b.select(*by, F.col(id).alias("b_id"), normalize_name(title).alias("y")).where("y is not null")
    sizes = y.groupBy(*by).agg(F.count("*").alias("_m"))
    of = lambda t, which: t.join(sizes.where(which).select(*by).hint("merge"), by, "left_semi")
    ratio = 1 - F.levenshtein("x", "y") / F.greatest(F.length("x"), F.length("y"), F.lit(1))
    near = F.least(F.length("x"), F.length("y")) >= least * F.greatest(F.length("x"), F.length("y")) - 1e-9
    direct = of(x, F.col("_m") <= few).join(y.hint("merge"), by).where(near).select("a_id", "b_id", "x", "y")
    x, y = of(x, F.col("_m") > few), of(y, F.col("_m") > few)

    def pieces(t: DataFrame) -> DataFrame:
        t = t.withColumn("d", F.expr(f"cast(floor({1 - least!r} * floor(n / {least!r} + 1e-9) + 1e-9) as int)")).withColumn("k", F.explode(F.expr("sequence(0, d)")))
        return t.withColumn("start", F.expr("cast(floor(k * n / (d + 1)) as int)")).withColumn("size", F.expr("cast(floor((k + 1) * n / (d + 1)) as int) - start"))

    held = pieces(y.withColumn("n", F.length("y"))).withColumn("piece", F.expr("substring(y, start + 1, size)")).select(*by, "n", "k", "piece", "b_id", "y")
    lengths = F.expr(f"sequence(cast(ceil(length(x) * {least!r} - 1e-9) as int), cast(floor(length(x) / {least!r} + 1e-9) as int))")
    asked = pieces(x.withColumn("n", F.explode(lengths))).withColumn("at", F.explode(F.expr("sequence(start - d, start + d)"))).where("at >= 0 and at + size <= length(x)")
    asked = asked.withColumn("piece", F.expr("substring(x, at + 1, size)")).select(*by, "n", "k", "piece", "a_id", "x").distinct()
    met = asked.join(held.hint("merge"), [*by, "n", "k", "piece"]).select("a_id", "b_id", "x", "y").dropDuplicates(["a_id", "b_id"])
    j = direct.unionByName(met).withColumn("ratio", ratio).where(F.col("ratio") >= least)
    return j.withColumn("r", F.row_number().over(Window.partitionBy("a_id").orderBy(F.desc("ratio"), "b_id"))).where("r = 1").select("a_id", "b_id", "ratio")


def scale_votes(evidence: DataFrame, by: list[str], scale: str = "scale", kind: str = "kind", least_dimensions: int = 3, tolerance: float = 0.01) -> DataFrame:
    """by, scale, reason: notes, bars and (three or more) dimensions must agree within a hundredth; `nts` refuses."""
    med = lambda k: F.median(F.when(F.col(kind) == k, F.col(scale)))
    n = F.count_if((F.col(kind) == "dimension") & F.col(scale).isNotNull())
    g = evidence.groupBy(*by).agg(med("note").alias("note"), med("bar").alias("bar"), F.when(n >= least_dimensions, med("dimension")).alias("dimension"), F.count_if(F.col(kind) == "nts").alias("nts"))
    said = F.filter(F.array("note", "bar", "dimension"), lambda x: x.isNotNull())
    far = F.array_max(said) > (1 + tolerance) * F.array_min(said)
    why = F.when(F.col("nts") > 0, F.lit("not to scale")).when(F.size(said) == 0, F.lit("no evidence")).when(far, F.lit("disagree"))
    return g.select(*by, F.when(why.isNull(), said[0]).alias("scale"), why.alias("reason"))


def level_marks(marks: DataFrame, by: list[str], value: str = "value", drawn: str = "drawn", within: float = 0.3) -> DataFrame:
    """marks whose stated value lies off the drawn height by about as much as the (upper) median mark; fewer than two are none."""
    off = F.col(value) - F.col(drawn)
    w = Window.partitionBy(*by)
    ranked = marks.withColumn("_off", off).where("_off is not null").withColumn("_r", F.row_number().over(w.orderBy("_off"))).withColumn("_n", F.count("*").over(w))
    mid = ranked.where(F.col("_r") == F.floor(F.col("_n") / 2) + 1).select(*by, F.col("_off").alias("_m"))
    kept = marks.join(mid, by).where(F.abs(off - F.col("_m")) <= within).drop("_m")
    return kept.withColumn("_n", F.count("*").over(w)).where("_n >= 2").drop("_n")


def pairwise_boundary(a: Column, b: Column) -> Column:
    """struct(kind, reason) of the wall between two space categories."""
    one = lambda x: (a == x) | (b == x)
    kind = F.when(a.isNull() | b.isNull() | one("review"), F.lit("review")).when(a == b, F.lit(None)).when(one("conditioned") & (one("unconditioned") | one("semiheated")), F.lit("semi_exterior"))
    return F.struct(kind.alias("kind"), F.when(kind == "review", F.lit("category not known")).alias("reason"))
