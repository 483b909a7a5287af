"""Aggregates with the null and unit rules of building data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def poisoned_sum(x) -> Column:
    """The sum, or null if any value is null."""
    c = F.col(x) if isinstance(x, str) else x
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def weighted_mean(rows: DataFrame, by: list[str], value: str, weight: str, id: str) -> DataFrame:
    """by, mean, excluded: weighted mean over rows with positive value and weight; excluded maps the others to why."""
    v, w = F.col(value), F.col(weight)
    reason = F.when(v.isNull() | (v <= 0), F.lit(f"no {value}")).when(w.isNull() | (w <= 0), F.lit(f"no {weight}"))
    r = rows.withColumn("_why", reason)
    ok = F.col("_why").isNull()
    return r.groupBy(*by).agg((F.sum(F.when(ok, v * w)) / F.nullif(F.sum(F.when(ok, w)), F.lit(0.0))).alias("mean"), F.map_from_entries(F.array_sort(F.collect_list(F.when(~ok, F.struct(F.col(id).cast("string"), "_why"))))).alias("excluded"))


def weighted_percentiles(rows: DataFrame, value: str, weight: str, points: list[float], by: list[str] = ()) -> DataFrame:
    """by, q, value: percentiles at the middle of each value's weight, straight lines between, flat outside.

    Equal values are summed first, so the window runs over distinct values.
    """
    by = list(by)
    d = rows.where(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.sum(weight).alias("w"))
    w = Window.partitionBy(*by).orderBy("v")
    total = F.sum("w").over(Window.partitionBy(*by))
    d = d.withColumn("p", (F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w") / 2) / total)
    d = d.withColumn("p0", F.lag("p").over(w)).withColumn("v0", F.lag("v").over(w)).withColumn("p9", F.max("p").over(Window.partitionBy(*by)))
    d = d.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in points])))
    line = F.col("v0") + (F.col("v") - F.col("v0")) * (F.col("q") - F.col("p0")) / (F.col("p") - F.col("p0"))
    here = ((F.col("p0") < F.col("q")) & (F.col("q") <= F.col("p"))) | (F.col("p0").isNull() & (F.col("q") <= F.col("p"))) | ((F.col("p") == F.col("p9")) & (F.col("q") > F.col("p")))
    inside = (F.col("p0") < F.col("q")) & (F.col("q") <= F.col("p"))
    return d.where(here).select(*by, "q", F.when(F.coalesce(inside, F.lit(False)), line).otherwise(F.col("v")).alias("value"))


def priors(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, n, mean, median, p10, p90, min, max over the values that are there."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])).alias("m")).select("m.*")
    q = lambda p: F.percentile("x", F.lit(p))
    return long.groupBy("metric").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), q(0.5).alias("median"), q(0.1).alias("p10"), q(0.9).alias("p90"), F.min("x").alias("min"), F.max("x").alias("max"))


def histogram(rows: DataFrame, by: str, value: Column, bins: int = 5) -> DataFrame:
    """Counts by equal bins of [0, 1], the last one closed."""
    return rows.groupBy(by, F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def stage_outcomes(events: DataFrame, stage: str, outcome: str, seconds: str, order: str) -> DataFrame:
    """One error makes a stage's outcome an error; else the first one counts."""
    first = F.min_by(outcome, order)
    return events.groupBy(stage).agg(F.when(F.bool_or(F.col(outcome) == "error"), F.lit("error")).otherwise(first).alias("outcome"), F.count("*").alias("attempts"), F.round(F.sum(seconds), 1).alias("seconds"))


def slot_totals(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, total, issue: one distinct value is the total however often stated, several conflict, none is unresolved.

    Keys hold the unit, so units never mix.
    """
    n, n_distinct, n_null = F.count("*"), F.count_distinct(F.col(value)), F.count_if(F.col(value).isNull())
    issue = F.when(n_null > 0, F.lit("unresolved")).when(n_distinct > 1, F.lit("conflict")).when(n > 1, F.lit("duplicate"))
    return rows.groupBy(*keys).agg(F.when((n_null == 0) & (n_distinct == 1), F.max(value)).alias("total"), issue.alias("issue"))


def level_and_total(rows: DataFrame, level: str, sums: dict[str, Column], total: str = "total") -> DataFrame:
    """Sums by level and over all of them, in one pass."""
    out = rows.rollup(level).agg(*[F.sum(c).alias(k) for k, c in sums.items()], F.grouping(level).alias("_all"))
    return out.withColumn(level, F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(level))).drop("_all")


def calibration_table(claims: DataFrame, by: list[str] = ("confidence", "kind")) -> DataFrame:
    """Claims, correct, abstained and unverifiable ones by confidence and kind."""
    c = lambda x: F.count_if(F.coalesce(F.col(x), F.lit(False)))
    return claims.groupBy(*by).agg(F.count("*").alias("claims"), c("correct").alias("correct"), c("abstained").alias("abstained"), c("unverifiable").alias("unverifiable"))


def reliability(rows: DataFrame, probability: str, right: str, bins: int = 10) -> DataFrame:
    """bin, n, confidence, accuracy over bins (lo, hi]; a probability of exactly 0 is in none."""
    b = F.ceil(F.col(probability) * bins).cast("int")
    return rows.where(F.col(probability) > 0).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(probability).alias("confidence"), F.avg(F.col(right).cast("double")).alias("accuracy"))


def expected_calibration_error(rows: DataFrame, probability: str, right: str, bins: int = 10) -> DataFrame:
    """The mean gap between confidence and accuracy, by the share of all rows in a bin."""
    r = reliability(rows, probability, right, bins)
    all_rows = rows.agg(F.count("*").alias("total"))
    return r.crossJoin(F.broadcast(all_rows)).agg(F.sum(F.col("n") / F.col("total") * F.abs(F.col("accuracy") - F.col("confidence"))).alias("ece"))


def average_precision(rows: DataFrame, by: list[str], confidence: str, hit: str, order: list[str], n_truth: str) -> DataFrame:
    """All-point interpolated average precision; null without truth, 0 without a hit.  order breaks ties of confidence."""
    w = Window.partitionBy(*by).orderBy(F.desc(confidence), *order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    tp = F.sum(F.col(hit).cast("long")).over(run)
    p = rows.withColumn("precision", tp / F.count("*").over(run)).withColumn("recall", tp / F.nullif(F.col(n_truth), F.lit(0)))
    p = p.withColumn("best", F.max("precision").over(w.rowsBetween(0, Window.unboundedFollowing))).withColumn("gain", F.col("recall") - F.lag("recall", 1, 0.0).over(w))
    return p.groupBy(*by).agg(F.when(F.max(n_truth) > 0, F.coalesce(F.sum(F.col("gain") * F.col("best")), F.lit(0.0))).alias("ap"))


def schedule_score(predicted: DataFrame, truth: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """n_pred, n_truth, matched, exact, precision, recall, f1 over cells; keys stated twice are left out on both sides."""

    def once(t: DataFrame) -> DataFrame:
        return t.join(t.groupBy(key).agg(F.count("*").alias("_n")).where("_n = 1").select(key), key, "left_semi")

    p, t = once(predicted).select(key, *[F.col(f).alias(f"p_{f}") for f in fields]), once(truth).select(key, *[F.col(f).alias(f"t_{f}") for f in fields])
    j = p.withColumn("in_p", F.lit(1)).join(t.withColumn("in_t", F.lit(1)), key, "full_outer")
    n = lambda cs: sum((F.sum(c.cast("long")) for c in cs), F.lit(0))
    cells_p = n([F.col(f"p_{f}").isNotNull() for f in fields])
    cells_t = n([F.col(f"t_{f}").isNotNull() for f in fields])
    right = n([F.coalesce(F.col(f"p_{f}") == F.col(f"t_{f}"), F.lit(False)) for f in fields])
    same = F.col("in_p").isNotNull() & F.col("in_t").isNotNull()
    for f in fields:
        same = same & F.col(f"p_{f}").eqNullSafe(F.col(f"t_{f}"))
    out = j.agg(F.count("in_p").alias("n_pred"), F.count("in_t").alias("n_truth"), F.count_if(F.col("in_p").isNotNull() & F.col("in_t").isNotNull()).alias("matched"), F.count_if(same).alias("exact"), cells_p.alias("cp"), cells_t.alias("ct"), right.alias("right"))
    pr, rc = F.col("right") / F.nullif("cp", F.lit(0)), F.col("right") / F.nullif("ct", F.lit(0))
    return out.select("n_pred", "n_truth", "matched", "exact", pr.alias("precision"), rc.alias("recall"), (2 * pr * rc / F.nullif(pr + rc, F.lit(0.0))).alias("f1"))


def envelope_summary(walls: DataFrame, openings: DataFrame, by: str | None = None) -> DataFrame:
    """wall and window areas, counts, window-to-wall ratio (0 without walls) and the facades in order."""
    g = [by] if by else []
    w = walls.groupBy(*g).agg(F.sum(F.coalesce("area_m2", F.col("length_m") * F.col("height_m"))).alias("wall_area"), F.count("*").alias("n_walls"), F.array_join(F.array_sort(F.collect_set("facade")), ",").alias("facades"))
    o = openings.where("category = 'window'").groupBy(*g).agg(F.sum("area_m2").alias("window_area"), F.count("*").alias("n_windows"))
    j = w.join(o, by, "full_outer") if by else w.crossJoin(o)
    j = j.na.fill(0.0, ["wall_area", "window_area"]).na.fill(0, ["n_walls", "n_windows"])
    return j.withColumn("wwr", F.when(F.col("wall_area") > 0, F.col("window_area") / F.col("wall_area")).otherwise(0.0))


def top_words(rows: DataFrame, text: str, stop: list[str], k: int) -> DataFrame:
    """The k commonest words of over two letters that aren't stop words, ties in alphabetical order."""
    words = rows.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))).alias("word"))
    return words.where((F.length("word") > 2) & ~F.col("word").isin(stop)).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(k)


def revision_index(rows: DataFrame, mark: str, sheet: str) -> DataFrame:
    """Revision mark in upper case to its sheets in order; marks that begin with ADD are addenda."""
    m = F.upper(F.trim(F.col(mark)))
    return rows.groupBy(m.alias("mark")).agg(F.array_join(F.array_sort(F.collect_set(F.col(sheet).cast("string"))), ",").alias("sheets")).withColumn("addendum", F.col("mark").startswith("ADD"))


def learn_legend(rows: DataFrame, description: str, kind: str) -> DataFrame:
    """description, kind, conflict: descriptions seen with one kind are learned, with several not."""
    g = rows.groupBy(F.lower(F.trim(description)).alias("description")).agg(F.array_sort(F.collect_set(kind)).alias("kinds"))
    return g.select("description", F.when(F.size("kinds") == 1, F.col("kinds")[0]).alias("kind"), (F.size("kinds") > 1).alias("conflict"))


def alike(rows: DataFrame, n: int, id: str = "id", words: str = "words") -> DataFrame:
    """a, b, j: the n rows that share most words with each row by Jaccard's measure, ties by id; those that share none are none.

    Equal sets of words are compared once, and only sets with a word in common
    meet; of the rows of one set the n + 1 least ids are all that can be among
    another's best.
    """
    from planweave.functions.text import jaccard

    r = rows.select(F.col(id).alias("id"), F.array_sort(words).alias("set"))
    w = Window.partitionBy("set").orderBy("id")
    first = r.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n + 1).select("set", F.col("id").alias("b"))
    sets = r.select("set").distinct()
    one, two = (sets.select(F.col("set").alias(s), F.explode("set").alias("w")) for s in ("x", "y"))
    met = one.join(two, "w").select("x", "y").distinct().withColumn("j", jaccard(F.col("x"), F.col("y")))
    best = Window.partitionBy("x").orderBy(F.desc("j"), "b")
    top = met.join(first, F.col("y") == F.col("set")).withColumn("r", F.row_number().over(best)).where(F.col("r") <= n + 1).select("x", "b", "j")
    found = r.join(top, F.col("set") == F.col("x")).where("id <> b").select(F.col("id").alias("a"), "b", "j")
    return found.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("j"), "b"))).where(F.col("r") <= n).drop("r")
