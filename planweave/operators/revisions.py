"""Revisions: fingerprints, diffs, re-identification, history, decision replay, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.functions.text import jaccard, name_tokens, normalize_name


def fingerprint(columns: list[Column], digits: int = 4) -> Column:
    """sha1 of the columns in a fixed notation: numbers rounded, null as the empty string."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha1(F.concat_ws("|", *text))


def number(c, digits: int = 2) -> Column:
    """A number as text with a fixed count of digits."""
    return F.format_string(f"%.{digits}f", (F.col(c) if isinstance(c, str) else c).cast("double"))


def diff(old: DataFrame, new: DataFrame, key: str, groups: dict[str, list[Column]]) -> DataFrame:
    """key, change: new, removed, identical, or the names of the groups whose fingerprints differ, joined by `+`.

    Each side is reduced to its key and one hash per group before the join.
    """

    def hashed(t: DataFrame, side: str) -> DataFrame:
        return t.select(F.col(key), F.lit(1).alias(f"in_{side}"), *[fingerprint(c).alias(f"{g}_{side}") for g, c in groups.items()])

    j = hashed(old, "old").join(hashed(new, "new"), key, "full_outer")
    changed = F.array_join(F.filter(F.array(*[F.when(~F.col(f"{g}_old").eqNullSafe(F.col(f"{g}_new")), F.lit(g)) for g in groups]), lambda x: x.isNotNull()), "+")
    change = F.when(F.col("in_old").isNull(), F.lit("new")).when(F.col("in_new").isNull(), F.lit("removed")).when(changed == "", F.lit("identical")).otherwise(changed)
    return j.select(key, change.alias("change"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count("*").alias("n"))


def before_after(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """lost, flipped, gained, same: how a mapping changed between two runs."""
    j = before.select(key, F.col(value).alias("o")).join(after.select(key, F.col(value).alias("n")), key, "full_outer")
    o, n = F.col("o"), F.col("n")
    c = lambda x, name: F.count_if(F.coalesce(x, F.lit(False))).alias(name)
    return j.agg(c(o.isNotNull() & n.isNull(), "lost"), c(o != n, "flipped"), c(o.isNull() & n.isNotNull(), "gained"), c(o == n, "same"))


def reidentify(removed: DataFrame, added: DataFrame, id: str, level: str, name: str, area: str, x: str | None = None, y: str | None = None, tolerance: float = 0.01) -> DataFrame:
    """old_id, new_id, score: removed and added rooms that are one, best first, each at most once.

    Candidates share the level and their areas differ by at most a hundredth.
    An equal name that is unique on both sides scores 3; else names must share
    half of their words and score 2 and that share, less how far the centres are apart.
    """
    from planweave.operators.ordered import best_pairs

    def side(t: DataFrame, s: str) -> DataFrame:
        n = normalize_name(name)
        unique = F.count("*").over(Window.partitionBy(level, n)) == 1
        cols = [F.col(id).alias(f"{s}_id"), F.col(level).alias("level"), F.col(area).alias(f"{s}_area"), n.alias(f"{s}_name"), name_tokens(name).alias(f"{s}_words"), unique.alias(f"{s}_unique")]
        cols += [F.col(x).alias(f"{s}_x"), F.col(y).alias(f"{s}_y")] if x else []
        return t.select(*cols)

    # Areas within a hundredth are in the same or neighbouring steps of a geometric scale.
    step = F.floor(F.log(F.greatest(F.col("o_area"), F.lit(1e-9))) / F.log(F.lit(1 + tolerance)))
    step_n = F.floor(F.log(F.greatest(F.col("n_area"), F.lit(1e-9))) / F.log(F.lit(1 + tolerance)))
    o = side(removed, "o").withColumn("step", F.explode(F.array(step - 2, step - 1, step, step + 1, step + 2)))
    n = side(added, "n").withColumn("step", step_n)
    j = o.join(n, ["level", "step"]).where(F.abs(F.col("o_area") - F.col("n_area")) <= tolerance * F.col("o_area"))
    same = (F.col("o_name") == F.col("n_name")) & F.col("o_unique") & F.col("n_unique")
    share = jaccard(F.col("o_words"), F.col("n_words"))
    apart = F.hypot(F.col("o_x") - F.col("n_x"), F.col("o_y") - F.col("n_y")) if x else F.lit(0.0)
    score = F.when(same, F.lit(3.0)).when(share >= 0.5, 2 + share - F.least(apart / 1000, F.lit(0.5)))
    pairs = j.withColumn("score", score).where("score is not null").select(F.col("o_id").alias("old_id"), F.col("n_id").alias("new_id"), "score")
    return best_pairs(pairs, "old_id", "new_id", "score")


def history(events: DataFrame, key: str, order: list[str], valid: str) -> DataFrame:
    """events with valid_from, valid_to (null for the current one) and is_current."""
    w = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("valid_from", F.col(valid)).withColumn("valid_to", F.lead(valid).over(w)).withColumn("is_current", F.lead(F.lit(1)).over(w).isNull())


def final_states(decisions: DataFrame, item: str, action: str, order: list[str]) -> DataFrame:
    """The last decision on each item; a revert leaves none (null)."""
    w = Window.partitionBy(item).orderBy(*[F.desc(o) for o in order])
    last = decisions.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return last.select(item, F.when(F.col(action) != "revert", F.col(action)).alias("state"))


def apply_decisions(items: DataFrame, decisions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """items with status and resolution of the last decision; raises if any decision names no item or no known action."""
    bad = decisions.join(items, key, "left_anti").select(key).union(decisions.where(~F.col("action").isin("confirm", "reject", "edit", "revert")).select(key)).limit(5).collect()
    if bad:
        raise ValueError(f"decisions refused, none applied: {[r[0] for r in bad]}")
    w = Window.partitionBy(key).orderBy(*[F.desc(o) for o in order])
    last = decisions.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(key, F.col("action").alias("_action"), F.col("value").alias("_value"))
    j = items.join(last, key, "left")
    done = F.col("_action").isNotNull() & (F.col("_action") != "revert")
    return j.withColumn("status", F.when(done, F.col("_action")).otherwise(F.col("status"))).withColumn("resolution", F.when(done, F.col("_value"))).drop("_action", "_value")


def undo_last(corrections: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """corrections with undone set on the last n that still hold, by group."""
    w = Window.partitionBy(*by, "undone").orderBy(*[F.desc(o) for o in order])
    return corrections.withColumn("_r", F.row_number().over(w)).withColumn("undone", F.col("undone") | (F.col("_r") <= n)).drop("_r")


def automatic_values(corrections: DataFrame, key: list[str], order: str) -> DataFrame:
    """key, value: what the earliest correction that still holds replaced."""
    return corrections.where("not undone").groupBy(*key).agg(F.min_by("before", order).alias("value"))


def append_new(have: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """have and those rows of more whose key it lacks: appending twice changes nothing."""
    return have.unionByName(more.dropDuplicates([key]).join(have.select(key), key, "left_anti"), allowMissingColumns=True)


def correction_counts(corrections: DataFrame) -> DataFrame:
    """total, undone, human and auto corrections."""
    return corrections.agg(F.count("*").alias("total"), F.count_if(F.coalesce("undone", F.lit(False))).alias("undone"), F.count_if(F.col("source") == "human").alias("human"), F.count_if(F.col("source") == "auto").alias("auto"))


def acknowledged(review: DataFrame) -> DataFrame:
    """The review queue with everything that waits acknowledged; `now` says which items that changed."""
    waits = F.coalesce(F.col("needs_review"), F.lit(False)) & ~F.coalesce(F.col("acknowledged"), F.lit(False))
    return review.withColumn("now", waits).withColumn("acknowledged", F.coalesce(F.col("acknowledged"), F.lit(False)) | waits)


def covered_partials(sheets: DataFrame) -> DataFrame:
    """The partial plans whose discipline and level a full plan has, nulls being equal: file."""
    key = lambda t, s: t.select("file", F.col("discipline").alias(f"d{s}"), F.col("level").alias(f"l{s}"))
    full = key(sheets.where("kind in ('floor_plan', 'plan')"), "b").select("db", "lb").distinct()
    return key(sheets.where("kind = 'partial_plan'"), "a").join(full, F.col("da").eqNullSafe(F.col("db")) & F.col("la").eqNullSafe(F.col("lb")), "left_semi").select("file")


def first_of_each(rows: DataFrame, key: list, order: list) -> tuple[DataFrame, DataFrame]:
    """(the first row of each key, the later ones); a null key is none and its rows all stay."""
    w = Window.partitionBy("_key").orderBy(*order)
    r = rows.withColumn("_key", F.struct(*key)).withColumn("_none", sum((c.isNull().cast("int") for c in key), F.lit(0)) > 0).withColumn("_r", F.row_number().over(w))
    keep = (F.col("_r") == 1) | F.col("_none")
    return r.where(keep).drop("_key", "_none", "_r"), r.where(~keep).drop("_key", "_none", "_r")


def level_heights(levels: DataFrame, marks: DataFrame, stated: DataFrame, default: float = 3.0, agree: float = 0.05) -> DataFrame:
    """level, height_m, source, conflict: a stated height over the mean of marks that agree over the default; marks that don't are named."""
    m = marks.groupBy("level").agg(F.avg("height_m").alias("mean"), (F.max("height_m") - F.min("height_m")).alias("spread"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "sheet", F.format_string("%.2f m", "height_m")))), "; ").alias("said"))
    j = levels.select("level").join(m, "level", "left").join(stated.select("level", F.col("height_m").alias("config")), "level", "left")
    agreed = F.coalesce(F.col("spread") <= agree, F.lit(False))
    return j.select("level", F.when(F.col("config").isNotNull(), F.col("config")).when(agreed, F.round("mean", 4)).otherwise(default).alias("height_m"), F.when(F.col("config").isNotNull(), "config").when(agreed, "elevation_level_marks").otherwise("storey_height_default").alias("source"), F.when(F.col("config").isNull() & ~agreed & F.col("said").isNotNull(), F.col("said")).otherwise("").alias("conflict"))


def arm_stats(runs: DataFrame, arm: str, metric: str, base: str) -> DataFrame:
    """arm, n, mean, sd and the mean's distance from the base arm's."""
    g = runs.groupBy(arm).agg(F.count(metric).alias("n"), F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("sd"))
    of_base = g.where(F.col(arm) == base).select(F.col("mean").alias("_base"))
    return g.crossJoin(of_base).select(arm, "n", "mean", "sd", (F.col("mean") - F.col("_base")).alias("delta"))
