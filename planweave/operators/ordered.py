"""Order-dependent operators: islands, steps, apportionment, guarded ranking, sequence numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, by: list[str], order: str, gap, ties: list[str] = ()) -> DataFrame:
    """rows with island (from 1): a new one begins where a value is over `gap` beyond the one before it."""
    w = Window.partitionBy(*by).orderBy(order, *ties)
    far = F.col(order) - F.lag(order).over(w) > gap
    return rows.withColumn("_new", F.when(F.lag(order).over(w).isNull() | far, 1).otherwise(0)).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def merged_intervals(rows: DataFrame, by: list[str], lo: str, hi: str, slack: float = 0.0) -> DataFrame:
    """by, lo, hi, n: intervals joined where one begins within `slack` of the furthest end so far.

    A null sorts last, as in SQL.  Intervals with equal ends are alike, so their order changes nothing:
    both sums below go over one and the same sorted rows.
    """
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_last(lo), F.asc_nulls_last(hi))
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = rows.withColumn("_new", F.when(reach.isNull() | (F.col(lo) > reach + slack), 1).otherwise(0)).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*by, "_g").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count("*").alias("n")).drop("_g")


def steps(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """by, name, step: how far each value lies below the next higher distinct one."""
    d = rows.groupBy(*by, value).agg(F.min(name).alias(name))
    return d.withColumn("step", F.lead(value).over(Window.partitionBy(*by).orderBy(value)) - F.col(value)).where("step is not null").select(*by, name, "step")


def apportion(rows: DataFrame, by: list[str], weight: str, units: Column, order: list[str]) -> DataFrame:
    """rows with units: whole units shared by weight, what is left over to the largest remainders, then weights, then in order."""
    total = F.sum(weight).over(Window.partitionBy(*by))
    r = rows.withColumn("_quota", F.when(total > 0, units * F.col(weight) / total).otherwise(0.0)).withColumn("_base", F.floor("_quota"))
    left = units - F.sum("_base").over(Window.partitionBy(*by))
    w = Window.partitionBy(*by).orderBy((F.col("_quota") - F.col("_base")).desc(), F.col(weight).desc(), *order)
    return r.withColumn("_left", left).withColumn("_r", F.row_number().over(w)).withColumn("units", (F.col("_base") + F.when((F.col("_r") <= F.col("_left")) & (F.col("_quota") > 0), 1).otherwise(0)).cast("long")).drop("_quota", "_base", "_left", "_r")


def guarded_best(rows: DataFrame, by: list[str], score: str, id: str, guard: float) -> DataFrame:
    """by, id, score, reason: the best of each group, or a null id and `tie` if the next comes within the guard."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), id)
    r = rows.withColumn("_r", F.row_number().over(w)).withColumn("_next", F.lead(score).over(w)).where("_r = 1")
    tie = F.coalesce(F.col(score) - F.col("_next") < guard, F.lit(False))
    return r.select(*by, F.when(~tie, F.col(id)).alias(id), F.col(score), F.when(tie, F.lit("tie")).alias("reason"))


def ranked(rows: DataFrame, order: list[Column], by: list[str] = (), name: str = "seq") -> DataFrame:
    """rows with a sequence number from 1 in a total order."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def running_sum(rows: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    """rows with the sum of `value` up to and with each row, over all rows in a total order, no task holding them all.

    Rows are dealt to ranges of the order and stored; sums of whole ranges are
    added first, a row per range, then those within a range.
    """
    from planweave.session import stored

    r = stored(rows.withColumn("_value", value).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = r.groupBy("_part").agg(F.sum("_value").alias("_sum")).withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).select("_part", "_ahead")
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return r.join(parts, "_part").withColumn(name, F.col("_ahead") + F.sum("_value").over(within)).drop("_part", "_ahead", "_value")


def numbered(rows: DataFrame, order: list, name: str = "seq") -> DataFrame:
    """rows with their number from 1 in a total order over all of them."""
    return running_sum(rows, order, F.lit(1).cast("bigint"), name)


def best_pairs(pairs: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """Greedy one-to-one matching, best score first, ties by a then b: a, b, score.  A null end pairs with nothing.

    In each round the pairs that are best for both of their ends are taken and
    all pairs of those ends go; that gives the same as taking the pairs one by
    one in order, with no pass over all of them on one machine.  Where some ends
    are each other's best with one and the same score, every one with every
    other, the order pairs them by rank, and the round takes them all.  Rounds
    go on until no pair is left; each takes one at least.
    """
    from planweave.session import discard, stored

    left, taken, n = stored(pairs.select(a, b, score).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "pairs"), None, 0
    while True:
        order = [F.desc(score), a, b]
        of_a, of_b = Window.partitionBy(a), Window.partitionBy(b)
        best = left.withColumn("_a", F.row_number().over(of_a.orderBy(*order))).withColumn("_b", F.row_number().over(of_b.orderBy(*order))).where("_a = 1 and _b = 1").select(a, b, score)
        # A block: the pairs at both ends' best scores whose ends have the same first partners; whole if no end has another partner at that score.
        top = left.withColumn("_a", F.rank().over(of_a.orderBy(F.desc(score)))).withColumn("_b", F.rank().over(of_b.orderBy(F.desc(score))))
        top = top.withColumn("_na", F.count_if(F.col("_a") == 1).over(of_a)).withColumn("_nb", F.count_if(F.col("_b") == 1).over(of_b))
        top = top.withColumn("_fa", F.min(F.when(F.col("_a") == 1, F.col(b))).over(of_a)).withColumn("_fb", F.min(F.when(F.col("_b") == 1, F.col(a))).over(of_b)).where("_a = 1 and _b = 1 and _na > 1 and _nb > 1")
        key = ["_fa", "_fb", "_na", "_nb"]
        whole = top.groupBy(*key, score).agg(F.count("*").alias("_n"), F.count_distinct(a).alias("_ma"), F.count_distinct(b).alias("_mb")).where("_n = _na * _nb and _ma = _nb and _mb = _na").drop("_n", "_ma", "_mb")
        member = lambda c: top.select(*key, score, c).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(*key, score).orderBy(c)))
        same = lambda x, y: [F.col(f"x.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in (*key, score)]
        block = whole.alias("x").join(member(a).alias("p"), same("x", "p")).join(member(b).alias("q"), [*same("x", "q"), F.col("p._r") == F.col("q._r")]).select(f"p.{a}", f"q.{b}", f"x.{score}")
        best = stored(best.unionByName(block).distinct(), "pairs")
        taken, n = best if taken is None else taken.unionByName(best), n + 1
        rest = stored(left.join(best.select(a), a, "left_anti").join(best.select(b), b, "left_anti").select(a, b, score), "pairs")
        discard(left)
        left = rest
        if left.isEmpty():
            return taken
        if n % 16 == 0:
            parts, taken = taken, stored(taken, "pairs")
            discard(parts)


def match_pairs(rows: DataFrame, key: list[str], side: str) -> DataFrame:
    """key, a, b, status: keys found on exactly two sides pair them, on one are unpaired, on more conflict."""
    g = rows.groupBy(*key).agg(F.array_sort(F.collect_set(side)).alias("s"))
    n = F.size("s")
    return g.select(*key, F.when(n == 2, F.col("s")[0]).alias("a"), F.when(n == 2, F.col("s")[1]).alias("b"), F.when(n == 2, F.lit("paired")).when(n < 2, F.lit("unpaired")).otherwise(F.lit("conflict")).alias("status"))
