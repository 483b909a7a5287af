"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame and SQL functions alone.

Sources share the words of the whole corpus by weight; a source's target stops
at `most` times its own words and the excess goes to the others.  A target is
taken as complete epochs of the source first; the rest is a weighted sample
without replacement: every document draws the key -ln(u)/w, where u comes from
a hash of its id and text and w is its quality weight, and documents are taken
in key order until the words left over are used up.  The last document taken
gives the words still missing.

No source is sorted in one task: keys fall into slices of about `slice_rows`
documents, slices are summed first, and only the order inside a slice needs a
window.  Slices lie between measured quantiles of a source's keys, each split
evenly on the keys' logarithm, so that they hold about equally many documents
however the weights are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planweave.session import stored

CUTS = 64
WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5, 2, 1)


def letter_share(text: Column) -> Column:
    """The default quality weight: the squared share of a text's characters that are letters, above 0."""
    share = (F.length(F.regexp_replace(text, r"\P{L}", "")) + 1.0) / (F.length(text) + 1.0)
    return share * share


def source_targets(sizes: DataFrame, most: int = 3, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(source, source_size, n_docs, cuts, target) from (source, source_size, n_docs, cuts).

    Water filling in closed form.  In the order of cap over weight, a source is
    capped if the level that the words and weights left would give reaches its
    cap; the first that is not capped fixes the level for all that follow.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((place - 1) % len(cycle) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = (
        s.withColumn("words_left", F.sum("source_size").over(everything) - F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("weight"))
        .withColumn("level", F.col("words_left") / F.col("weight_left"))
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    )
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return s.withColumn("target", target).select("source", "source_size", "n_docs", "cuts", "target")


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", weight: Column | None = None, most: int = 3, cycle: tuple[int, ...] = CYCLE, seed: str = "mix", slice_rows: int = 1024, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, n_epochs, sample_key.

    With carry, a struct `row` of the document's own columns comes along, so
    that names of theirs never clash with these.  A null text has size 0 and is
    taken 0 words; a null source is a source of its own and comes last.
    Repeated rows draw the same key and follow each other; which of two equal
    rows comes first makes no difference to the result.  A null quality weight,
    or one that isn't above 0, counts as 1e-9.  An empty table gives no rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    w = letter_share(whole) if weight is None else weight
    keyed = docs.select(
        *([F.struct("*").alias("row")] if carry else []),
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
        F.when(w > 0, w).otherwise(F.lit(1e-9)).alias("weight"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("")), F.md5(whole))).alias("draw"),
    )
    u = (F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    keyed = keyed.withColumn("sample_key", -F.log(u) / F.col("weight"))
    narrow = stored(keyed.drop("row"), "mix")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.percentile_approx(F.log("sample_key"), [k / CUTS for k in range(CUTS + 1)], 10_000).alias("cuts"))
    targets = stored(source_targets(sizes, most, cycle), "mix")
    targets = targets.withColumnRenamed("source", "of")

    def sliced(rows: DataFrame) -> DataFrame:
        rows = rows.join(targets, F.col("source").eqNullSafe(F.col("of")))
        # Between which two of the cuts, then how far on the way from one to the other.
        each = F.ceil(F.col("n_docs") / F.lit(slice_rows * CUTS))
        x = F.log("sample_key")
        place = F.greatest(F.lit(1), F.least(F.lit(CUTS), F.size(F.filter("cuts", lambda c: c <= x))))
        low, high = F.element_at("cuts", place), F.element_at("cuts", place + 1)
        on = F.when(high > low, F.floor((x - low) / (high - low) * each)).otherwise(0)
        return rows.withColumn("slice", ((place - 1) * each + F.greatest(F.lit(0), F.least(each - 1, on))).cast("bigint")).drop("cuts")

    before = F.sum("in_slice").over(Window.partitionBy("s_source").orderBy("s_slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("in_slice")
    starts = (
        sliced(narrow)
        .groupBy(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"))
        .agg(F.sum("size").alias("in_slice"))
        .withColumn("before", before)
        .select("s_source", "s_slice", "before")
    )
    within = Window.partitionBy("source", "slice").orderBy("sample_key", "doc_id", "draw")
    budget = F.round("target").cast("long")
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    ahead = F.col("before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return (
        sliced(keyed if carry else narrow)
        .join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
        .withColumn("ahead", ahead)
        .withColumn("n_epochs", epochs)
        .withColumn("taken", epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("ahead"))))
        .select(*(["row"] if carry else []), "doc_id", "source", "size", "source_size", "target", "taken", "n_epochs", "sample_key")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of docs: a document once for each complete epoch and once more if the
    sample takes it; the one document of a source that the sample takes in part is cut after its last word taken,
    and n_chars, where there is such a column, follows the text.  Documents without words have none to take and go.
    """
    plan = mix_sources(docs, carry=True, **options)
    part = F.col("taken") - F.col("n_epochs") * F.col("size")
    copies = plan.withColumn("part", part).where("taken > 0")
    copies = copies.withColumn("copy", F.explode(F.expr("transform(sequence(1, cast(n_epochs + if(part > 0, 1, 0) as int)), i -> if(i <= n_epochs, size, part))")))
    words = F.concat_ws(" ", F.slice(F.regexp_extract_all("row.text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("copy").cast("int")))
    cut = F.when(F.col("copy") == F.col("size"), F.col("row.text")).otherwise(words)
    out = copies.select("row", cut.alias("cut"))
    return out.select(*[F.col("cut").alias(c) if c == "text" else F.length("cut").cast("long").alias(c) if c == "n_chars" else F.col(f"row.{c}").alias(c) for c in docs.columns])


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH k0 AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), k1 AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (length(regexp_replace(text, '\P{L}', '', 'g')) + 1.0::DOUBLE) / (length(text) + 1.0::DOUBLE) AS share,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(text)) AS draw
  FROM k0
), k AS (
  SELECT *, -ln((('0x' || substr(draw, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / (share * share) AS sample_key FROM k1
), s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source
), s1 AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)] AS weight, source_size * 3 AS cap FROM s0
), s2 AS (
  SELECT *, sum(source_size) OVER () - sum(cap) OVER o + cap AS words_left, sum(weight) OVER () - sum(weight) OVER o + weight AS weight_left
  FROM s1 WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), s3 AS (
  SELECT *, words_left::DOUBLE / weight_left AS level, (words_left::DOUBLE / weight_left) * weight >= cap AS capped FROM s2
), s AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE max(CASE WHEN NOT capped THEN level END) OVER () * weight END AS target FROM s3
), o AS (
  SELECT k.doc_id, k.size, s.source_size, s.target, round(s.target)::BIGINT AS budget,
         (sum(k.size) OVER (PARTITION BY k.source ORDER BY sample_key, doc_id, draw ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size)::BIGINT AS ahead
  FROM k JOIN s ON k.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size + greatest(0, least(size, budget % source_size - ahead)) ELSE 0 END)::BIGINT AS taken
FROM o
"""
