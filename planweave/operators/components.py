"""Connected components by alternating large-star and small-star rounds.

Each round is a grouped minimum with map-side combine plus a join, so a hub
with any number of links never has to fit one task, and the number of rounds
grows with the logarithm of the longest path.  Every round is cut by a stored
table, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planweave.session import discard, stored


#: Edges that one task of a round takes on; few edges take few tasks.
EDGES_PER_TASK = 100_000


def _star(edges: DataFrame, smaller_only: bool, tasks: int) -> DataFrame:
    """Link the neighbours of every node to the least node among it and them.

    edges has (u, v) with u > v.  Large star looks at both directions and links
    the larger neighbours; small star links the node and its smaller neighbours.
    """
    if smaller_only:
        seen = edges
    else:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = seen.join(least, "u").coalesce(tasks)
    if smaller_only:
        link = F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        # Each edge is there from both ends: its larger one links to the least node around the smaller one.
        link = F.array(F.when(F.col("v") > F.col("u"), F.struct(F.col("v").alias("a"), F.col("m").alias("b"))), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
    out = joined.select(F.inline(F.filter(link, lambda x: x.a > x.b)))
    return out.distinct().coalesce(tasks).select(F.col("a").alias("u"), F.col("b").alias("v"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an undirected edge table; component is the least node reachable.

    Loops and rows with a null end are ignored; an empty table gives no rows.
    """
    now = stored(
        edges.where(f"{a} is not null and {b} is not null and {a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "components",
    )
    digest, tasks = None, max(1, -(-now.count() // EDGES_PER_TASK))
    while True:  # labels only ever fall, so this ends; rounds grow with the logarithm of the longest path
        after = stored(_star(_star(now, False, tasks), True, tasks), "components")
        told = after.agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(now)
        now = after
        if told == digest:
            break
        digest = told
    labels = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return labels.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).coalesce(2 * tasks)
