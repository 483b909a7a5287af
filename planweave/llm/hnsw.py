"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Rows of one label are dealt by a hash of their id into shards of about
`shard_rows`, two at least, and each shard gets a graph: points on geometric
levels, linked to diverse near neighbours.  Every block of vectors is searched
in every shard of its label.  A beam is widened while it is full of vectors
above the threshold, and a whole block is searched again with beams twice as
wide until an audit passes: for some of its vectors, spread evenly, the links
found are all that a full scan of the shard finds.  An audit takes in more of
the block until its scans have shown enough links, if need be all of the block,
and what a scan has shown is what is reported.  Cosines are verified in
double precision, and the links' components are joined.

Equal vectors are one point with a count.  A block reports a point's number of
links and a spanning forest of the links it found, not the links themselves, so
what is passed on grows with the points and not with the square of a group.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.llm import _arrow, _vectors, _words
from planweave.operators.components import connected_components
from planweave.session import discard, stored

LINKS = 12
BUILD_BEAM = 48
BEAM = 32
AUDITS = 24
AUDIT_LINKS = 100


class Graph:
    """Levels of neighbour lists over unit vectors; the order of insertion is that of the rows."""

    def __init__(self, unit: np.ndarray, neighbours: list[np.ndarray] | None = None, levels: np.ndarray | None = None):
        self.unit = unit
        n = len(unit)
        self.seen = np.zeros(n, np.int64)
        self.mark = 0
        if neighbours is not None:
            self.near, self.levels = neighbours, levels
        else:
            h = _words.mix(np.arange(1, n + 1, dtype=np.uint64))
            u = ((h >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
            self.levels = np.minimum((-np.log(u) / np.log(LINKS)).astype(np.int64), 6)
            top = int(self.levels.max()) if n else -1
            self.near = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(top + 1)]
            self.entry, self.high = -1, -1
            for i in range(n):
                self._insert(i)
        if n:
            self.high = int(self.levels.max())
            self.entry = int(np.argmax(self.levels == self.high))

    def _beam(self, q: np.ndarray, start: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The best (similarity, point) found, the least first."""
        self.mark += 1
        mark, seen, near, unit = self.mark, self.seen, self.near[level], self.unit
        seen[start] = mark
        first = [(float(s), p) for s, p in zip(unit[start] @ q, start)]
        todo = [(-s, p) for s, p in first]
        heapq.heapify(todo)
        best = list(first)
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            s, p = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            around = near[p]
            around = around[around >= 0]
            around = around[seen[around] != mark]
            if not len(around):
                continue
            seen[around] = mark
            sims = unit[around] @ q
            if len(best) >= width:
                ok = sims > best[0][0]
                around, sims = around[ok], sims[ok]
            for x, o in zip(sims.tolist(), around.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (x, o))
                    heapq.heappush(todo, (-x, o))
                elif x > best[0][0]:
                    heapq.heapreplace(best, (x, o))
                    heapq.heappush(todo, (-x, o))
        return best

    def _down(self, q: np.ndarray, to: int) -> list[int]:
        at = [self.entry]
        for level in range(self.high, to, -1):
            at = [max(self._beam(q, at, 1, level))[1]]
        return at

    def _choose(self, of: np.ndarray, points: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Near and diverse points: each nearer to `of` than to those chosen before; then the nearest left over."""
        order = np.argsort(-sims, kind="stable")
        points, sims = points[order], sims[order]
        among = self.unit[points] @ self.unit[points].T
        chosen: list[int] = []
        for i in range(len(points)):
            if len(chosen) == most:
                break
            if not chosen or (among[i, chosen] < sims[i]).all():
                chosen.append(i)
        if len(chosen) < most:
            left = [i for i in range(len(points)) if i not in set(chosen)]
            chosen += left[: most - len(chosen)]
        return points[chosen]

    def _insert(self, i: int) -> None:
        level = int(self.levels[i])
        if self.entry < 0:
            self.entry, self.high = i, level
            return
        q = self.unit[i]
        at = self._down(q, level)
        for k in range(min(level, self.high), -1, -1):
            found = self._beam(q, at, BUILD_BEAM, k)
            points = np.array([p for _, p in found])
            sims = np.array([s for s, _ in found])
            chosen = self._choose(q, points, sims, LINKS)
            near = self.near[k]
            near[i, : len(chosen)] = chosen
            for p in chosen.tolist():
                row = near[p]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                else:
                    both = np.append(row, i)
                    near[p] = self._choose(self.unit[p], both, self.unit[both] @ self.unit[p], len(row))
            at = points.tolist()
        if level > self.high:
            self.entry, self.high = i, level

    def above(self, q: np.ndarray, least: float, width: int) -> np.ndarray:
        """The points found at similarity `least` or more; the beam is widened while it is full of them."""
        n = len(self.unit)
        if not n:
            return np.zeros(0, np.int64)
        at = self._down(q, 0)
        while True:
            found = self._beam(q, at, min(width, n), 0)
            hits = [p for s, p in found if s >= least]
            if len(hits) < len(found) * 0.75 or width >= n:
                return np.array(hits, np.int64)
            width *= 2

    def pack(self) -> bytes:
        """Levels and neighbour lists."""
        return _vectors.pack_all([self.levels, *self.near])

    @classmethod
    def unpack(cls, unit: np.ndarray, blob: bytes) -> "Graph":
        levels, *near = _vectors.unpack_all(blob)
        return cls(unit, near, levels[0])


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of one vector with many, in double precision."""
    return (y @ x) / (np.sqrt((y * y).sum(axis=1)) * np.sqrt((x * x).sum()))


class _Forest:
    """Union-find that says whether two points were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, a: int) -> int:
        up = self.up
        while (b := up.get(a, a)) != a:
            up[a] = up.get(b, b)
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def search_block(graph: Graph, points: np.ndarray, ids: np.ndarray, q_points: np.ndarray, q_ids: np.ndarray, cosine: float) -> tuple[list[np.ndarray], int, float]:
    """(places of the linked points by query, width of the beams in the end, recall of the last audit)."""
    least = cosine - 1e-6  # verified afterwards
    units = _unit(q_points)
    size = np.sqrt((points * points).sum(axis=1))
    truth: dict[int, np.ndarray] = {}
    there, step = 0, 1 << max(0, (len(q_ids) - 1).bit_length())
    # Queries in an order whose beginnings are spread evenly.
    order = dict.fromkeys(np.linspace(0, len(q_ids) - 1, min(AUDITS, len(q_ids))).astype(int).tolist())
    while step:
        order.update(dict.fromkeys(range(0, len(q_ids), step)))
        step //= 2
    for i in order:
        if len(truth) >= AUDITS and there >= AUDIT_LINKS:
            break
        hits = np.flatnonzero(points @ q_points[i] >= least * size * np.sqrt((q_points[i] * q_points[i]).sum()))
        hits = hits[ids[hits] != q_ids[i]]
        truth[i] = hits[_cosines(q_points[i], points[hits]) >= cosine] if len(hits) else hits
        there += len(truth[i])
    width = BEAM

    def links(i: int) -> np.ndarray:
        hits = graph.above(units[i], least, width)
        hits = hits[ids[hits] != q_ids[i]]
        return hits[_cosines(q_points[i], points[hits]) >= cosine] if len(hits) else hits

    shown = [i for i, t in truth.items() if len(t)]
    while len(truth) < len(q_ids):
        recall = sum(len(np.intersect1d(truth[i], links(i))) for i in shown) / there
        if recall == 1.0 or width >= len(points):
            break
        width *= 2
    else:
        recall = 1.0  # every query's links are those of a scan
    return [truth[i] if i in truth else links(i) for i in range(len(q_ids))], width, recall


def near_vectors(vectors: DataFrame, cosine: float = 0.93, id: str = "vec_id", vector: str = "embedding", label: str = "label", shard_rows: int = 16384, query_rows: int = 1024, audited: bool = False) -> DataFrame:
    """id, n_links, component_id and kept, one row per row of vectors.

    With audited also recall and beam: the least recall that the audits of a
    vector's searches ended with, and their widest beam; null where there were none.

    Vectors are linked when their labels are equal and not null and their cosine
    is `cosine` or more; those that are null, empty, zero or hold a null or
    non-finite component link with nothing, nor do vectors of different lengths
    or rows with a null id, whose component is null and which stay.  Rows of one
    id and vector are one.  An empty table gives no rows.
    """
    rows = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    zero = ~F.exists("v", lambda x: x != 0)
    able = _vectors.whole("v") & ~zero & F.col("label").isNotNull() & F.col("id").isNotNull()
    part = stored(rows.where(able).dropDuplicates(["id", "label", "v"]), "hnsw")
    points = stored(part.groupBy("label", "v").agg(F.min("id").alias("node"), F.count("*").alias("n")).withColumn("dim", F.size("v")), "hnsw")

    def as_block(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("node").to_numpy(), kind="stable")
        one = lambda c: t.column(c).slice(0, 1).combine_chunks()
        block = lambda x: pa.array([x], pa.binary())
        v = _vectors.matrix(t.column("v"))[order]
        return pa.table([one("label"), one("dim"), one("block"), block(t.column("node").to_numpy()[order].tobytes()), block(t.column("n").to_numpy()[order].tobytes()), block(_vectors.pack(v))], names=["label", "dim", "block", "ids", "n", "points"])

    def as_shard(t: pa.Table) -> pa.Table:
        b = as_block(t)
        graph = Graph(_unit(_vectors.unpack(b.column("points")[0].as_py())))
        return b.append_column("graph", pa.array([graph.pack()], pa.binary()))

    kind = points.schema["label"].dataType.simpleString()
    schema = f"label {kind}, dim int, block int, ids binary, n binary, points binary"
    group = ["label", "dim"]
    shards = _vectors.blocked(points, group, "node", shard_rows)
    shards = shards.withColumn("block", F.pmod(F.xxhash64("node"), F.greatest("n_blocks", F.lit(2))).cast("int"))
    shards = stored(shards.groupBy(*group, "block").applyInArrow(*_arrow.groups(as_shard, schema + ", graph binary")), "hnsw")
    asks = stored(_vectors.blocked(points, group, "node", query_rows).groupBy(*group, "block").applyInArrow(*_arrow.groups(as_block, schema)), "hnsw")
    asked = asks.select(*group, F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("points").alias("q_points"))
    met = _vectors.meet(shards, asked, group)

    def run(batches):
        held = graph = v = here = times = None
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            for i in range(len(batch)):
                get = lambda c: col[c][i].as_py()  # noqa: E731, B023
                key = [get(c) for c in (*group, "block")]
                if get("kind") == 0:
                    held = key
                    here, times, v = np.frombuffer(get("ids"), np.int64), np.frombuffer(get("n"), np.int64), _vectors.unpack(get("points"))
                    graph = Graph.unpack(_unit(v), get("graph"))
                    continue
                if key != held:
                    continue  # no vector fell into that shard
                q_ids, q = np.frombuffer(get("q_ids"), np.int64), _vectors.unpack(get("q_points"))
                found, width, recall = search_block(graph, v, here, q, q_ids, cosine)
                forest = _Forest()
                a, b = [], []
                for p, hits in zip(q_ids.tolist(), found):
                    for o in here[hits].tolist():
                        if forest.join(p, o):
                            a.append(p), b.append(o)
                links = [int(times[hits].sum()) for hits in found]
                n, m = len(links), len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*q_ids.tolist(), *a], pa.int64()), pa.array([*links, *[None] * m], pa.int64()), pa.array([*[None] * n, *b], pa.int64()), pa.array([float(recall)] * (n + m)), pa.array([width] * (n + m), pa.int64())],
                    names=["node", "links", "other", "recall", "beam"],
                )

    told = stored(met.mapInArrow(*_arrow.batches(run, "node bigint, links bigint, other bigint, recall double, beam bigint")), "hnsw")
    discard(shards)
    discard(asks)
    labels = connected_components(told.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = told.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"), F.min("recall").alias("recall"), F.max("beam").alias("beam"))
    nodes = points.select("label", "v", "node", "n").join(links, "node", "left").join(labels, "node", "left")
    of_id = part.join(nodes, ["label", "v"]).groupBy("id").agg(F.max(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.min(F.coalesce("component", "node")).alias("component"), F.min("recall").alias("recall"), F.max("beam").alias("beam"))
    out = rows.select("id").join(of_id, "id", "left").select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id"), *(["recall", "beam"] if audited else []))
    return out.withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [x::DOUBLE for x in embedding] AS z FROM embeddings
), u AS (
  SELECT vec_id, label, z, sqrt(list_dot_product(z, z)) AS norm FROM v
  WHERE label IS NOT NULL AND z IS NOT NULL AND len([x for x in z if x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(z, z) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.z, b.z) / (a.norm * b.norm) >= 0.93
), c(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a
), n AS (
  SELECT a, count(*) AS n FROM e GROUP BY a
)
SELECT v.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(c.b)::BIGINT AS component_id, v.vec_id = min(c.b) AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id GROUP BY v.vec_id
"""
