"""Exact top-k by inner product with M-trees.

Inner product isn't a metric, so a vector x becomes (x, sqrt(M - |x|^2)), with M
the largest squared norm of its tree, and a query (q, 0): the squared Euclidean
distance of the two is |q|^2 + M - 2 q.x, which falls as the score rises.

Rows are dealt by a hash of their id into trees of about `tree_rows`.  A tree has
pages of up to `page` entries; each entry keeps its routing vector, covering
radius and distance to the page's own routing vector.  Search is best-first:
pages wait in the order of the least distance they can hold; before a distance
is computed, the stored parent distance and the query's distance to the parent
bound it from below by the triangle inequality, and entries whose bound is
beyond the k-th best are passed over.  Bounds are relaxed by a little more than
rounding can add; scores are whole numbers and exact.

A tree is built once and stored as its pages.  Queries come to the trees in
blocks, so that no task holds all queries or all rows; a search task holds one
tree and one block of queries.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planweave.llm import _arrow, _vectors
from planweave.session import stored

PAGE = 48
SLACK = 1e-6


class MTree:
    """A bulk-loaded M-tree over whole-number vectors."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, page: int = PAGE):
        self.ids, self.points = ids, points
        norms = (points.astype(np.float64) ** 2).sum(axis=1)
        self.top = float(norms.max()) if len(ids) else 0.0
        self.metric = np.concatenate([points.astype(np.float64), np.sqrt(np.maximum(self.top - norms, 0))[:, None]], axis=1)
        # A page: routing vector of the page, entries' vectors, distances to the routing vector, radii, children (pages or rows).
        self.pages: list[tuple] = []
        self.computed = 0
        self.root = self._load(np.arange(len(ids)), page) if len(ids) else None

    def pack(self) -> bytes:
        """The tree's pages and what else a search needs."""
        if self.root is None:
            return _vectors.pack_all([np.array([self.top]), self.ids])
        leaf = np.array([p[5] is not None for p in self.pages], np.int8)
        parts = [np.array([self.top, self.root[0], self.root[2]]), self.ids, _vectors.narrow(self.points), leaf, self.root[1]]
        for _, vectors, parent, radii, children, rows in self.pages:
            parts += [vectors, parent, radii, children] if rows is None else [vectors[:0], parent, radii, rows]
        return _vectors.pack_all(parts)

    @classmethod
    def unpack(cls, blob: bytes) -> "MTree":
        head, ids, *rest = _vectors.unpack_all(blob)
        tree = cls.__new__(cls)
        tree.ids, tree.top, tree.computed, tree.root, tree.pages = ids[0], float(head[0, 0]), 0, None, []
        if rest:
            points, leaf, center, *pages = rest
            tree.points = points.astype(np.int64)
            tree.root = (int(head[0, 1]), center[0], float(head[0, 2]))
            for k, is_leaf in enumerate(leaf[0].tolist()):
                vectors, parent, radii, to = pages[4 * k : 4 * k + 4]
                tree.pages.append((None, vectors, parent[0], radii[0], None if is_leaf else to[0], to[0] if is_leaf else None))
        return tree

    def _load(self, rows: np.ndarray, page: int) -> tuple[int, np.ndarray, float]:
        """(page number, routing vector, covering radius) of the subtree over rows."""
        center = self._route(rows)
        if len(rows) <= page:
            d = np.linalg.norm(self.metric[rows] - center, axis=1)
            order = np.argsort(d, kind="stable")
            self.pages.append((center, self.metric[rows[order]], d[order], np.zeros(len(rows)), None, rows[order]))
            return len(self.pages) - 1, center, float(d.max())
        fan = min(page, -(-len(rows) // page))
        parts = [p for p in self._split(rows, max(2, fan), page) if len(p)]
        entries = [self._load(p, page) for p in parts]
        routes = np.stack([e[1] for e in entries])
        radii = np.array([e[2] for e in entries])
        d = np.linalg.norm(routes - center, axis=1)
        self.pages.append((center, routes, d, radii, np.array([e[0] for e in entries]), None))
        far = max(float(np.linalg.norm(self.metric[rows[i : i + 65536]] - center, axis=1).max()) for i in range(0, len(rows), 65536))
        return len(self.pages) - 1, center, far

    def _route(self, rows: np.ndarray) -> np.ndarray:
        """The row nearest to the mean routes for them."""
        m = self.metric[rows]
        return m[((m - m.mean(axis=0)) ** 2).sum(axis=1).argmin()]

    def _split(self, rows: np.ndarray, parts: int, page: int) -> list[np.ndarray]:
        """Halves, again and again, along the line between two far rows; equal rows are halved by place."""
        out, todo = [], [(rows, parts)]
        while todo:
            r, n = todo.pop()
            if n <= 1 or len(r) <= page:
                out.append(r)
                continue
            m = self.metric[r]
            a = m[((m - m[0]) ** 2).sum(axis=1).argmax()]
            b = m[((m - a) ** 2).sum(axis=1).argmax()]
            order = np.argsort(m @ (b - a), kind="stable")
            cut = len(r) * (n // 2) // n
            todo += [(r[order[:cut]], n // 2), (r[order[cut:]], n - n // 2)]
        return out

    def search(self, q: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k highest inner products, ties to smaller ids; own is left out."""
        if self.root is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        z = np.append(q.astype(np.float64), 0.0)
        base = float((z * z).sum()) + self.top
        slack = SLACK * (1 + np.sqrt(base))
        best: list[tuple[int, int]] = []  # (score, -id): the least is the k-th best
        page, center, radius = self.root
        near = float(np.linalg.norm(z - center))
        self.computed += 1
        held: dict[int, int] = {}
        queue = [(max(0.0, near - radius), page, near)]
        limit = np.inf
        while queue:
            low, page, to_center = heapq.heappop(queue)
            if low > limit:
                break
            _, vectors, parent, radii, children, rows = self.pages[page]
            # |d(q, p) - d(o, p)| <= d(q, o): what can't be within reach is not computed.
            reach = np.abs(to_center - parent) - radii <= limit
            if not reach.any():
                continue
            at = np.flatnonzero(reach)
            self.computed += len(at)
            if rows is None:
                d = np.sqrt(((vectors[at] - z) ** 2).sum(axis=1))
                for e, x in zip(at, d):
                    bound = max(0.0, x - radii[e])
                    if bound <= limit:
                        heapq.heappush(queue, (bound, int(children[e]), float(x)))
                continue
            r = rows[at]
            scores = self.points[r] @ q
            ids = self.ids[r]
            for s, i in zip(scores.tolist(), ids.tolist()):
                if i == own or len(best) == k and (s, -i) <= best[0]:
                    continue
                if i in held:  # another vector of the same id
                    if s <= held[i]:
                        continue
                    best.remove((held[i], -i))
                    heapq.heapify(best)
                elif len(best) == k:
                    held.pop(-best[0][1])
                    heapq.heappop(best)
                heapq.heappush(best, (s, -i))
                held[i] = s
            if len(best) == k:
                limit = np.sqrt(max(0.0, base - 2.0 * best[0][0])) + slack
        best.sort(reverse=True)
        return np.array([-i for _, i in best], np.int64), np.array([s for s, _ in best], np.int64)


def _scaled(lists, scale: float) -> np.ndarray:
    return np.floor(scale * _vectors.matrix(lists)).astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: float = 1024.0, tree_rows: int = 8192, query_rows: int = 512) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest integer inner products with floor(scale * x).

    Rows with an equal id are a query's own and no candidates of it.  Vectors
    that are null, empty or hold a null or non-finite component take no part,
    nor do rows with a null id; vectors meet those of their own length.  Ties go
    to the smaller id.  Rows of one id are one candidate and one query: of several
    vectors the best score counts.  Scores must fit a long.  Empty tables give no rows.
    """

    def packed(t: DataFrame, size: int) -> DataFrame:
        rows = t.where(_vectors.whole(vector) & F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"))
        rows = rows.dropDuplicates(["id", "v"])
        return _vectors.blocked(rows, ["dim"], "id", size)

    def sorted_block(t: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
        ids = t.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        return [t.column(c).slice(0, 1).combine_chunks() for c in ("dim", "block")], ids[order], _scaled(t.column("v"), scale)[order]

    def as_tree(t: pa.Table) -> pa.Table:
        key, ids, points = sorted_block(t)
        return pa.table([*key, pa.array([MTree(ids, points).pack()], pa.binary())], names=["dim", "block", "tree"])

    def as_queries(t: pa.Table) -> pa.Table:
        key, ids, points = sorted_block(t)
        return pa.table([*key, pa.array([_vectors.pack_all([ids, _vectors.narrow(points)])], pa.binary())], names=["dim", "q_block", "queries"])

    trees = stored(packed(vectors, tree_rows).groupBy("dim", "block").applyInArrow(*_arrow.groups(as_tree, "dim int, block int, tree binary")), "mtree")
    asks = stored(packed(queries, query_rows).groupBy("dim", "block").applyInArrow(*_arrow.groups(as_queries, "dim int, q_block int, queries binary")), "mtree")

    def run(batches):
        held = tree = None
        for batch in batches:
            col = dict(zip(batch.schema.names, batch.columns))
            for dim, block, kind, blob, asked in zip(col["dim"].to_pylist(), col["block"].to_pylist(), col["kind"].to_pylist(), col["tree"], col["queries"]):
                if kind == 0:
                    held, tree = (dim, block), MTree.unpack(blob.as_py())
                    continue
                if held != (dim, block):
                    continue  # no vector fell into that tree
                ids, points = _vectors.unpack_all(asked.as_py())
                found = [tree.search(q, int(own), k) for own, q in zip(ids[0], points.astype(np.int64))]
                n = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[0], n)), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"])

    hits = _vectors.meet(trees, asks, ["dim"]).mapInArrow(*_arrow.batches(run, "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), e AS (
  SELECT vec_id, t.i, v.z[t.i] AS x FROM v, unnest(range(1, len(v.z) + 1)) AS t(i)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM e q JOIN e c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""
