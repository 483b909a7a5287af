import numpy as np
import pytest

from planweave.llm import hnsw, mtree

SCHEMA = "vec_id long, embedding array<float>, label int, score string, ids string"


def table(spark, v, labels=None, start=0):
    return spark.createDataFrame([(start + i, None if x is None else [None if c is None else float(c) for c in x], None if labels is None else labels[i], "clash", "clash") for i, x in enumerate(v)], SCHEMA)


AWKWARD = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0]]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_mtree_is_exact(spread):
    r = np.random.default_rng(1)
    points = np.floor(1024 * (r.normal(size=(12, 16)).repeat(60, axis=0) + spread * r.normal(size=(720, 16)))).astype(np.int64)
    points[100:160] = points[100]  # ties
    ids = r.permutation(720).astype(np.int64)
    order = np.argsort(ids)
    tree = mtree.MTree(ids[order], points[order])
    for q in r.integers(0, 720, 25):
        at = int(np.flatnonzero(ids == q)[0])
        s = points @ points[at]
        want = sorted(((-int(x), int(i)) for x, i in zip(s, ids) if i != q))[:10]
        got_ids, got = tree.search(points[at], int(q), 10)
        assert list(zip((-got).tolist(), got_ids.tolist())) == want


def test_mtree_passes_over_entries():
    r = np.random.default_rng(2)
    points = np.floor(1024 * (r.normal(size=(40, 8)).repeat(100, axis=0) + 0.01 * r.normal(size=(4000, 8)))).astype(np.int64)
    tree = mtree.MTree(np.arange(4000), points)
    before = tree.computed
    tree.search(points[7], 7, 10)
    assert tree.computed - before < 3000


def test_top_k(spark):
    r = np.random.default_rng(3)
    v = list(np.float32(r.normal(size=(300, 8)) * 0.3)) + AWKWARD
    d = table(spark, v)
    d = d.unionByName(d.where("vec_id < 5"))  # repeated rows
    got = mtree.top_k(d, d.where("vec_id % 10 = 0"), tree_rows=64, query_rows=7).collect()
    z = np.floor(1024 * np.array(v[:300], float)).astype(np.int64)
    want = set()
    for q in range(0, 300, 10):
        best = sorted((-int(z[q] @ z[i]), i) for i in range(300) if i != q)[:10]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = {tuple(x) for x in got}
    assert {x for x in got if x[0] < 300} == want and len(got) == len(want)
    few = table(spark, v[:4])
    assert mtree.top_k(few, few).groupBy("query_id").count().where("count <> 3").count() == 0
    empty = d.limit(0)
    assert mtree.top_k(empty, empty).count() == 0 and mtree.top_k(d, empty).count() == 0


def brute(v, labels, cosine=0.93):
    x = np.array(v, float)
    n = np.sqrt((x * x).sum(axis=1))
    s = (x @ x.T) / n[:, None] / n[None, :] >= cosine
    s &= np.array(labels)[:, None] == np.array(labels)[None, :]
    np.fill_diagonal(s, False)
    up = np.arange(len(x))
    while True:
        now = np.array([min([up[i], *up[s[i]]]) for i in range(len(x))])
        if (now == up).all():
            return s.sum(axis=1), up
        up = now


def test_near_vectors(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(30, 16))
    v = np.concatenate([base.repeat(8, axis=0) + 0.12 * r.normal(size=(240, 16)), np.repeat(base[:1], 30, axis=0), r.normal(size=(80, 16))])
    v = np.float32(v)
    labels = (np.arange(len(v)) // 3 % 2).tolist()
    d = table(spark, list(v), labels)
    links, comp = brute(v, labels)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in hnsw.near_vectors(d, shard_rows=60, query_rows=40).collect()}
    assert got == {i: (int(links[i]), int(comp[i]), bool(comp[i] == i)) for i in range(len(v))}


def test_near_vectors_of_awkward_rows(spark):
    one = [1.0] * 8
    d = table(spark, AWKWARD + [one, one, one], [1] * len(AWKWARD) + [1, 1, None])
    d = d.unionByName(d.where("vec_id >= 7")).unionByName(spark.createDataFrame([(None, one, 1, "", "")], SCHEMA))
    got = sorted(((x.vec_id, x.n_links, x.component_id, x.kept) for x in hnsw.near_vectors(d).collect()), key=str)
    assert got.count((8, 1, 7, False)) == 2 and got.count((7, 1, 7, True)) == 2 and (9, 0, 9, True) in got and (None, 0, None, True) in got
    assert all(n == 0 and c == i and k for i, n, c, k in got if i is not None and i < 7)
    assert hnsw.near_vectors(d.limit(0)).count() == 0


def test_recall_of_the_graph():
    r = np.random.default_rng(5)
    v = r.normal(size=(1500, 24))
    v[::3] = v[0] + 0.15 * r.normal(size=(500, 24))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    g = hnsw.Graph.unpack(unit, hnsw.Graph(unit).pack())
    found = there = 0
    for i in range(0, 1500, 25):
        truth = set(np.flatnonzero(unit @ unit[i] >= 0.93).tolist())
        found += len(truth & set(g.above(unit[i], 0.93, hnsw.BEAM).tolist()))
        there += len(truth)
    assert found >= 0.9 * there
    places, width, recall = hnsw.search_block(g, v, np.arange(1500), v[:60], np.arange(60), 0.93)
    assert recall == 1.0 and len(places) == 60


@pytest.mark.parametrize("pairs", [3, 150])
def test_audits_go_on_until_links_were_seen(pairs):
    """A graph whose narrow searches find nothing: no audit may pass on vectors without links."""

    class Blind:
        def above(self, unit, least, width):
            return np.flatnonzero(units @ unit >= least) if width > 2 * hnsw.BEAM else np.zeros(0, np.int64)

    r = np.random.default_rng(6)
    v = r.normal(size=(600, 64))
    first = np.setdiff1d(np.arange(300), np.linspace(0, 299, 24).astype(int))[:pairs]  # none of the first audit's
    v[300 + first] = v[first] + 0.01 * r.normal(size=(len(first), 64))
    units = v / np.linalg.norm(v, axis=1, keepdims=True)
    places, width, recall = hnsw.search_block(Blind(), v, np.arange(600), v[:300], np.arange(300), 0.93)
    assert recall == 1.0 and [p.tolist() for p in places] == [[300 + i] if i in first else [] for i in range(300)]
    assert width > 2 * hnsw.BEAM or pairs < hnsw.AUDIT_LINKS
