"""Graph search against brute force."""

import numpy as np

from cohortlens.llm.graph_search import Graph, search
from cohortlens.llm.queries import op7_vector_search


def _brute(rows, queries, k):
    """The k best of the rows by inner product, ties to the smaller id."""
    out = {}
    for q, v in queries:
        scored = sorted((-float(np.dot(np.array(x, float), np.array(v, float))), i) for i, x in rows if i != q and len(x) == len(v))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def _recall(got, want):
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got if r.query_id == q}) for q in want)
    return hit / sum(map(len, want.values()))


def test_recall_on_the_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = op7_vector_search(spark, folder).collect()
    want = _brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert _recall(got, want) >= 0.97
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        keys = [(-r.score, r.vec_id) for r in mine]
        assert keys == sorted(keys) and all(r.vec_id != q for r in mine)


def test_many_shards_norms_clusters_and_copies(frame):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16))
    x = [(i, (centres[i % 8] + 0.05 * rng.normal(size=16)) * rng.uniform(0.3, 3)) for i in range(1_500)]
    x += [(2_000 + i, x[7][1]) for i in range(300)]
    rows = [(i, v.tolist(), 1.0) for i, v in x]
    table = frame(rows, "vec_id long, embedding array<double>, score double")
    asked = table.where("vec_id % 20 = 0")
    got = search(table, asked, k=20, shard_rows=400).collect()
    want = _brute(x, [r for r in x if r[0] % 20 == 0], 20)
    assert _recall(got, want) >= 0.95
    by = dict(x)
    for r in got[:500]:
        assert abs(r.score - float(np.dot(by[r.query_id], by[r.vec_id]))) < 1e-9


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, None, 0), (4, [], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [0.0, 0.0], 0), (8, [None, 1.0], 0), (None, [1.0, 1.0], 0), (2, [0.5, 0.5], 0),
        (20, [0.0, 2.0], 0), (9, [1.0, 2.0, 3.0], 0), (40, [nan, nan], 0),
    ]
    table = frame(rows, "vec_id long, embedding array<float>, rank int")
    got = search(table, table.where("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 20, 0.0),
        (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.0),
    ]
    assert search(table.limit(0), table.limit(0)).collect() == []


def test_levels_are_nested_and_bounded():
    graph = Graph(np.random.default_rng(1).normal(size=(2_000, 8)).astype(np.float32))
    sizes = [len(t) for _, t in graph.levels]
    assert sizes == sorted(sizes) and sizes[-1] == 2_000 and len(sizes) > 1
    assert all((t < 2_000).all() and t.shape[1] <= 36 for _, t in graph.levels)
