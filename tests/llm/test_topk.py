import math

import numpy as np
from pyspark.sql import functions as F

from gaugelake.llm import queries, topk


def by_hand(rows, is_query, k=10):
    good = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in good.items():
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, query=lambda c: c % 5 == 0):
    table = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, dim int"))
    return sorted(tuple(r) for r in topk.top_k(table, query(F.col("vec_id"))).select("query_id", "rank", "vec_id", "score").collect())


def rows_of(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, d))
    vectors = (centers[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def extra(rows):
    return [(*r, "v", 1) for r in rows]


def test_against_all_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 30)
    monkeypatch.setattr(topk, "DATA_BLOCK", 150)
    rows = rows_of(1, 400, 12, 0.3)
    rows += [(400 + i, rows[3][1]) for i in range(60)]  # a common vector, more often than k
    assert run(spark, extra(rows)) == by_hand(rows, lambda q: q % 5 == 0)


def test_awkward_rows(spark):
    rows = rows_of(2, 6, 4, 1.0) + [(10, None), (15, [1.0, None, 0.0, 0.0]), (20, [float("nan"), 0.0, 0.0, 0.0]),
                                    (25, [float("inf"), 0.0, 0.0, 0.0]), (30, [0.5, 0.5]), (None, [0.1] * 4)]
    assert run(spark, extra(rows)) == by_hand(rows, lambda q: q % 5 == 0)
    assert run(spark, extra(rows + rows[:2])) == by_hand(rows, lambda q: q % 5 == 0)  # repeated rows count once
    assert run(spark, extra(rows[:1])) == []


def test_repeated_ids_as_in_the_sql(spark, tmp_path):
    rows = rows_of(6, 300, 6, 0.4)
    rows += [(i, rows[i + 7][1]) for i in (0, 0, 100, 3, 3, 50)]  # ids with several vectors
    rows += [rows[0]] * 15 + [rows[100]] * 2 + [rows[40]] * 25  # equal rows
    folder = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(folder)
    got = sorted(tuple(r) for r in queries.op9_dual_tree(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect())
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q in (0, 100, 200):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for j, v in whole if j == q for i, w in whole if i != q)
        want += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:10])]
    assert got == want


def test_nodes_cover_their_members():
    points = np.random.default_rng(3).normal(size=(500, 6))

    def walk(node):
        assert (np.linalg.norm(points[node.members] - node.center, axis=1) <= node.radius + 1e-9).all()
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
        for child in node.children:
            walk(child)
    walk(topk.tree(points, np.arange(500), 0))


def test_pruning_happens_and_is_safe(monkeypatch):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 8)) * 2000
    data = (centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 5).astype(np.int64)
    looked = []
    plain = topk.Best.add
    monkeypatch.setattr(topk.Best, "add", lambda self, rows, score, ids: (looked.append(score.size), plain(self, rows, score, ids)))
    best = topk.search(data[:100], np.arange(100), data, np.arange(4000), 10)
    score = data[:100] @ data.T
    score[np.arange(100), np.arange(100)] = -(1 << 60)
    want = np.lexsort((np.broadcast_to(np.arange(4000), score.shape), -score))[:, :10]
    assert (best.id == want).all() and sum(looked) < 0.75 * score.size
