import random
from fractions import Fraction

import numpy as np
import pytest

from gaugelake.llm import whitening as W
from gaugelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, component int"


def table(spark, tmp_path, rows, parts=4):
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame([(i, v, 1, 7, "x", 3) for i, v in rows], SCHEMA).repartition(parts).write.parquet(path)
    return str(tmp_path)


def query(spark, folder):
    return QUERIES["op13_bit_sliced"](spark, folder).collect()


def by_hand(rows):
    """Exact integers with fractions, then numpy on the exact covariance."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    n, dim = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(dim)]
    cov = np.array([[float(Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for _, x in kept), n ** 3)) for b in range(dim)] for a in range(dim)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:8]
    deviations = [sum((n * x[d] - sums[d]) ** 2 for d in range(dim)) for _, x in kept]
    white = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(dim)] for _, x in kept]) @ vectors[:, order] / np.sqrt(values[order])
    return [i for i, _ in kept], n, deviations, white, values[order] / values.sum()


def rows_of(rng, n=150, dim=12):
    mix = np.array([[rng.gauss(0, 1) for _ in range(dim)] for _ in range(dim)])
    return [(i, (mix @ np.array([rng.gauss(0, 1) for _ in range(dim)])).tolist()) for i in range(n)]


def test_query_against_exact_arithmetic(spark, tmp_path):
    rows = rows_of(random.Random(4))
    rows += [(500, None), (501, [1.0] * 11 + [None]), (502, [1.0] * 11 + [float("nan")]), (503, [float("-inf")] * 12),
             rows[3], (7, rows[5][1]), (None, [0.25] * 12)]
    got = query(spark, table(spark, tmp_path, rows))
    ids, n, deviations, white, explained = by_hand(rows)
    assert len(got) == 8 * len(ids) and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 9))
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(i), d) for i, d in zip(ids, deviations))
    for c in range(8):
        own = sorted(((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == c + 1))
        want = sorted((str(i), d, w) for i, d, w in zip(ids, deviations, white[:, c]))
        own, want = np.array([r[2] for r in own]), np.array([r[2] for r in want])
        assert np.allclose(own, want, rtol=1e-9, atol=1e-9) or np.allclose(own, -want, rtol=1e-9, atol=1e-9)
    assert np.allclose(sorted({r.explained for r in got}, reverse=True), explained, rtol=1e-9)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and 0 < errors.pop() < 1e-9


@pytest.mark.parametrize("rows", [1, 63, 64, 65, 200])
@pytest.mark.parametrize("span", [0, 1, 1000, 1 << 21, 1 << 40])
def test_planes_give_exact_products(rows, span):
    rng = np.random.Generator(np.random.Philox(rows + span))
    values = rng.integers(0, span + 1, (rows, 5)).astype(np.uint64)
    values[:, 2] = 0
    bits = [int(v).bit_length() for v in values.max(axis=0)]
    plain = values.astype(object)
    want = [[int(sum(plain[:, i] * plain[:, j])) for j in range(i, 5)] for i in range(5)]
    assert W.cross_products(values, bits) == want


def test_far_values_stay_exact(spark, tmp_path):
    """Entries of many millions, negative ones, and a deviation beyond 64 bits."""
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1e9, 1e9), rng.uniform(-1, 1), -5.0]) for i in range(70)]
    folder = table(spark, tmp_path, rows)
    ids, n, deviations, _, _ = by_hand([(i, v[:2] + [v[2]]) for i, v in rows])
    found = {r.vec_id: int(r.deviation) for r in W.whiten(W.integers(spark.read.parquet(f"{folder}/embeddings.parquet"))).collect()}
    assert found == dict(zip(ids, deviations)) and max(deviations) >= 1 << 63
    got = query(spark, folder)  # what a long cannot hold is null there
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in zip(ids, deviations)}
    assert {r.component for r in got} == {1} or {r.component for r in got} == {1, 2}


def test_degenerate_tables(spark, tmp_path):
    assert query(spark, table(spark, tmp_path / "none", [])) == []
    assert query(spark, table(spark, tmp_path / "nulls", [(1, None), (2, [None])])) == []
    one = spark.read.parquet(f"{table(spark, tmp_path / 'one', [(1, [1.0, 2.0])])}/embeddings.parquet")
    assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in W.whiten(W.integers(one)).collect()] == [(1, 0, [], 0.0)]
    assert query(spark, table(spark, tmp_path / "same", [(i, [1.0, 2.0]) for i in range(9)])) == []
    mixed = [(0, [1.0]), (1, [2.0]), (2, [1.0, 5.0]), (3, [2.0, 3.0]), (4, [4.0, 4.5]), (5, [])]
    got = query(spark, table(spark, tmp_path / "mixed", mixed))
    assert {(r.vec_id, r.n) for r in got} == {(0, 2), (1, 2), (2, 3), (3, 3), (4, 3)}
    assert {abs(r.whitened) for r in got if r.n == 2} == {1.0}
