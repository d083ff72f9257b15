"""Recall against brute force, exact scores, probing order, and odd vectors."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from innflow.llm import neighbours as nn


def _exact(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if i != q][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_probe_sequence_is_in_order_of_cost():
    inside = np.array([0.1, 0.55, 0.8, 0.3])
    got = nn.probe_sequence(inside, 81)
    cost = lambda moves: sum(inside[j] ** 2 if s < 0 else (1 - inside[j]) ** 2 for j, s in moves)
    costs = [cost(m) for m in got]
    assert costs == sorted(costs) and got[0] == [] and len(got) == 81
    assert len({tuple(sorted(m)) for m in got}) == 81
    every = sorted(cost([(j, s) for j, s in enumerate(c) if s]) for c in itertools.product((-1, 0, 1), repeat=4))
    np.testing.assert_allclose(costs, every)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")


def test_recall_scores_and_order(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(1500) * 7
    vectors = _vectors(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)])
    out = nn.nearest(vectors, vectors.where("vec_id % 50 = 0"), bucket_rows=40).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    x = x.astype(np.float64)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        want = _exact(ids, x, q, 10)
        got = found[int(ids[q])]
        hits += len({i for i, _ in want} & {i for i, _ in got})
        assert len(got) == 10 and got == sorted(got, key=lambda g: (g[1], g[0]))
        for i, s in got:
            assert abs(s - np.sqrt(((x[q] - x[i // 7]) ** 2).sum())) < 1e-12
    assert hits / (10 * len(found)) >= 0.9


def test_equal_vectors_few_rows_and_unusable_ones(spark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=8).tolist()
    rows = [(100 * i, same, 1) for i in range(40)] + [(3 + i, rng.normal(size=8).tolist(), 1) for i in range(5)]
    rows += [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 8, 1), (9004, [float("nan")] * 8, 1), (9100, [1.0, None] * 4, 1),
             (9200, [float("inf")] * 8, 1), (9300, [1.0, 2.0], 1), (None, same, 1), (0, same, 2)]
    vectors = _vectors(spark, rows)
    out = nn.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0)).collect()
    by_query = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by_query) == {100 * i for i in range(40)}
    for q, got in by_query.items():
        assert got == [(i, 0.0) for i in [100 * j for j in range(40) if 100 * j != q][:10]]
    few = _vectors(spark, rows[40:44] + [(100, rng.normal(size=8).tolist(), 1)])
    assert {r.vec_id for r in nn.nearest(few, few.where("vec_id = 100")).collect()} == {3, 4, 5, 6}
    assert nn.nearest(few.limit(0), few.limit(0)).count() == 0
    one = few.where("vec_id = 100")
    assert nn.nearest(one, one).count() == 0
