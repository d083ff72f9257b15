"""Mined pairs against brute force: ties, repeated rows, odd vectors, large numbers, several chunks, and the SQL form."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from innflow.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<double>, tag string, score string"


def plain(rows, positives=5, negatives=5, low=80, high=100):
    taken = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
             if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {(i, label, tuple(v)) for i, label, v in taken if i % 100 == 0}
    out = []
    for i, label, v in sorted(anchors):
        scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in taken if j != i]
        tops = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        for ps, p in tops:
            fit = sorted((s, j) for s, j, other in scored if other != label and low * -ps <= high * -s <= high * -ps)[:negatives]
            out += [(i, p, rank, j, -ps, -s) for rank, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)
    out = H.mined(df, F.col("id") % 100 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def made(rng, n, width=6, kinds=3):
    return [(i, rng.randrange(kinds), [rng.gauss(0.2, 1) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("chunk, rows, columns", [(16 << 20, 4096, 512), (200, 16, 2)])
def test_matches_brute_force(spark, monkeypatch, chunk, rows, columns):
    monkeypatch.setattr(H, "CHUNK_BYTES", chunk)
    rng = random.Random(3)
    data = made(rng, 700)
    copied = data[41][2]
    data += [(1000 + i, i % 2, copied) for i in range(150)]  # one very common vector, under both labels
    data += [(300, 1, data[300][2]), (5000, 2, [0.5]), (5100, 1, [0.25] * 9), (5200, 0, [])]
    data += [(7, 1, data[7][2]), (7, 1, data[7][2]), (None, 1, copied), (6000, None, copied), (6001, 1, None),
             (6002, 1, [1.0, None]), (6100, 1, [1.0, float("nan")]), (6200, 2, [float("inf"), 1.0])]
    got, want = mined(spark, data), plain(data)
    assert got == want and len(want) > 50


def test_large_numbers_are_exact(spark):
    rng = random.Random(4)
    data = [(i * 50, i % 2, [rng.uniform(-1, 1) * 2.0 ** 22 + 2.0 ** 22 for _ in range(3)]) for i in range(40)]
    assert mined(spark, data) == plain(data)


def test_other_window_and_few_rows(spark):
    rng = random.Random(5)
    data = made(rng, 210)
    assert mined(spark, data, positives=2, negatives=3, low=10, high=20) == plain(data, 2, 3, 10, 20)
    assert mined(spark, data[:1]) == [] and mined(spark, []) == [] and mined(spark, data[1:50]) == []


def test_sql_form(spark):
    from innflow.llm.queries import op12_hard_negatives
    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    out = op12_hard_negatives(spark, "/root/testdata/sf0.001")
    want = sorted(con.sql(f"select {', '.join(out.columns)} from ({H.ORACLE})").fetchall())
    assert sorted(tuple(r) for r in out.collect()) == want
