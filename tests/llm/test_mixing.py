"""Counts against a plain inversion, rates, weights, odd rows and the SQL form."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest

from innflow.llm import mixing


def plain_copies(rate, name, seed="mix"):
    steps = max(1, math.ceil(rate / 32))
    mean, total = rate / steps, 0
    for j in range(1, steps + 1):
        u = int(hashlib.md5(f"{seed}:{j}:{name}".encode()).hexdigest()[:13], 16) / (1 << 52)
        p = c = math.exp(-mean)
        k = 0
        while c <= u and k < 500:
            k += 1
            p *= mean / k
            c += p
        total += k
    return total


def _rows():
    return [(i, f"text {i}", "en", "big" if i % 3 else f"s{i % 9}", 6, "extra") for i in range(600)] + [
        (601, None, None, None, None, None), (None, "no id", "en", "big", 5, "e"), (7, "again", "en", "big", 5, "e"), (608, "", "en", "rare", 0, "e")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rate string"


@pytest.mark.parametrize("limit", [10_000, 1])
def test_counts(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", limit)
    rows = _rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.replicated(docs)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"]
    got = out.collect()
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    sizes = Counter(r[3] for r in rows)
    total = sum(n ** 0.5 for n in sizes.values())
    want = Counter()
    for r in rows:
        name = str(r[0]) if r[0] is not None else hashlib.md5(r[1].encode()).hexdigest()
        n = plain_copies(sizes[r[3]] ** 0.5 / total * len(rows) / sizes[r[3]], name)
        for c in range(n):
            want[(r[0], r[1], c)] += 1
    assert Counter((r.doc_id, r.text, r.copy) for r in got) == want
    assert mixing.mixed(docs).columns == docs.columns


def test_weights_and_high_rates(spark):
    docs = spark.createDataFrame(_rows(), SCHEMA)
    got = Counter(r.source for r in mixing.replicated(docs, weights={"rare": 0.5, "big": 0.5}).collect())
    assert set(got) == {"rare", "big"}
    rate = 0.5 * 604 / 1
    assert got["rare"] == plain_copies(rate, "608") and abs(got["rare"] - rate) < 6 * rate ** 0.5
    assert mixing.replicated(docs, weights={"absent": 1.0}).count() == 0
    assert mixing.replicated(docs.limit(0)).count() == 0


def test_poisson_shape(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'t' as text", "'one' as source")
    n = Counter(Counter(r.doc_id for r in mixing.replicated(docs, scale=2.0).select("doc_id").collect()).values())
    for k in range(1, 6):
        p = math.exp(-2) * 2 ** k / math.factorial(k)
        assert abs(n[k] / 20_000 - p) < 5 * (p / 20_000) ** 0.5


def test_sql_form(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = mixing.replicated(docs)
    got = Counter(tuple(r) for r in out.collect())
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert got == Counter(con.sql(f"select {', '.join(out.columns)} from ({mixing.ORACLE})").fetchall())


def test_clashing_names(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "s", "mine", f"key{i}") for i in range(50)], "doc_id long, text string, source string, copy string, shuffle_key string")
    out = mixing.replicated(docs, scale=3.0)
    assert out.columns == [*docs.columns, "_copy", "_shuffle_key"]
    got = out.collect()
    assert len(got) > 100 and all(r.copy == "mine" and r.shuffle_key == f"key{r.doc_id}" for r in got) and max(r._copy for r in got) > 1
    assert [r._shuffle_key for r in got] == sorted(r._shuffle_key for r in got)
    assert Counter(tuple(r) for r in mixing.mixed(docs, scale=3.0).collect()) == Counter(tuple(r)[:5] for r in got)
