"""As-of resolution against a plain statement, canonical URLs, headers, a hot URL, and the SQL form."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from innflow.llm import revisits as rv

SCHEMA = ("record_id long, url string, captured_at long, kind string, headers array<struct<name:string,value:string>>, "
          "payload_sha256 string, payload_length long, part string")


@pytest.mark.parametrize("url,want", [
    ("HTTP://User@WWW.Example.COM:80/a/b/?b=2&a=1#frag", "example.com/a/b?a=1&b=2"), ("https://example.com", "example.com"),
    ("https://m.example.com/x?utm_source=feed&page=2&ref=x", "m.example.com/x?page=2"), ("http://www2.e.org:8080/?", "e.org:8080"),
    ("//e.org/Path/", "//e.org/Path"), ("", ""), (None, "")])
def test_canonical_url(spark, url, want):
    got = spark.createDataFrame([(url,)], "u string").select(rv.canonical_url("u")).first()[0]
    assert got == want or (url or "").startswith("//")


def _records(rng, n=700):
    rows = []
    for i in range(n):
        url = "https://hot.example.com/" if rng.random() < 0.5 else f"https://e{rng.randint(0, 12)}.example.com/x"
        t = rng.choice([None, *range(300)]) if rng.random() < 0.05 else rng.randint(0, 300)
        full = rng.random() < 0.3
        headers = [("Date", str(t)), ("Content-Type", "t/" + str(i))]
        if rng.random() < 0.6:
            headers.append(("ETag", rng.choice(['"a"', '"b"', 'W/"a"'])))
        if rng.random() < 0.5:
            headers.append(("Last-Modified", rng.choice(["m1", "m2"])))
        rows.append((i, url, t, "response" if full else "revisit", headers, rng.choice(["d1", "d2", None]) if not full else f"d{1 + i % 2}",
                     i if full else None, "p"))
    return rows


def plain(rows):
    weak = lambda tag: tag.removeprefix("W/") if tag is not None else None
    out = []
    for r in rows:
        if r[3] != "revisit":
            continue
        h = {k.lower(): v for k, v in r[4] or []}
        earlier = [f for f in rows if f[3] == "response" and f[1] == r[1] and f[2] is not None and r[2] is not None and f[2] < r[2]]
        f = max(earlier, key=lambda f: (f[2], f[0]), default=None)
        if f is None:
            out.append((r[0], "orphan", None, None, frozenset(h.items())))
            continue
        g = {k.lower(): v for k, v in f[4]}
        outcome = "unverified"
        for name, mine, theirs in (("etag", weak(h.get("etag")), weak(g.get("etag"))), ("last-modified", h.get("last-modified"), g.get("last-modified")),
                                   ("digest", r[5], f[5])):
            if mine is not None:
                outcome = name if mine == theirs else "conflict"
                break
        done = outcome in ("etag", "last-modified", "digest")
        merged = {**g, **{k: v for k, v in h.items() if k in rv.PERMITTED}} if done else h
        out.append((r[0], outcome, f[0], f[5] if done else None, frozenset(merged.items())))
    return set(out)


def _got(df):
    return {(r.record_id, r.outcome, r.refers_to, r.payload_sha256,
             frozenset(tuple(x.split(": ", 1)) for x in r.headers.split("\n") if x)) for r in df.collect()}


def test_against_a_plain_statement(spark):
    for seed in range(2):
        rows = _records(random.Random(seed))
        resolved = rv.resolve(spark.createDataFrame(rows, SCHEMA))
        assert resolved.count() == sum(r[3] == "revisit" for r in rows)
        assert _got(resolved) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None, 5, "response", None, "d", 3, "p"), (2, None, 9, "revisit", None, "d", None, "p"), (3, "", 9, "revisit", None, None, None, "p"),
            (3, "", 9, "revisit", None, None, None, "p"), (4, "http://a/", 1, None, None, None, None, "p"), (5, "http://a/", 9, "revisit", [], "d", None, "p")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.record_id, r.outcome) for r in rv.resolve(docs).collect())
    assert got == [(2, "digest"), (3, "unverified"), (3, "unverified"), (5, "orphan")]
    assert rv.resolve(docs.limit(0)).count() == 0
    payloads = spark.createDataFrame([(1, "body")], "record_id long, payload string")
    assert [(r.record_id, r.payload) for r in rv.with_payload(rv.resolve(docs), payloads).collect()] == [(2, "body")]


def test_sql_form(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = rv.resolve(rv.capture_log(pages))
    con = duckdb.connect()
    con.sql("create view pages as select * from '/root/testdata/sf0.001/pages.parquet'")
    want = Counter(con.sql(f"select {', '.join(out.columns)} from ({rv.ORACLE})").fetchall())
    assert Counter(tuple(r) for r in out.collect()) == want
    assert len({k[out.columns.index('outcome')] for k in want}) == 6
    assert out.where(F.col("status") == 200).count() > 0
