"""Checks in one tagged pass against counts in plain Python."""

import random

from pyspark.sql import functions as F

from innflow.operators.tagged import Condition, Listed, Reference, Unique, failing_rows, labelled


def checks():
    return [
        Unique("child", "id"), Unique("child", "id", skip_null=True), Unique("child", "word"),
        Reference("child", "up", "parent", "id"), Reference("child", "up", "parent", "id", skip_null=True),
        Reference("child", "word", "parent", "word"), Reference("child", "id", "child", "up"),
        Condition("child", F.col("n") < 0), Condition("parent", F.col("word").isNull()),
        Listed("child", "word", ("a", "b")),
    ]


def brute(child, parent):
    def dup(values, skip):
        seen = [v for v in values if v is not None or not skip]
        return sum(1 for v in set(seen) if seen.count(v) > 1)

    def orphans(keys, parents, skip):
        there = {p for p in parents if p is not None}
        return sum(1 for k in keys if k not in there and not (skip and k is None))

    ids, ups, words, ns = (list(c) for c in zip(*child, strict=True)) if child else ([], [], [], [])
    pid, pword = (list(c) for c in zip(*parent, strict=True)) if parent else ([], [])
    return [dup(ids, False), dup(ids, True), dup(words, False), orphans(ups, pid, False), orphans(ups, pid, True),
            orphans(words, pword, False), orphans(ids, ups, False), sum(1 for n in ns if n is not None and n < 0),
            sum(1 for w in pword if w is None), len({w for w in words if w is not None and w not in ("a", "b")})]


def frames(spark, child, parent):
    return {"child": spark.createDataFrame(child, "id bigint, up int, word string, n double").repartition(3),
            "parent": spark.createDataFrame(parent, "id bigint, word string")}


def test_against_plain_counts(spark):
    rng = random.Random(3)
    pick = lambda xs: rng.choice(xs)
    child = [(pick([None, *range(40)]), pick([None, *range(12)]), pick([None, "a", "b", "c", "d", ""]), pick([None, -1.0, 2.0]))
             for _ in range(60)]
    child += [(7, 99, "zz", -5.0)] * 400  # a hot key
    parent = [(i, pick([None, "a", "d", "x"])) for i in range(8)] + [(None, None), (3, "a")]
    got = {r.tag: r.failing_rows for r in failing_rows(frames(spark, child, parent), checks()).collect()}
    assert [got[i] for i in range(len(checks()))] == brute(child, parent)


def test_empty_tables_pass_every_check(spark):
    got = failing_rows(frames(spark, [], []), checks()).collect()
    assert sorted((r.tag, r.failing_rows) for r in got) == [(i, 0) for i in range(len(checks()))]


def test_one_scan_per_table_and_two_shuffles(spark, tmp_path):
    tables = frames(spark, [(1, 1, "a", 1.0)], [(1, "a")])
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    result = labelled(failing_rows(tables, checks()), [{"check": str(i)} for i in range(len(checks()))])
    plan = result._jdf.queryExecution().sparkPlan().toString()
    prepared = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert prepared.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan
