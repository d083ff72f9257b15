"""Key bitmaps and narrow keep-first against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from innflow.operators.dedup import keep_first, keep_first_narrow
from innflow.operators.keybits import BUCKET_BYTES, bitmap_bytes, key_bitmaps, with_bit
from innflow.operators.membership import Reference, with_parent_flags

EDGES = [1, 8, 9, 32768, 32769, 0, -1, -32767, -32768, -32769, 2**31 - 1, -(2**31), 2**40]


def test_bits_match_set_membership(spark):
    rng = random.Random(5)
    parents = set(EDGES[::2]) | {rng.randrange(-100_000, 100_000) for _ in range(400)}
    asked = [*EDGES, *parents, *(rng.randrange(-100_000, 100_000) for _ in range(2000)), None]
    ids = spark.createDataFrame([(p,) for p in [*parents, *list(parents)[:20], None]], "id bigint")
    child = spark.createDataFrame([(i, a) for i, a in enumerate(asked)], "row int, ref bigint")
    got = {r.row: r.found for r in with_bit(child, F.col("ref"), key_bitmaps(ids), "found").collect()}
    assert got == {i: a in parents for i, a in enumerate(asked)}
    assert bitmap_bytes(ids) == key_bitmaps(ids).count() * BUCKET_BYTES


def test_no_keys_no_rows(spark):
    none = spark.createDataFrame([], "id bigint")
    child = spark.createDataFrame([(1,), (None,)], "ref bigint")
    assert bitmap_bytes(none) == 0
    assert [r.found for r in with_bit(child, F.col("ref"), key_bitmaps(none), "found").collect()] == [False, False]
    assert with_bit(none, F.col("id"), key_bitmaps(child), "found").count() == 0


@pytest.mark.parametrize("limit", [0, BUCKET_BYTES, 64 << 20])
def test_flags_are_those_of_the_join(spark, limit):
    rows = [(i, [None, 3, 3, 3, 70_000, 5][i % 6], f"k{i % 4}") for i in range(60)]
    child = spark.createDataFrame(rows, "_seq bigint, a bigint, b string")
    refs = [Reference("a", spark.createDataFrame([(3,), (70_000,)], "id bigint"), "a_ok", False),
            Reference("b", spark.createDataFrame([("k1",)], "id string"), "b_ok", False)]  # text keys: the join
    out = with_parent_flags(child, refs, hot_key_rows=4, bitmap_max_bytes=limit)
    assert out.columns == ["_seq", "a", "b", "a_ok", "b_ok"]
    assert sorted(map(tuple, out.collect())) == [(i, a, b, a in (3, 70_000), b == "k1") for i, a, b in rows]


@pytest.mark.parametrize("keys", [1, 7, 400, 100_000])
def test_narrow_keep_first_matches_the_aggregate(spark, keys):
    rng = random.Random(keys)
    rows = [(rng.choice([None, f"k{rng.randrange(keys)}"]) if i % 50 == 0 else f"k{rng.randrange(keys)}", i, f"v{i}", None) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, _seq bigint, v string, empty string")
    narrow = keep_first_narrow(df, "k", "_seq")
    assert narrow.columns == keep_first(df, "k", "_seq").columns
    first, copies = {}, {}
    for k, i, v, _ in rows:
        first.setdefault(k, (i, v))
        copies[k] = copies.get(k, 0) + 1
    assert {(r.k, r._seq, r.v, r._copies) for r in narrow.collect()} == {(k, *first[k], n) for k, n in copies.items()}
    assert narrow.count() == len(copies)


def test_rows_with_one_key_are_not_sorted_or_moved(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("_seq"))
    out = keep_first_narrow(df, "k", "_seq", payload=["_seq"])
    assert out.count() == 1000 and out.where("_copies <> 1").count() == 0
    assert keep_first_narrow(df.where("false"), "k", "_seq").count() == 0


@pytest.mark.parametrize("limit", [BUCKET_BYTES, 64 << 20])
def test_large_text_parents_move_and_write_no_child_row(spark, monkeypatch, limit):
    from innflow.operators import membership

    written, plain = {}, membership.stage

    def stage(df, run_dir, name):
        written[name] = plain(df, run_dir, name)
        return written[name]

    monkeypatch.setattr(membership, "stage", stage)
    parents = [f"RES-{i}" for i in range(0, 4000, 2)]
    rows = [(i, None if i % 97 == 0 else "RES-0" if i % 5 == 0 else f"RES-{i}") for i in range(6000)]
    child = spark.createDataFrame(rows, "_seq bigint, ref string")
    refs = [Reference("ref", spark.createDataFrame([(p,) for p in [*parents, parents[1], None]], "id string"), "ok", False)]
    flagged = membership.with_parent_flags(child, refs, bitmap_max_bytes=limit)
    assert {r._seq: r.ok for r in flagged.collect()} == {i: ref in set(parents) for i, ref in rows}
    assert flagged.count() == len(rows)
    assert not [name for name in written if name.startswith("flagged")]
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    chance = {r[0] for r in written["wrong"].collect()}  # in one bucket of 32,768 bits some keys must share a bit
    assert chance.isdisjoint(parents) and (chance or limit > BUCKET_BYTES)


def test_too_many_shared_bits_take_the_join(spark, monkeypatch):
    from innflow.operators import membership

    monkeypatch.setattr(membership, "BROADCAST_MAX_ROWS", 3)
    child = spark.createDataFrame([(i, f"RES-{i}") for i in range(6000)], "_seq bigint, ref string")
    refs = [Reference("ref", spark.createDataFrame([(f"RES-{i}",) for i in range(0, 4000, 2)], "id string"), "ok", False)]
    flagged = membership.with_parent_flags(child, refs, bitmap_max_bytes=BUCKET_BYTES)
    assert {r._seq: r.ok for r in flagged.collect()} == {i: i < 4000 and i % 2 == 0 for i in range(6000)}
