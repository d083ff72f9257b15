"""Fingerprints against a plain count of votes, edits against slices, and the block tables against all pairs."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from innflow.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, bucket string"
ROWS = [(3, "a b c d é", "x"), (1, "one", "x"), (2, None, None), (9, "", "y"), (7, "the cat " * 3000, "y"), (8, " \n\t ", "z"),
        (7, "the cat " * 3000, "y"), (None, "no id here", "q"), (5, "a b c d é", "x")]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_edit_and_order(spark):
    got = fp.fingerprint_and_edit(_docs(spark)).collect()
    assert len(got) == len(ROWS)
    texts = [(r[0], r[1] or "") for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))]
    want = set()
    for (i, t), (_, nxt) in zip(texts, texts[1:] + texts[:1], strict=True):
        half = len(t) // 2
        want.add((i, len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()))
    assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in got} == want
    by_text = {}
    for r in got:
        text = next(t or "" for i, t, _ in ROWS if i == r.doc_id)
        by_text.setdefault(text, set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[""] == {"0" * 32}


def test_votes_match_a_plain_count(spark):
    text = "the cat sat on the mat and the cat slept on the mat"
    words = text.split()
    pairs = spark.createDataFrame(list(zip(words, words[1:], strict=False)), "a string, b string")
    hashes = pairs.select(*fp.term_hashes(F.col("a"), F.col("b"))).collect()
    want = []
    for half in ("h0", "h1"):
        bits = np.array([[(h[half] >> k) & 1 for k in range(64)] for h in hashes])
        want.append(sum(1 << k for k in range(64) if 2 * bits[:, k].sum() > len(bits)))
    got = fp.fingerprints(spark.createDataFrame([(1, text)], "k long, t string"), ["k"], "t").first()
    assert [got.hi % (1 << 64), got.lo % (1 << 64)] == want


def test_many_buckets_keep_the_order(spark):
    rng = random.Random(4)
    rows = [(i * 3, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))), "s") for i in range(700)]
    rng.shuffle(rows)
    rows_in = fp.with_next(_docs(spark, rows), "doc_id", "text", rows_per_bucket=20).where("guard = 0").collect()
    ordered = sorted(rows)
    nxt = {a[0]: b[1] for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True)}
    assert len({r.bucket for r in rows_in}) > 10
    assert {r._id: r.next_text for r in rows_in} == nxt


def test_block_tables_find_every_pair(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(128) for _ in range(40)]
    values = set(base)
    for b in base:
        for _ in range(6):
            v = b
            for k in rng.sample(range(128), rng.randint(0, 5)):
                v ^= 1 << k
            values.add(v)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in values]
    prints = spark.createDataFrame(rows + rows[:5], "hi long, lo long")
    got = fp.within_radius(prints, 3).collect()
    flat = lambda hi, lo: ((hi % (1 << 64)) << 64) | (lo % (1 << 64))
    pairs = [frozenset((flat(r.a_hi, r.a_lo), flat(r.b_hi, r.b_lo))) for r in got]
    want = {frozenset((a, b)) for a in values for b in values if a != b and (a ^ b).bit_count() <= 3}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert fp.within_radius(prints.limit(0), 3).count() == 0


def test_neighbour_counts(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(60) for _ in range(6)]
    values = [b ^ m for b in base for m in (0, 0, 1, 6, 1 << 40, 0b1111)]
    rows = spark.createDataFrame([(i, v, 5) for i, v in enumerate(values)], "id long, hi long, lo long")
    got = {r.id: r.n_within for r in fp.with_neighbours(rows).collect()}
    assert got == {i: sum((v ^ w).bit_count() <= 3 for w in values) - 1 for i, v in enumerate(values)}


def test_empty_table(spark):
    assert fp.fingerprint_and_edit(_docs(spark, []).limit(0)).collect() == []
