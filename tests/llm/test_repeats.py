"""Removed passages against a brute-force statement of the rule, with whole and split groups."""

import hashlib
import random
import re

import numpy as np
import pytest

from innflow.llm import repeats
from innflow.llm.wordhash import run_hashes, window_argmin, word_hashes


def brute(rows, window):
    least, out = {}, {}
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in words:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.setdefault(i, set()).add((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def _rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5)))
    passage = [word() for _ in range(70)]
    rows = [(i, " ".join([word() for _ in range(rng.randint(0, 90))] + (passage[:rng.randint(40, 70)] if i % 2 else [])
                         + [word() for _ in range(rng.randint(0, 60))])) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(9)]
    rows += [(200, "### " * 300), (201, "###\n" * 120), (202, None), (203, ""), (204, " \t "), (None, rows[4][1]), (104, rows[4][1]),
             (205, " ".join(passage) + " x " + " ".join(passage)), (5, " ".join(passage)), (206, "z" * 9000 + " " + " ".join(passage)),
             (207, "q " + "z" * 9000 + "  " + " ".join(passage))]
    return rows


@pytest.mark.parametrize("group_rows", [500, 2])
def test_against_brute_force(spark, monkeypatch, group_rows):
    rows = _rows()
    monkeypatch.setattr(repeats.repeated_ranges, "__defaults__", (50, 8, group_rows))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, h string")
    got = {}
    found = repeats.without_repeats(docs).collect()
    for r in found:
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed, r.kept_sha256))
    assert len(found) == len(rows)
    assert got == brute(rows, 50)


@pytest.mark.parametrize("group_rows", [2, 8])
def test_equal_ids_with_different_texts(spark, monkeypatch, group_rows):
    rng = random.Random(9)
    passages = [[f"p{k}w{j}" for j in range(80)] for k in range(3)]
    rows = []
    for n in range(90):
        pick = [w for k in rng.sample(range(3), 2) for w in passages[k][rng.randint(0, 12):]]
        head = [f"h{rng.randint(0, 500)}" for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice([1, 2, 2, 3, 7, 7, 7, 11]), " ".join(head + pick)))
    rows += [rows[0]] * 3 + [(7, rows[1][1])] * 5
    monkeypatch.setattr(repeats.repeated_ranges, "__defaults__", (50, 8, group_rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {}
    found = repeats.without_repeats(docs).collect()
    for r in found:
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed, r.kept_sha256))
    assert len(found) == len(rows)
    assert got == brute(rows, 50)


def test_one_repeated_id_keeps_its_words_and_lists_stay_small(spark, monkeypatch):
    passage = " ".join(f"w{j}" for j in range(120))
    rows = [(5, f"v{n % 400} " + passage) for n in range(1200)] + [(9, passage)]
    monkeypatch.setattr(repeats.repeated_ranges, "__defaults__", (50, 8, 50))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.without_repeats(docs)
    assert found.where("doc_id = 5 and n_removed > 0").count() == 0
    assert [(r.n_words, r.n_removed) for r in found.where("doc_id = 9").collect()] == [(120, 120)]
    texts, _ = repeats.repeated_ranges(docs.selectExpr("doc_id as id", "xxhash64(text) as h", "text as t"))
    assert texts.count() == 401


def test_empty_table(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string").limit(0)
    assert repeats.without_repeats(docs).count() == 0


def test_hashes_do_not_depend_on_place(monkeypatch):
    import innflow.llm.wordhash as wh

    text = "ab cd\nef ab\x0bcd  ef " + "é" * 5000 + " ab"
    h = word_hashes(text)
    assert len(h) == 8 and h[0] == h[3] == h[7] and h[1] == h[4] and len(set(h.tolist())) == 4
    monkeypatch.setattr(wh, "_SLICE", 64)
    monkeypatch.setattr(wh, "_powers", {})
    assert word_hashes(text).tolist() == h.tolist()
    monkeypatch.setattr(wh, "_powers", {})
    long = np.concatenate([h] * 3)
    assert run_hashes(long, 8)[0] == run_hashes(long, 8)[8] != run_hashes(long, 8)[1]


def test_window_argmin():
    values = np.random.default_rng(0).integers(0, 5, 40).astype(np.uint64)
    assert window_argmin(values, 7).tolist() == [i + int(np.argmin(values[i:i + 7])) for i in range(34)]
