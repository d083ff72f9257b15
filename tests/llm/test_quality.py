"""Base counts and both distances against plain Python, fences, guards, odd rows, and labelled texts."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from innflow.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, n_words string, kept string"
PLAIN_CLASSES = [r"[a-z]", r"[ \t-\r]", r"[A-Z]", r"[0-9]", r"""[.,;:!?'"()-]"""]


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", text or "") if w]


def base(text):
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]
    found = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, v in enumerate(zip(w, w[1:], w[2:], strict=False)) if found[v] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def failed(text):
    n, *_, repeats = base(text)
    return n < 50 or 100 * repeats > 50 * n


def classes(text):
    counts = [0] * 7
    for c in text:
        k = next((k for k, p in enumerate(PLAIN_CLASSES) if re.fullmatch(p, c)), 5 if c.isalpha() else 6)
        counts[k] += 1
    return counts


def js(p, q):
    total = 0.0
    for a, b in zip(p, q, strict=True):
        total += (a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def corpus(rng, n=260):
    vocab = {lang: [f"{lang}{''.join(rng.choice('aeioustrn') for _ in range(rng.randint(1, 6)))}" for _ in range(400)] for lang in ("en", "de")}
    rows = []
    for i in range(n):
        lang = "en" if i % 3 else "de"
        w = [vocab[lang][min(int(rng.expovariate(1 / 60)), 399)] for _ in range(rng.randint(60, 120))]
        rows.append((i, " ".join(w).capitalize() + ".", lang))
    return rows


ODD = [(900, None, "en"), (901, "", "en"), (902, " \n\t ", "en"), (903, "one", None), (904, "a b c " * 40, "en"), (905, "x\nx\n \nx\r\n y", "en"),
       (906, "\x0b lead and trail \x0c\n", "de"), (907, "é#*$%&|<> ß́ \U0001f600", "fr"), (None, "no id here", "en"), (904, "a b c " * 40, "en")]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    out = Q.quality_report(df)
    assert out.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.collect()


def test_base_counts(spark):
    rng = random.Random(2)
    rows = corpus(rng, 40) + ODD
    for i in range(60):  # few words, so windows repeat and overlap
        rows.append((2000 + i, "".join(rng.choice(["a", "b", "C,"]) + rng.choice([" ", "  ", "\n", "\t\r\n"]) for _ in range(rng.randint(1, 90))), "en"))
    rows.append((3000, "long words " * 3 + " ".join(str(k) for k in range(30_000)), "en"))
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in run(spark, rows))
    assert got == Counter((i, *base(t), failed(t)) for i, t, _ in rows)


def test_distances_and_fences(spark, monkeypatch):
    monkeypatch.setattr(Q, "COMMON_WORDS", 12)
    rng = random.Random(3)
    rows = corpus(rng)
    rows += [(500 + i, " ".join(f"|||{rng.random()}" for _ in range(70)), "en") for i in range(3)]
    rows += [(1600 + i, rows[0][1], "de") for i in range(200)]  # copies add to the reference, but count once in the fence
    rows += [(700, rows[1][1], None), (701, rows[1][1], "rare"), *ODD]
    got = {r.doc_id: r for r in run(spark, rows) if r.doc_id is not None}
    per_lang = {}
    for lang in ("en", "de", "#all"):
        own = [t or "" for _, t, x in rows if lang in (x, "#all")]
        shares = [[c / len(t) for c in classes(t)] for t in own if not failed(t) and len(t) >= 200]
        class_q = [sum(s[k] for s in shares) / len(shares) for k in range(7)]
        weight = Counter()
        for t in own:
            if len(words(t)) >= 50:
                for w in words(t):
                    weight[w] += 1 / len(words(t))
        top = sorted(weight, key=lambda w: -weight[w])[:12]
        assert weight[top[-1]] > 1.0001 * sorted(weight.values())[-13]  # no tie at the cut in this corpus
        total = sum(weight.values())
        per_lang[lang] = (class_q, top, [1 - sum(weight[w] for w in top) / total] + [weight[w] / total for w in top])
    for i, text, lang in rows:
        r = got.get(i)
        if r is None or i == 904:
            continue
        text = text or ""
        class_q, top, word_q = per_lang[lang if lang in ("en", "de") else "#all"]
        if failed(text):
            assert r.char_distance is None and r.word_distance is None and not r.kept
            continue
        n = words(text)
        counts = Counter(w if w in top else None for w in n)
        assert r.word_distance == pytest.approx(js([counts[None] / len(n)] + [counts[w] / len(n) for w in top], word_q), abs=1e-6), (i, lang, len(n))
        if len(text) >= 200:
            assert r.char_distance == pytest.approx(js([c / len(text) for c in classes(text)], class_q), abs=1e-6), (i, lang, len(n))
        assert r.kept == ((r.char_fence is None or r.char_distance is None or r.char_distance <= r.char_fence)
                          and (r.word_fence is None or r.word_distance <= r.word_fence))
    assert not any(got[500 + i].kept for i in range(3))
    assert sum(got[i].kept for i in range(260)) >= 255 and all(got[1600 + i].kept == got[0].kept for i in range(200))
    for lang in ("en", "de"):  # fences from the different distances of a length
        ids = [i for i, t, x in rows if x == lang and not failed(t) and i in got]
        for length in {int(math.log2(got[i].n_words)) for i in ids}:
            own = sorted({got[i].word_distance for i in ids if int(math.log2(got[i].n_words)) == length})
            if len(own) >= Q.MIN_GROUP:
                q1, q3 = own[math.ceil(len(own) / 4) - 1], own[math.ceil(len(own) * 3 / 4) - 1]
                fence = next(got[i].word_fence for i in ids if int(math.log2(got[i].n_words)) == length)
                assert fence == pytest.approx(q3 + 3 * max(q3 - q1, Q.LEAST_RANGE), abs=1e-9)


def test_many_languages(spark, monkeypatch):
    rng = random.Random(4)
    rows = corpus(rng)
    want = {(r.doc_id, r.word_distance, r.char_distance, r.kept) for r in run(spark, rows)}
    monkeypatch.setattr(Q, "BROADCAST_LANGUAGES", 1)
    assert {(r.doc_id, r.word_distance, r.char_distance, r.kept) for r in run(spark, rows)} == want


def test_empty_and_lone(spark):
    assert run(spark, []) == []
    lone = run(spark, corpus(random.Random(1), 1))
    assert len(lone) == 1 and lone[0].kept


def test_labelled_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = Q.quality_report(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept"))
    kept = {r.quality: r.kept for r in out.collect()}
    assert kept[1] >= 0.97 and kept[0] <= 0.3
