"""Held-out accuracy, the fold, and tables without labels or texts."""

import random
import zlib

import numpy as np

from innflow.llm import toxicity


def _corpus(n, seed):
    rng = random.Random(seed)
    syllable = ["an", "the", "or", "in", "ti", "on", "es", "re", "st", "al", "mo", "ka"]
    word = lambda: "".join(rng.choice(syllable) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = [word() for _ in range(rng.randint(20, 200))]
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "numskull", "dunderpate"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def _auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    return np.mean([(p > s[y == 0]).mean() + 0.5 * (p == s[y == 0]).mean() for p in s[y == 1]])


def test_held_out_accuracy(spark):
    rows = _corpus(1200, 1)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(5000, None, "x"), (5001, "", None), (None, "words", "x")],
                                 "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[i].score, y, got[i].predicted) for i, _, y in rows if got[i].held_out]
    assert _auc([s for s, _, _ in held], [y for _, y, _ in held]) > 0.97
    assert np.mean([p == y for _, y, p in held]) > 0.95
    assert got[5000].score == got[5001].score < 0.3
    kept = toxicity.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_held_out_labels_are_never_read(spark):
    rows = _corpus(300, 2)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = lambda i, y: 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y
    one = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    two = toxicity.fit(docs, spark.createDataFrame([(i, flip(i, y)) for i, _, y in rows], "doc_id long, toxic int"))
    assert one == two


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "x" * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([(1, 1)], "doc_id long, toxic int").limit(0)
    assert [r.score for r in toxicity.score_documents(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.score_documents(docs.limit(0), none).count() == 0
    assert toxicity.windows("") == [] and len(toxicity.windows("a " * 17)) == 3
