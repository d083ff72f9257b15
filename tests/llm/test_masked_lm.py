"""Gradients by differences, scores against a position-by-position statement, learning, and odd rows."""

import random

import numpy as np
import pandas as pd

from innflow.llm import masked_lm as lm
from innflow.llm import wordhash


def test_gradients():
    rng = np.random.default_rng(0)
    net = lm.Network()
    for name, shape in net.shapes:
        setattr(net, name, rng.normal(size=shape) * 0.2)
    sides, words = lm.sides_of([rng.integers(0, lm.VOCABULARY, 9), rng.integers(0, 40, 4)])
    g = net.gradients(sides, words)
    loss = lambda: -net.log_probs(sides, words).mean()
    for name, shape in net.shapes:
        flat = getattr(net, name).reshape(-1)
        for at in np.argsort(-np.abs(g[name].reshape(-1)))[:3]:
            keep, step = flat[at], 1e-5
            flat[at] = keep + step
            up = loss()
            flat[at] = keep - step
            down = loss()
            flat[at] = keep
            assert abs((up - down) / (2 * step) - g[name].reshape(-1)[at]) < 1e-4


def test_probabilities_sum_to_one_and_match_a_plain_statement():
    net = lm.Network(seed=3)
    words = np.array([5, 700, 5, 0, 2047])
    sides, own = lm.sides_of([words])
    assert own.tolist() == words.tolist()
    pad = [lm.VOCABULARY] * 3
    line = pad + words.tolist() + pad
    for i, w in enumerate(words):
        around = line[i:i + 3] + line[i + 4:i + 7]
        assert sides[i].tolist() == around
        h = np.tanh(np.concatenate([net.e[a] for a in around]) @ net.w + net.b)
        soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        p_class = soft(h @ net.wc + net.bc)
        p = np.concatenate([p_class[c] * soft(h @ net.ww[c] + net.bw[c]) for c in range(lm.CLASSES)])
        assert abs(p.sum() - 1) < 1e-4
        assert abs(np.log(p[w]) - net.log_probs(sides, own)[i]) < 1e-3
    assert (lm.Network(net.flat()).flat() == net.flat()).all()


def test_averaging_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    w = rng.normal(size=(20, 5)).astype(np.float32)
    n = rng.integers(1, 50, 20)
    parts = spark.createDataFrame(pd.DataFrame({"part": np.arange(20, dtype=np.int32), "n": n, "weights": [x.tobytes() for x in w]}),
                                  "part int, n long, weights binary")
    total, mean = lm.averaged(parts)
    assert total == n.sum()
    np.testing.assert_allclose(mean, (w * n[:, None]).sum(axis=0) / n.sum(), rtol=1e-5)


def test_learning_and_odd_rows(spark):
    rng = random.Random(1)
    sentence = ["the", "cat", "sat", "on", "the", "mat", "and", "the", "dog", "ran", "to", "a", "big", "red", "house"]
    rows = [(i, " ".join(sentence * rng.randint(200, 300)), "x") for i in range(60)]
    odd = [(100, None, "x"), (101, "", None), (102, " \n", "x"), (None, "the cat sat", "x"), (103, "the", "x"), (104, "a " * 40_000, "x")]
    shuffled = sentence * 25
    rng.shuffle(shuffled)
    docs = spark.createDataFrame(rows + odd + [(200, " ".join(sentence * 25), "x"), (201, " ".join(shuffled), "x"), (200, "again the", "y")],
                                 "doc_id long, text string, words string")
    got = lm.score_documents(docs).collect()
    assert len(got) == len(rows) + len(odd) + 3
    by = {(r.doc_id, r.n_tokens): r for r in got}
    assert all(by[(i, 0)].log_likelihood == 0 and by[(i, 0)].per_token is None for i in (100, 101, 102))
    assert by[(200, 375)].per_token > by[(201, 375)].per_token + 0.3
    assert by[(103, 1)].log_likelihood < 0 and (None, 3) in by and (200, 2) in by
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_words_outside_the_vocabulary_are_told_apart(spark):
    """Two texts that differ only in rare words differ by the logs of those words' counts."""
    common = [f"c{i}" for i in range(lm.VOCABULARY - 1)]
    rows = [(i, " ".join(common)) for i in range(8)]
    rows += [(100, "c1 seven c2"), (101, "c1 once c2"), (101, "c1 once_too c2 once_too c2"), (102, " ".join(["seven"] * 6))]
    got = {(r.doc_id, r.n_tokens): r.log_likelihood for r in lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert abs(got[(100, 3)] - got[(101, 3)] - np.log(7)) < 1e-4
    n_other = 7 + 1 + 2
    counts = spark.createDataFrame([(1, 7), (2, 1), (3, 2)], "word long, n long")
    packed = [(5, np.array([1, 3], "<u8").tobytes(), np.array([2, 4], "<u4").tobytes()), (6, b"", b""), (7, np.array([2], "<u8").tobytes(), np.array([1], "<u4").tobytes())]
    logs = {r.row: r.rare_log for r in lm.rare_logs(spark.createDataFrame(packed, "row long, rare binary, times binary"), counts, n_other).collect()}
    assert set(logs) == {5, 7}
    assert abs(logs[5] - (2 * np.log(0.7) + 4 * np.log(0.2))) < 1e-9 and abs(logs[7] - np.log(0.1)) < 1e-9


def test_every_position_is_a_target_once(monkeypatch):
    """However the documents lie in batches, the rounds together train on each position of each document exactly once."""
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in (1, 2, 0, 1, 5, 300, 1, 47, 2, 3)]
    frame = pd.DataFrame({"words": [d.astype("<u2").tobytes() for d in docs]})
    seen = []
    real = lm.Network.gradients
    monkeypatch.setattr(lm.Network, "gradients", lambda net, sides, words: seen.extend(np.column_stack([sides, words]).tolist()) or real(net, sides, words))
    n = 0
    for phase in range(lm.ROUNDS):
        cut = 3 * phase + 1
        n += lm.train(lm.Network(), iter([frame.iloc[:cut], frame.iloc[cut:]]), phase)
    sides, words = lm.sides_of(docs)
    assert n == len(words) == sum(map(len, docs))
    assert sorted(seen) == sorted(np.column_stack([sides, words]).tolist())


def _plain_gradients(net, sides, words):
    """Of the mean negative log probability, one position at a time."""
    g = {name: np.zeros(shape) for name, shape in net.shapes}
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    for around, word in zip(sides, words, strict=True):
        c, k = divmod(int(word), net.width)
        x = np.concatenate([net.e[a] for a in around])
        h = np.tanh(x @ net.w + net.b)
        d, e = soft(h @ net.wc + net.bc), soft(h @ net.ww[c] + net.bw[c])
        d[c] -= 1
        e[k] -= 1
        dz = (net.wc @ d + net.ww[c] @ e) * (1 - h * h)
        for name, part in (("wc", np.outer(h, d)), ("bc", d), ("w", np.outer(x, dz)), ("b", dz)):
            g[name] += part
        g["ww"][c] += np.outer(h, e)
        g["bw"][c] += e
        for a, part in zip(around, (net.w @ dz).reshape(-1, lm.EMBEDDING), strict=True):
            g["e"][a] += part
    return {name: value / len(words) for name, value in g.items()}


def test_rare_classes_share_one_softmax(monkeypatch):
    """However many classes a batch holds, the rare ones are one step together, with the gradients of a plain statement."""
    rng = np.random.default_rng(4)
    net = lm.Network(rng.normal(size=len(lm.Network().flat())).astype(np.float32) * 0.2)
    spread = [rng.integers(0, lm.VOCABULARY, 500), np.full(40, 3), np.arange(0, lm.VOCABULARY, 97), np.full(30, 70)]
    calls = []
    real = np.exp
    for docs in (spread, [np.full(9, 2047)], [np.full(300, 2047)], [np.arange(5)]):
        sides, words = lm.sides_of(docs)
        monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or real(*a, **k))
        got = {name: value.copy() for name, value in net.gradients(sides, words).items()}
        monkeypatch.undo()
        assert len(calls) <= 64 // 2
        calls.clear()
        for name, want in _plain_gradients(net, sides, words).items():
            np.testing.assert_allclose(got[name], want, rtol=1e-4, atol=1e-5, err_msg=name)


def test_training_steps_are_adams(monkeypatch):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(lm, "BATCH", 50)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in (90, 0, 2, 61)]
    steps = []
    real = lm.Network.gradients

    def kept(net, sides, words):
        g = real(net, sides, words)
        steps.append((net.flat().copy(), {name: value.copy() for name, value in g.items()}))
        return g

    monkeypatch.setattr(lm.Network, "gradients", kept)
    net = lm.Network()
    assert lm.train(net, iter([pd.DataFrame({"words": [d.astype("<u2").tobytes() for d in docs]})]), 0, 1) == 153
    steps.append((net.flat(), None))
    m = v = 0.0
    for k, (before, g) in enumerate(steps[:-1], 1):
        flat = np.concatenate([g[name].ravel() for name, _ in net.shapes]).astype(np.float64)
        m, v = 0.9 * m + 0.1 * flat, 0.99 * v + 0.01 * flat * flat
        want = before - lm.RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-7)
        np.testing.assert_allclose(steps[k][0], want, atol=2e-6)
    assert len(steps) == 5
    for stride, phase in ((3, 1), (5, 7)):
        every, own = lm.sides_of(docs)
        at = np.concatenate([np.arange(len(d)) for d in docs]) % stride == phase % stride
        some, of = lm.sides_of(docs, phase, stride)
        assert some.tolist() == every[at].tolist() and of.tolist() == own[at].tolist()


def test_only_words_that_are_not_listed_are_joined(spark, monkeypatch):
    """Whether the counts of a word of number 0 come with the task or by the join, the scores are the same."""
    common = [f"c{i}" for i in range(lm.VOCABULARY - 1)]
    rows = [(i, " ".join(common)) for i in range(9)] + [(100, "seven six once c2 seven"), (101, "six"), (101, None), (None, "twice \n twice"), (102, "seven " * 5 + "six " * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores, joined = [], []
    real = lm.rare_logs

    def kept(words, counts, n_other):
        joined.append(sum(len(r.rare) // 8 for r in words.collect()))
        return real(words, counts, n_other)

    monkeypatch.setattr(lm, "rare_logs", kept)
    for listed in (0, 2, 1 << 16):
        monkeypatch.setattr(lm, "LISTED", listed)
        scores.append(sorted(((r.doc_id or 0, r.n_tokens, r.log_likelihood) for r in lm.score_documents(docs).collect()), key=lambda r: r[:2]))
    assert joined == [7, 2, 0]  # seven and six are listed first
    for other in scores[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in scores[0]]
        np.testing.assert_allclose([r[2] for r in other], [r[2] for r in scores[0]], rtol=1e-5)


def test_hashes_of_texts_taken_together(monkeypatch):
    rng = random.Random(3)
    texts = ["", " ", "a", "\x1c x\x1d", "\ud800 b", "w " * 40_000, "z" * 70_000, " lead", "trail ", "x" * 5000 + " y"]
    texts += ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    rng.shuffle(texts)
    for together in (1, 50, 1 << 16):
        monkeypatch.setattr(wordhash, "_TOGETHER", together)
        groups = list(wordhash.hashes_of_texts(texts))
        assert np.concatenate([n for _, n in groups]).tolist() == [len(wordhash.word_hashes(t)) for t in texts]
        assert (np.concatenate([h for h, _ in groups]) == np.concatenate([wordhash.word_hashes(t) for t in texts])).all()
    assert list(wordhash.hashes_of_texts([])) == []


def test_equal_places_are_added_up():
    rng = np.random.default_rng(8)
    at, rows = rng.integers(0, 9, 500).astype(np.uint16), rng.normal(size=(500, lm.EMBEDDING)).astype(np.float32)
    want = np.zeros((lm.VOCABULARY + 1, lm.EMBEDDING))
    np.add.at(want, at, rows.astype(np.float64))
    got = np.zeros(want.shape, dtype=np.float32)
    lm._add_rows(got, at, rows)
    np.testing.assert_allclose(got, want, atol=1e-4)


def test_listed_words_are_bounded_and_whole_counts(spark, monkeypatch):
    counts = spark.createDataFrame([(w, n) for w, n in enumerate([9, 9, 5, 4, 4, 1, 1, 1])], "word long, n long")
    for most, want in ((0, set()), (1, {2}), (2, {2}), (3, {2, 3, 4}), (5, {2, 3, 4}), (6, {2, 3, 4, 5, 6, 7}), (99, {2, 3, 4, 5, 6, 7})):
        monkeypatch.setattr(lm, "LISTED", most)
        assert {r.word for r in lm.listed_words(counts, {0, 1})} == want
    monkeypatch.setattr(lm, "LISTED", 2)
    tied = spark.createDataFrame([(w, 1) for w in range(9)], "word long, n long")
    assert lm.listed_words(tied, {0, 1}) == [] and lm.listed_words(tied.limit(0), set()) == []
