"""Groups against all pairs, for the operator, its in-task search and the component rounds."""

import random

import numpy as np
import pandas as pd
import pytest
import xxhash

from innflow.llm import near_copies as nc
from innflow.llm.components import components


def brute_groups(values):
    """label -> for each value the least value reachable over differences of at most 4 bits."""
    values = sorted(set(values))
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def _values(seed=1):
    rng = random.Random(seed)
    out = set()
    for _ in range(25):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 7)):
            out.add(v)
            for k in rng.sample(range(64), rng.randint(1, 6)):
                v ^= 1 << k
    return list(out)


def test_fingerprint_of_a_text():
    text = "The CAT\tsat on É the mat"
    words = "the cat sat on É the mat".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]), 42) for i in range(4)]
    assert nc.simhash64(text) == sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > 4)
    assert nc.simhash64("One two") == xxhash.xxh64_intdigest("one two", 42)
    assert nc.simhash64(None) == nc.simhash64(" \n") == 0
    long = "a b c d e " * 30_000
    assert nc.simhash64(long) == nc.simhash64("a b c d e " * 300)


def test_in_task_search_in_whole_and_in_parts():
    values = np.array(_values(3), dtype=np.uint64)
    want = brute_groups(int(v) for v in values)
    root = nc.linked_groups(values)
    assert {int(v): int(values[r]) for v, r in zip(values, root, strict=True)} == want
    for group_rows in (1 << 15, 3):
        a, b = nc._group_edges(values, 4, group_rows)
        label = {int(v): int(v) for v in values}
        for _ in range(64):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                label[x] = label[y] = min(label[x], label[y])
        assert label == want


def test_batches_split_a_key():
    values = np.array(_values(5), dtype=np.uint64)
    rows = pd.DataFrame({"key": np.repeat([1, 2], len(values)), "fp": np.tile(values, 2).view(np.int64)})
    whole = pd.concat(nc._edges_of_sorted(4, 1 << 15)(iter([rows])))
    parts = pd.concat(nc._edges_of_sorted(4, 1 << 15)(iter([rows.iloc[i:i + 13] for i in range(0, len(rows), 13)])))
    assert set(map(tuple, whole.to_numpy())) == set(map(tuple, parts.to_numpy()))


def test_finer_keys_tell_signatures_and_pieces_apart(spark):
    values = _values(4)[:40]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").selectExpr("fp", f"explode({nc.signatures()}) as key")
    rows = df.selectExpr("fp", "key", f"{nc.piece_keys('key', 'fp', 4)} as parts").collect()
    cuts = [0, 12, 25, 38, 51, 64]
    meaning = {}
    for r in rows:
        assert 0 <= r.key < 1 << 28 and len(r.parts) == 5
        for n, part in enumerate(r.parts):
            piece = (r.fp % (1 << 64)) >> cuts[n] & ((1 << (cuts[n + 1] - cuts[n])) - 1)
            assert part >= 1 << 28 and meaning.setdefault(part, (r.key, n, piece)) == (r.key, n, piece)
    assert len(set(meaning.values())) == len(meaning)


@pytest.mark.parametrize("group_rows", [1 << 15, 3, 1])
def test_links_give_all_components(spark, group_rows):
    values = _values(8)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(s,) for s in signed] + [(None,), (signed[0],)], "fp long")
    got = {r.node % (1 << 64): r.label % (1 << 64) for r in components(nc.fingerprint_links(prints, group_rows=group_rows)).collect()}
    want = brute_groups(values)
    classes = lambda label: {frozenset(k for k in label if label[k] == x) for x in set(label.values())}
    full = {v: got.get(v, v) for v in values}
    assert classes(full) == classes(want)
    with pytest.raises(ValueError):
        nc.fingerprint_links(prints, max_bits=6)


def test_components_of_a_long_chain(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 560)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(500, 560), 500)}
    assert components(spark.createDataFrame(edges, "a long, b long").limit(0)).count() == 0


def test_odd_rows_and_filter(spark):
    body = " ".join(f"w{i}" for i in range(400))
    rows = [(9, body, "a"), (4, body, "b"), (4, body, "b"), (6, body.upper().replace("W", "w"), None), (1, None, "c"), (2, "", "c"), (3, " \t", "c"),
            (7, "short one", "d"), (None, body, "e"), (None, "quite different words are here today", "f"), (8, "x" * 30_000, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(str((r.doc_id, r.component_id)) for r in nc.near_groups(docs).collect())
    assert got == sorted(map(str, [(9, 4), (4, 4), (4, 4), (6, 4), (1, 1), (2, 1), (3, 1), (7, 7), (None, 4), (None, None), (8, 8)]))
    kept = nc.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 4, 4, 7, 8]
    assert nc.keep_one_per_group(docs.limit(0)).count() == 0


def test_exactly_one_row_per_group(spark):
    import corpus_pipeline as cp

    body = " ".join(f"w{i}" for i in range(400))
    other = " ".join(f"v{i}" for i in range(400))
    rows = [(4, body, "b")] * 3 + [(4, body.upper(), "c"), (9, body, "a"), (None, body, "e")] + [(None, other, "n")] * 20 + [(7, None, "x"), (7, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = cp.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r.doc_id, (r.text or "").lower()) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(4, body), (None, other), (7, "")], key=str)
    assert cp.drop_near_copies(spark, docs.limit(0), "").count() == 0
