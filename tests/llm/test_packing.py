"""Token pieces against the tokenizer, cuts against exhaustive search, CRC arithmetic and odd tables."""

import itertools
import random
import re
import zlib

import numpy as np

from innflow.llm import packing
from innflow.llm.wordtok import WordEncoder, pre_tokens, tokenizer_path

ODD = ["Ça va? l'été c'est <|endoftext|> x y  z Ⅷ ½ ² ß İstanbul ΣΑΣ ﬁ é a\x1cb  don't 'S ÀÉÎ ñandú×÷ µ ª º", "", "   ",
       "!!!###a1b22c<|startoftext|>", "L'ÉTÉ DON'T we'll I'D 3.14 ÿ ÜBER\x0bab\x7f", "Å K é", "漢字 テスト. done!"]


def test_ids_equal_the_tokenizer():
    enc = WordEncoder(tokenizer_path(), cached_pieces=20)
    for text in ODD * 2:
        assert enc.ids(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_crc_of_suffix():
    data = random.Random(1).randbytes(5000)
    for a in (0, 1, 4, 999, 4999, 5000):
        assert packing.crc_of_suffix(zlib.crc32(data[:a]), zlib.crc32(data), 5000 - a) == zlib.crc32(data[a:])


def test_cuts_are_optimal():
    rng = random.Random(2)
    for _ in range(200):
        gaps = [rng.randint(1, 7) for _ in range(rng.randint(1, 9))]
        positions = np.cumsum(gaps)
        penalties = np.array([rng.choice([0.0, 1.0, 3.0]) for _ in gaps])

        def cost(cuts, positions=positions, penalties=penalties):
            total, start = 0.0, 0
            for c in cuts:
                if positions[c] - start > 8:
                    return float("inf")
                total += 8 - (positions[c] - start) + penalties[c]
                start = positions[c]
            return total

        last = len(gaps) - 1
        best = min(cost([*some, last]) for k in range(last + 1) for some in itertools.combinations(range(last), k))
        assert cost(packing.best_cuts(positions, penalties, 8)) == best


def _check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    pieces = packing.pack_documents(docs, **options).collect()
    enc = WordEncoder(tokenizer_path())
    want = sorted((str(i), np.append(enc.ids(t or ""), np.uint32(2)).astype("<u4").tobytes()) for i, t, _ in rows)
    by_sequence, whole = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for ps in by_sequence.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        assert sum(p.length for p in ps) <= 4096
    ordered = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    ids = [-1 if p.doc_id is None else p.doc_id for p in ordered]
    assert ids == sorted(ids)
    streams = {i: [b for j, b in want if j == str(i)] for i in {p.doc_id for p in pieces}}
    for p in ordered:
        if p.start == 0:
            whole.setdefault(p.doc_id, []).append([])
        whole[p.doc_id][-1].append(p)
    for i, groups in whole.items():
        assert len(groups) == len(streams[i])
        for ps in groups:
            assert [p.start for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
            crcs = [p.ids_crc32 for p in ps]
            assert any([zlib.crc32(b[4 * p.start:4 * (p.start + p.length)]) for p in ps] == crcs and len(b) == 4 * ps[0].doc_tokens
                       and sum(p.length for p in ps) == ps[0].doc_tokens for b in streams[i])
    return ordered


def test_odd_rows(spark):
    rows = [(5, ODD[0], "a"), (1, None, "b"), (2, "", None), (None, "no id.", "c"), (5, ODD[4], "d"), (7, ODD[4], "e"), (7, ODD[4], "e"),
            (9, "word. " * 9000, "long"), (10, "### " * 9000, "no sentence"), (11, "x" * 30_000, "one word")]
    _check(spark, rows)
    assert packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, s string").limit(0)).count() == 0


def test_ranges_and_padding(spark):
    rng = random.Random(3)
    rows = [(i, ". ".join(" ".join(rng.choice(["alpha", "beta", "of"]) for _ in range(rng.randint(3, 20)))
                          for _ in range(rng.randint(1, 60))), "s") for i in range(300)]
    pieces = _check(spark, rows, range_tokens=40_000)
    sizes = {}
    for p in pieces:
        sizes[p.sequence_id] = sizes.get(p.sequence_id, 0) + p.length
    assert len({s >> 40 for s in sizes}) > 2
    assert 1 - sum(sizes.values()) / (4096 * len(sizes)) < 0.08  # a partly filled window per range in so small a table


def test_seeded_order_spreads_copies(spark):
    rng = random.Random(5)
    once = [(i, " ".join(rng.choice(["alpha", "beta", "of"]) for _ in range(40)) + f" {i}.") for i in range(200)]
    rows = [*once, *[(1000, "a small source. " * 10)] * 40, (None, "no id"), (None, "no id"), (None, None), (7, "another text of id 7")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = lambda ps: sorted(ps, key=lambda p: (p.sequence_id, p.offset))
    pieces = order(packing.pack_documents(docs, seed="s", range_tokens=3000).collect())
    plain = packing.pack_documents(docs).collect()
    assert sum(p.length for p in pieces) == sum(p.length for p in plain)
    starts = [p.doc_id for p in pieces if p.start == 0]
    assert len(starts) == len(rows)
    assert starts != sorted(starts, key=lambda i: -1 if i is None else i)
    at = [k for k, i in enumerate(starts) if i == 1000]
    assert len(at) == 40 and at[-1] - at[0] > 150 and sum(b - a == 1 for a, b in zip(at, at[1:], strict=False)) < 20
    again = order(packing.pack_documents(docs.repartition(7), seed="s", range_tokens=3000).collect())
    assert pieces == again


def test_pipeline_packs_copies_apart(spark):
    import corpus_pipeline as cp

    rows = [(i, f"document number {i} stands alone.", "en", "big", 30) for i in range(300)] + [(5000, "of the small source.", "en", "small", 20)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces = sorted(cp.pack_windows(spark, docs, "").collect(), key=lambda p: (p.sequence_id, p.offset))
    starts = [p.doc_id for p in pieces if p.start == 0]
    at = [k for k, i in enumerate(starts) if i == 5000]
    assert len(starts) == len(rows) and len(at) == 30 and at[-1] - at[0] > 150


def test_pre_tokens_equal_the_files_pattern():
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab'stremvld0 9.!?#é÷×ß\t\n\x0böøÿ''") for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    for text in [*texts, "'tis the dogs' l'été don't've 'll 3.14 ..."]:
        assert pre_tokens(text) == pattern.findall(text)


def test_full_tables_keep_frequent_pieces(monkeypatch):
    """A full table does not forget the pre-tokens in use; ids stay the tokenizer's."""
    enc = WordEncoder(tokenizer_path(), cached_pieces=50)
    run = []
    kept = WordEncoder(tokenizer_path()).pieces.__class__.__missing__

    def missing(pieces, piece):
        if piece not in pieces.older:
            run.append(piece)
        return kept(pieces, piece)

    monkeypatch.setattr(enc.pieces.__class__, "__missing__", missing)
    rng = random.Random(8)
    for _ in range(40):
        text = "the cat sat on a mat, " + " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(20))
        assert enc.ids(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(enc.pieces) + len(enc.pieces.older) <= 2 * (50 + 27)
    assert run.count("cat") == 1 and len(run) > 500
