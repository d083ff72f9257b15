"""The pipeline on the small supplied tables, stage by stage, against plain Python; registration; odd documents."""

from collections import Counter

import numpy as np
from test_mixing import plain_copies
from test_near_copies import brute_groups
from test_privacy import plain_spans

import __spark_entry__ as entry
import corpus_pipeline as cp
from innflow.llm import near_copies, privacy, toxicity
from innflow.llm.wordtok import WordEncoder, tokenizer_path

SF = "/root/testdata/sf0.001"


def plain_mask(text):
    spans = plain_spans(text)
    flat = sorted(((a, b, k) for k, v in spans.items() for a, b in v), key=lambda s: (s[0], -s[1]))
    out, at = "", 0
    for a, b, k in flat:
        if a >= at:
            out += text[at:a] + privacy.MASKS[k]
        at = max(at, b)
    return out + text[at:]


def _sizes_to_copies(sources, names):
    sizes = Counter(sources)
    total = sum(n ** 0.5 for n in sizes.values())
    return [plain_copies(sizes[s] ** 0.5 / total * len(sources) / sizes[s], str(i)) for s, i in zip(sources, names, strict=True)]


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = sorted(docs.collect())
    model = toxicity.fit(docs, labels)
    rows = [r for r, s in zip(rows, model.scores([r.text or "" for r in rows]), strict=True) if s < toxicity.THRESHOLD]
    kept = cp.cut_lineage(cp.drop_toxic(spark, docs, SF), "t1")
    assert kept.columns == docs.columns and sorted(kept.collect()) == rows

    prints = [near_copies.simhash64(r.text) for r in rows]
    label = brute_groups(prints)
    least = {}
    for r, f in zip(rows, prints, strict=True):
        least[label[f]] = min(least.get(label[f], r.doc_id), r.doc_id)
    rows = [r for r, f in zip(rows, prints, strict=True) if least[label[f]] == r.doc_id]
    kept = cp.cut_lineage(cp.drop_near_copies(spark, kept, SF), "t2")
    assert kept.columns == docs.columns and sorted(kept.collect()) == rows

    clean = cp.cut_lineage(cp.mask_private(spark, kept, SF), "t3")
    added = privacy.find_private(kept).where("added is not null").count()
    assert clean.columns == docs.columns and added == 0  # nothing repeats often enough in so small a table
    texts = {r.doc_id: plain_mask(r.text) for r in rows}
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {i: (t, len(t)) for i, t in texts.items()}

    mixed = cp.cut_lineage(cp.mix_sources(spark, clean, SF), "t4")
    copies = dict(zip([r.doc_id for r in rows], _sizes_to_copies([r.source for r in rows], [r.doc_id for r in rows]), strict=True))
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})

    pieces = cp.pack_windows(spark, mixed, SF).collect()
    enc = WordEncoder(tokenizer_path())
    tokens = {i: len(np.append(enc.ids(t), 2)) for i, t in texts.items()}
    whole = Counter()
    for p in pieces:
        assert p.doc_tokens == tokens[p.doc_id]
        whole[p.doc_id] += p.length
    assert whole == Counter({i: n * tokens[i] for i, n in copies.items() if n})


def test_registration():
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_copies", "privacy", "mixing", "packing"]
    queries = entry.queries()
    assert "pipeline" in queries and all(sum(q.startswith(f"op{n}_") for q in queries) == 1 for n in range(1, 14))


def test_odd_documents_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 20_000, "en", "s", 100_000),
            (None, "no id, call +44 20 7946 0958", "en", None, 5), (5, " \n", "en", "t", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        step = table
        for name, stage in cp.STAGES:
            step = cp.cut_lineage(stage(spark, step, SF), name)
        assert (step.count() > 0) == (table is docs)
