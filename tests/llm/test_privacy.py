"""Base spans against the plain patterns, disclosure against a dictionary count, and masking."""

import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from innflow.llm import privacy

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = {}
    for kind, pattern in PLAIN.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(float(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(digits) <= 19 and privacy.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out[kind].append(m.span())
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("a@.-+ 0199 () b%_1é") for _ in range(rng.randint(0, 40)))
        assert privacy.base_spans(text) == plain_spans(text), text


def test_long_degenerate_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000, "0" * 5000 + ".0.0.0"):
        privacy.base_spans(text)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, kind string")


def plain_added(texts):
    """Method spans of every text, counted with dictionaries over all its terms."""
    found = [{k: v for k, v in plain_spans(t or "").items()} for t in texts]
    owned, terms = [], []
    for t, spans in zip(texts, found, strict=True):
        t = t or ""
        own = set()
        for kind, places in spans.items():
            for a, b in places:
                value = t[a:b].lower() if kind == "email" else re.sub("[^0-9.]" if kind == "ip" else "[^0-9]", "", t[a:b])
                part = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:-1]), "card": value[:6], "phone": value[:5]}[kind]
                own |= {(kind, value), (kind, "part", part), (kind,)}
        owned.append(own)
        flat = [x for v in spans.values() for x in v]
        terms.append([(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W_]+", t) if not any(m.start() < y and x < m.end() for x, y in flat)])
    n = len(texts)
    n_t = Counter(w for t in texts for w in {m[0].lower() for m in re.finditer(r"[^\W_]+", t or "")})
    n_c = Counter(e for own in owned for e in own)
    n_ct, kinds = Counter(), {}
    different = {}
    for t, own, words in zip(texts, owned, terms, strict=True):
        for e in own:
            for w in {w for w, _, _ in words}:
                n_ct[e, w] += 1
                different.setdefault((e, w), set()).add(t)
    for (e, w), both in n_ct.items():
        surprise = math.log2(n / n_c[e])
        if len(different[e, w]) >= privacy.SUPPORT and len(different[e, w]) * surprise >= privacy.CHANCE_BITS:
            share = math.log2(n * both / (n_c[e] * max(both, n_t[w]))) / surprise
            if share >= privacy.GENERALISE - 1e-12:
                kinds[e, w] = "remove" if share >= privacy.REMOVE - 1e-12 else "generalise"
    out = []
    for own, words in zip(owned, terms, strict=True):
        spans = [(max(asked), a, b) for w, a, b in words if (asked := [kinds[e, w] for e in own if (e, w) in kinds])]
        out.append(",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans)))
    return out


def test_all_spans_against_dictionaries(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(12)) for _ in range(700)]
    texts += [f"{rng.choice(vocab)} Quillfeather wrote to qf@mail.example.org, {rng.choice(vocab)} quillfeather {rng.choice(vocab)}" for _ in range(6)]
    texts += [f"{rng.choice(vocab)} harbour office a{i}@port.example.net {rng.choice(vocab)}" for i in range(7)] + ["harbour walls"] + [f"office {i}" for i in range(8)]
    texts += [f"rack{i % 2} switch 10.1.2.{i} {rng.choice(vocab)}" for i in range(8)] + ["switch on"]
    texts += [f"kiosk pays 4111 1111 1111 1111 {rng.choice(vocab)}"] * 50  # copies are one text: no evidence
    texts += [None, "", "call +44 20 7946 0958 now", "quillfeather alone", "1" * 5000 + ".0.0.0", "0" * 5000 + ".0.0.0 zero", "\u0130stanbul a@b.org"]
    docs = _docs(spark, [(i if i % 50 else None, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "again")]).repartition(4)
    texts = [*texts, texts[3]]
    got = Counter()
    for r in privacy.private_report(docs).collect():
        got[r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans] += 1
    want = Counter()
    added = plain_added(texts)
    for t, more in zip(texts, added, strict=True):
        spans = plain_spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for k in PLAIN for a, b in spans[k])
        want[*[len(spans[k]) for k in PLAIN], hashlib.sha256(base.encode()).hexdigest(), ",".join(x for x in (base, more) if x)] += 1
    assert got == want
    assert sum(bool(x) for x in added) >= 20 and any("generalise" in x for x in added) and any("remove" in x for x in added)
    masked = Counter(r.text for r in privacy.sanitise(docs).collect())
    assert sum(masked.values()) == len(texts) and masked["quillfeather alone"] == 1 and masked["harbour walls"] == 1
    assert not any("Quillfeather wrote" in (t or "") or "qf@" in (t or "") for t in masked)
    assert masked[texts[0]] >= 1 and privacy.sanitise(docs).columns == docs.columns
    assert privacy.sanitise(docs.limit(0)).count() == 0


def test_texts_that_pass_by_hold_no_base_span():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("a@.-+ 0199 () b") for _ in range(rng.randint(0, 40)))
        if any(privacy.base_spans(text).values()):
            assert re.search(privacy._MAYBE, text), text


def test_masked_overlaps(spark):
    cases = [("1.2.3.4 x", "ip:0:7", "[IP] x"), ("1.2.3.4 x", "phone:2:5,ip:0:7", "[IP] x"), ("1.2.3.4 x", "card:0:3,phone:2:7", "[CARD] x"),
             ("é1.2.3.4", "remove:0:1,ip:1:8", "[IP]"), ("same", None, "same"), (None, None, None), ("a b c", "generalise:2:3", "a [TERM] c")]
    df = spark.createDataFrame([(t, s, w) for t, s, w in cases], "t string, s string, want string")
    got = df.select(privacy.masked(F.col("t"), F.col("s")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
