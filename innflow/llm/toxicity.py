"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text, compared on short windows.

Training (on a bounded sample of labelled rows, see ``Bounds``):

1. Of the sampled rows of each class two thirds build the dictionaries and one third
   calibrates, so the thresholds are set on texts the dictionaries have not seen.
2. The ordinary dictionary is trained on windows of ordinary texts.
3. The toxic dictionary is trained on the segments of toxic texts whose
   character n-grams occur in many more toxic documents than ordinary ones.
   Training on all toxic text would fill it with what every text holds.
4. A window is compressed twice, with the ordinary dictionary's content, and
   with the toxic dictionary's content before the same ordinary content. Offsets
   into the ordinary part are then the same in both, so windows without toxic
   segments compress to equal lengths and any saving comes from toxic ones.
5. A document's savings over all its windows (mean, share of windows
   saving two bytes or more, largest, total) go through a logistic curve fitted on the
   calibration third, weighted to the class shares of all labelled rows:
   the score is a calibrated probability and thresholds apply to it.

Scoring covers whole texts of all rows, in a pandas UDF holding two small dictionaries.

Defined results: null and empty texts have no saving and score as such a
document does; without labelled rows of both classes every score is the share of toxic
among the labelled rows (0 without any); a document labelled twice is
toxic if one label says so; null labels or ids are ignored; extra columns stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.llm.common import ship, text_or_empty


@dataclass(frozen=True)
class Bounds:
    """Most labelled rows per class that training reads, and most characters of each (from a hash-chosen place)."""

    toxic_rows: int = 2_000
    ordinary_rows: int = 6_000
    chars: int = 8_000


WINDOW_WORDS = 8
LEVEL = 6
ORDINARY_BYTES, TOXIC_BYTES = 8_192, 1_024
GRAM = 5
GRAM_DOCS, GRAM_RATIO = 6, 30.0
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """The fold kept from learning: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows(text: str, words: int = WINDOW_WORDS) -> list[bytes]:
    w = text.lower().split()
    return [" ".join(w[i:i + words]).encode("utf-8", "replace") for i in range(0, len(w), words)]


def _compressor(content: bytes):
    import zstandard

    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=64, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


def _dictionary(size: int, samples: list[bytes], **options) -> bytes:
    """Trained content; too few samples to train on give the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _grams(words: set[str]) -> set[str]:
    return {p[i:i + GRAM] for p in (f" {w} " for w in words) for i in range(len(p) - GRAM + 1)}


def toxic_segments(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Every occurrence of a segment covered by n-grams far more frequent (by documents) in toxic texts."""
    df_toxic: Counter = Counter()
    df_ordinary: Counter = Counter()
    for t in toxic:
        df_toxic.update(_grams(set(t.lower().split())))
    wanted = {g for g, c in df_toxic.items() if c >= min(GRAM_DOCS, 1 + len(toxic) // 8)}
    for t in ordinary:
        df_ordinary.update(_grams(set(t.lower().split())) & wanted)
    share = len(toxic) / max(1, len(ordinary))
    chosen = {g for g in wanted if df_toxic[g] > min(GRAM_RATIO, len(ordinary) / 4) * share * (df_ordinary[g] + 1)}
    out: list[bytes] = []
    spans: dict[str, bytes] = {}
    for t in toxic:
        for w in t.lower().split():
            if w not in spans:
                p = f" {w} "
                hit = [i for i in range(len(p) - GRAM + 1) if p[i:i + GRAM] in chosen]
                spans[w] = p[hit[0]:hit[-1] + GRAM].encode() if hit else b""
            if spans[w]:
                out.append(spans[w])
    return out


class Savings:
    """Features of a text: what the toxic dictionary saves over its windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(toxic + ordinary)

    def __call__(self, text: str) -> tuple[float, float, float, float]:
        a, b = self.ordinary.compress, self.toxic.compress
        saved = [len(a(w)) - len(b(w)) for w in windows(text)]
        if not saved:
            return 0.0, 0.0, 0.0, 0.0
        n = len(saved)
        total = sum(saved)
        return (total / n, sum(s >= 2 for s in saved) / n, float(min(max(saved), 8)), float(np.log1p(max(total, 0))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the last coefficient is the unpenalised intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the features' scales and the logistic coefficients: a few kilobytes."""

    ordinary: bytes
    toxic: bytes
    scale: tuple[float, ...]
    beta: tuple[float, ...]
    constant: float | None = None

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        saved = Savings(self.ordinary, self.toxic)
        x = np.array([saved(t) for t in texts]).reshape(-1, len(self.scale)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.beta[:-1]) + self.beta[-1], -30, 30)))


def fit_texts(toxic: list[str], ordinary: list[str], n_toxic: int, n_ordinary: int) -> Model:
    """Model from sampled texts; ``n_toxic`` and ``n_ordinary`` are the sizes of the classes they were drawn from."""
    base = n_toxic / max(1, n_toxic + n_ordinary)
    if len(toxic) < 3 or len(ordinary) < 3:
        return Model(b"", b"", (), (), base)
    learn = lambda xs: [t for i, t in enumerate(xs) if i % 3]
    judge = lambda xs: xs[::3]
    segments = toxic_segments(learn(toxic), learn(ordinary))
    rng = np.random.default_rng(7)
    rng.shuffle(segments)
    samples = [w for t in learn(ordinary) for w in windows(t) if len(w) >= 8]
    rng.shuffle(samples)
    content = _dictionary(ORDINARY_BYTES, samples[:60_000])
    marked = _dictionary(TOXIC_BYTES, [b"".join(segments[i:i + 6]) for i in range(0, len(segments), 6)], k=16, d=6)
    saved = Savings(content, marked)
    a, b = judge(toxic), judge(ordinary)
    x = np.array([saved(t) for t in a + b])
    y = np.array([1.0] * len(a) + [0.0] * len(b))
    scale = np.maximum(x.std(axis=0), 1e-9)
    rows = len(a) + len(b)
    weight = np.where(y == 1, base * rows / len(a), (1 - base) * rows / len(b))
    return Model(content, marked, tuple(scale), tuple(_logistic(x / scale, y, weight)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        bounds: Bounds = Bounds()) -> Model:
    """Fit on labelled rows outside the held-out fold; the driver gets a sample of bounded size."""
    own = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
    own = own.groupBy(F.col(id_col).alias("_tx_id")).agg(F.max(F.col(label)).alias("_tx_label"))
    order = F.xxhash64("_tx_id")
    picked = None
    for value, most in ((1, bounds.toxic_rows), (0, bounds.ordinary_rows)):
        part = own.where(F.col("_tx_label") == value).orderBy(order, "_tx_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    sizes = {r["_tx_label"]: r["count"] for r in own.where("_tx_label in (0, 1)").groupBy("_tx_label").count().collect()}
    body = text_or_empty(F.col(text))
    room = F.greatest(F.char_length(body) - bounds.chars, F.lit(0)) + 1
    rows = docs.select(F.col(id_col).alias("_tx_doc"), body.alias("_tx_text"), room.alias("_tx_room")).join(
        F.broadcast(picked), F.col("_tx_doc") == F.col("_tx_id")).select(
        "_tx_id", "_tx_label",
        F.substring("_tx_text", (1 + F.pmod(F.xxhash64("_tx_id"), F.col("_tx_room"))).cast("int"), F.lit(bounds.chars)).alias("t"))
    rows = rows.orderBy(F.xxhash64("_tx_id"), "_tx_id", "t").limit(bounds.toxic_rows + bounds.ordinary_rows).collect()
    texts = {v: [r["t"] for r in rows if r["_tx_label"] == v] for v in (0, 1)}
    return fit_texts(texts[1], texts[0], sizes.get(1, 0), sizes.get(0, 0))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and ``name``: the probability that the text is toxic."""
    ship(docs.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(model.scores([t or "" for t in batch]))

    return docs.withColumn(name, score(F.col(text)))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    model = fit(docs, labels, id_col, text)
    scored = with_score(docs.select(id_col, text), model, text)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold."""
    scored = with_score(docs, fit(docs, labels, id_col, text), text, "_tx_score")
    return scored.where(F.col("_tx_score") < THRESHOLD).drop("_tx_score")
