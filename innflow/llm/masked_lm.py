"""Document scores by masked pseudo-likelihood of a bidirectional window network trained in numpy.

Words (lower-cased, cut at white space) are numbered by their frequency over all
documents; the most frequent ``VOCABULARY`` - 1 keep a number, all others share number 0.  For
every position the network sees the ``SIDE`` words before and after it, never the word itself:

    h = tanh(W [e(left) ... e(right)] + b),    p(number) = p(class | h) * p(number | class, h)

with numbers in classes of like frequency, so a position costs two small
softmaxes.  The words of number 0 are told apart by their own counts:

    p(word) = p(0 | both sides) * n_word / n_other

where n_other counts all their occurrences, so p sums to one over every word of the corpus.
A document's score is the sum over all its positions of log p(word | both sides).

The counts of the most frequent words of number 0, at most ``LISTED`` (about a megabyte), go to every task; those of
all others are joined as a table, on one row per document and word.  Such a word is none of the
``VOCABULARY`` - 1 most frequent, so at most 1 / ``VOCABULARY`` of all tokens are its own and no key of that join is hot.

Training runs over all documents, data-parallel: in each of ``ROUNDS`` rounds
every partition continues from the shared weights on its own documents (Adam
on mini-batches, every ``STRIDE``-th position of each document, another phase each round), and the
weights are averaged by number of examples.  ``STRIDE`` equals ``ROUNDS``, so every position is a target once.  Averages are taken in a tree of groups of ``FAN_IN``,
so neither a task nor the driver holds more than that many copies (about half a megabyte each).
Counts are combined per batch before their shuffle; the numbered words are written once and read by all rounds.

Defined results: null, empty or blank text has 0 tokens, sum 0 and no mean;
rows with equal ids are scored each; with no words in the table at all every sum is 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, ship, text_or_empty
from innflow.llm.wordhash import hashes_of_texts

VOCABULARY, CLASSES = 2048, 64
LISTED = 1 << 16
SIDE, EMBEDDING, HIDDEN = 3, 16, 32
ROUNDS, BATCH, RATE = 3, 512, 0.004
STRIDE = ROUNDS
FAN_IN = 32
CHUNK = 1 << 15
BLOCK = 2048  # columns scored at a time, so that they stay in the processor's cache
_PAIRS = np.arange((VOCABULARY + 1) * EMBEDDING // 2).reshape(VOCABULARY + 1, -1)  # places of the pairs of values of an embedding
FEW = 12  # rare classes of at most so many positions of a batch each are handled together


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word, n``: occurrences of each word hash over all documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes = [h for h, _ in hashes_of_texts(t.lower() for t in pdf["t"])]
            if hashes:
                words, n = np.unique(np.concatenate(hashes), return_counts=True)
                yield pd.DataFrame({"word": words.view(np.int64), "n": n})

    counted = docs.select(text_or_empty(text).alias("t")).mapInPandas(count, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def listed_words(counts: DataFrame, top: set[int]) -> list[Row]:
    """The rows of ``counts`` with the greatest counts, without ``top``: at most ``LISTED``, and all of a count or none."""
    at_most, at_least, held = len(top) + LISTED, None, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(at_most + 1).collect():
        held += r["words"]
        if held > at_most:
            break
        at_least = r["n"]
    return [] if at_least is None else [r for r in counts.where(F.col("n") >= at_least).collect() if r["word"] not in top]


def numbered(docs: DataFrame, id_col: str, text: str, top: np.ndarray, listed: np.ndarray, shares: np.ndarray) -> DataFrame:
    """``row, id, words, listed_log, rare, times``, one row per document (``top``: hashes of words 1, 2, ... by frequency).

    ``row`` is its own number of each row; ``words`` the words' numbers as little-endian 16-bit integers; ``listed_log`` the sum of
    ``shares`` over its words in ``listed`` (hashes of words of number 0); ``rare`` the different hashes (64 bits) of its other words of
    number 0 and ``times`` (32 bits) how often each occurs.
    """
    order = np.argsort(top)
    ordered, number = top[order], (order + 1).astype("<u2")
    by_hash = np.argsort(listed)
    listed, shares = listed[by_hash], shares[by_hash]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for pdf in batches:
            out, logs, rare, times = [], [], [], []
            for h, sizes in hashes_of_texts(t.lower() for t in pdf["t"]):
                at = np.minimum(np.searchsorted(ordered, h), max(len(ordered) - 1, 0))
                known = ordered[at] == h if len(ordered) else np.zeros(len(h), dtype=bool)
                numbers = np.where(known, number[at] if len(ordered) else 0, 0).astype("<u2")
                ends = np.cumsum(sizes)
                for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
                    out.append(numbers[a:b].tobytes())
                    others, n = np.unique(h[a:b][~known[a:b]], return_counts=True)
                    log = 0.0
                    if len(listed):
                        spot = np.minimum(np.searchsorted(listed, others), len(listed) - 1)
                        here = listed[spot] == others
                        log = float((n * shares[spot])[here].sum())
                        others, n = others[~here], n[~here]
                    logs.append(log)
                    rare.append(others.astype("<u8").tobytes())
                    times.append(n.astype("<u4").tobytes())
            yield pd.DataFrame({"row": np.arange(row, row + len(pdf)), "id": pd.array([None if pd.isna(i) else int(i) for i in pdf["id"]], dtype="Int64"),
                                "words": out, "listed_log": logs, "rare": rare, "times": times})
            row += len(pdf)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text).alias("t"))
    return narrow.mapInPandas(encode, "row long, id long, words binary, listed_log double, rare binary, times binary")


def rare_logs(words: DataFrame, counts: DataFrame, n_other: float) -> DataFrame:
    """``row, rare_log``: sum of log(n_word / n_other) over a document's words in ``rare`` (documents without any have no row)."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            word = np.frombuffer(b"".join(pdf["rare"]), dtype="<u8")
            yield pd.DataFrame({"row": np.repeat(pdf["row"].to_numpy(), [len(w) // 8 for w in pdf["rare"]]), "word": word.view(np.int64),
                                "times": np.frombuffer(b"".join(pdf["times"]), dtype="<u4").astype(np.int64)})

    flat = words.select("row", "rare", "times").mapInPandas(listed, "row long, word long, times long")
    share = F.log(F.col("n") / F.lit(float(n_other or 1)))
    return flat.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * share).alias("rare_log"))


class Network:
    """Weights of the window network; ``flat`` and ``Network(flat)`` convert to and from one vector."""

    width = VOCABULARY // CLASSES
    shapes = (
        ("e", (VOCABULARY + 1, EMBEDDING)), ("w", (2 * SIDE * EMBEDDING, HIDDEN)), ("b", (HIDDEN,)),
        ("wc", (HIDDEN, CLASSES)), ("bc", (CLASSES,)), ("ww", (CLASSES, HIDDEN, VOCABULARY // CLASSES)), ("bw", (CLASSES, VOCABULARY // CLASSES)),
    )

    def __init__(self, flat: np.ndarray | None = None, seed: int = 5):
        rng, at = np.random.default_rng(seed), 0
        self.slope = np.zeros(sum(int(np.prod(shape)) for _, shape in self.shapes), dtype=np.float32)
        self.slopes = self.parts(self.slope)
        for name, shape in self.shapes:
            size = int(np.prod(shape))
            if flat is not None:
                value = flat[at:at + size].reshape(shape).astype(np.float32)
            elif name.startswith("b"):
                value = np.zeros(shape, dtype=np.float32)
            else:
                value = (rng.normal(size=shape) * (0.1 if name == "e" else shape[-2] ** -0.5)).astype(np.float32)
            setattr(self, name, value)
            at += size

    @classmethod
    def parts(cls, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Views of a vector, one per weight array."""
        ends = np.cumsum([int(np.prod(shape)) for _, shape in cls.shapes])
        return {name: flat[end - int(np.prod(shape)):end].reshape(shape) for (name, shape), end in zip(cls.shapes, ends.tolist(), strict=True)}

    def view(self, flat: np.ndarray) -> None:
        """Let the weights be parts of ``flat``."""
        for name, value in self.parts(flat).items():
            setattr(self, name, value)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n, _ in self.shapes])

    def start_at_counts(self, counts: np.ndarray) -> None:
        """Biases that predict the corpus frequencies before any training (counts of words 0, 1, 2, ...)."""
        full = np.zeros(VOCABULARY)
        full[:len(counts)] = counts
        logs = np.log(full.reshape(CLASSES, self.width) + 0.5)
        self.bw = logs.astype(np.float32)
        self.bc = np.log(np.exp(logs).sum(axis=1)).astype(np.float32)

    def hidden(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs (one row per position) and hidden values (one column per position)."""
        x = self.e.take(sides, axis=0).reshape(len(sides), -1)
        h = self.w.T @ x.T
        h += self.b[:, None]
        return x, np.tanh(h, out=h)

    def log_probs(self, sides: np.ndarray, words: np.ndarray) -> np.ndarray:
        """log p(word | both sides) per position."""
        out = np.empty(len(words), dtype=self.e.dtype)
        order = np.argsort(words, kind="stable")
        cls, within = np.divmod(words[order].astype(np.intp), self.width)
        first, *others = self.e @ self.w.reshape(2 * SIDE, EMBEDDING, HIDDEN)  # what each word adds to the hidden values on each place
        first += self.b
        h = np.empty((len(words), HIDDEN), dtype=self.e.dtype)
        logs = np.empty(len(words), dtype=self.e.dtype)
        for a in range(0, len(words), BLOCK):
            part = slice(a, a + BLOCK)
            column, *columns = sides[order[part]].T
            own = first.take(column, axis=0)
            for adds, column in zip(others, columns, strict=True):
                own += adds.take(column, axis=0)
            np.tanh(own, out=h[part])
            logs[part] = _log_of(self.wc.T @ h[part].T, self.bc, cls[part])
        for c, a, b in _runs(cls):
            for at in range(a, b, BLOCK):
                part = slice(at, min(at + BLOCK, b))
                logs[part] += _log_of(self.ww[c].T @ h[part].T, self.bw[c], within[part])
        out[order] = logs
        return out

    def gradients(self, sides: np.ndarray, words: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log probability: parts of ``slope``, which the next call overwrites."""
        n, g = len(words), self.slopes
        cls, within = np.divmod(words.astype(np.intp), self.width)
        counts = np.bincount(cls, minlength=CLASSES)
        large = counts > FEW
        turn = (np.arange(CLASSES) + CLASSES * ~large).astype(np.uint8)  # large classes first
        order = np.argsort(turn.take(cls), kind="stable")  # the positions of a class are columns side by side
        sides, cls, within = sides.take(order, axis=0), cls.take(order), within.take(order)
        by_turn = np.argsort(turn)
        starts = np.empty(CLASSES, dtype=np.intp)
        starts[by_turn] = np.cumsum(counts[by_turn]) - counts[by_turn]
        x, h = self.hidden(sides)
        d = _softmax_less_one(self.wc.T @ h, self.bc, cls, n)
        np.matmul(h, d.T, out=g["wc"])
        d.sum(axis=1, out=g["bc"])
        dh = self.wc @ d
        if not large.all():
            self._small_classes(large, counts, starts, h, cls, within, dh, g)
        for c in np.flatnonzero(large).tolist():
            own = slice(starts[c], starts[c] + counts[c])
            d = _softmax_less_one(self.ww[c].T @ h[:, own], self.bw[c], within[own], n)
            np.matmul(h[:, own], d.T, out=g["ww"][c])
            d.sum(axis=1, out=g["bw"][c])
            dh[:, own] += self.ww[c] @ d
        dh *= 1 - h * h
        np.matmul(x.T, dh.T, out=g["w"])
        dh.sum(axis=1, out=g["b"])
        g["e"][...] = 0
        _add_rows(g["e"], sides.ravel(), (dh.T @ self.w.T).reshape(-1, EMBEDDING))
        return g

    def _small_classes(self, large: np.ndarray, counts: np.ndarray, starts: np.ndarray, h: np.ndarray, cls: np.ndarray, within: np.ndarray,
                       dh: np.ndarray, g: dict[str, np.ndarray]) -> None:
        """The share of the classes that are not ``large``, side by side in one array with empty places (large ones are overwritten later)."""
        some, a, n = int(large.argmin()), int(counts[large].sum()), len(cls)
        most = max(int(counts[~large].max()), 1)
        own = cls[a:] - some
        place = own * most + np.arange(a, n) - starts.take(cls[a:])
        x = np.zeros(((CLASSES - some) * most, HIDDEN), dtype=h.dtype)
        x[place] = h[:, a:].T
        x = x.reshape(-1, most, HIDDEN)
        z = (x @ self.ww[some:]).reshape(-1, self.width).take(place, axis=0)
        z += self.bw[some:].take(own, axis=0)
        d = np.zeros(((CLASSES - some) * most, self.width), dtype=h.dtype)
        d[place] = _softmax_less_one(z.T, None, within[a:], n).T
        d = d.reshape(-1, most, self.width)
        np.matmul(x.transpose(0, 2, 1), d, out=g["ww"][some:])
        d.sum(axis=1, out=g["bw"][some:])
        dh[:, a:] += (d @ self.ww[some:].transpose(0, 2, 1)).reshape(-1, HIDDEN).take(place, axis=0).T


def _softmax_less_one(z: np.ndarray, bias: np.ndarray | None, at: np.ndarray, n: int) -> np.ndarray:
    """(softmax of each column of z + bias - 1 at its place ``at``) / n, in place."""
    if bias is not None:
        z += bias[:, None]
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z *= 1 / (n * z.sum(axis=0))
    z[at, np.arange(z.shape[1])] -= 1 / n
    return z


def _log_of(z: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each column at its place ``at``."""
    z += bias[:, None]
    z -= z.max(axis=0)
    own = z[at, np.arange(z.shape[1])]
    return own - np.log(np.exp(z, out=z).sum(axis=0))


def _add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``total[at] += rows`` with equal places added up; two neighbouring values are added at a time, as one complex number."""
    np.add.at(total.reshape(-1).view(np.complex64), _PAIRS.take(at, axis=0).ravel(), rows.astype(total.dtype, copy=False).reshape(-1).view(np.complex64))


def _runs(cls: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(class, start, end) of each run of equal values."""
    starts = np.flatnonzero(np.diff(cls, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(cls)], strict=True):
        yield int(cls[a]), a, b


def sides_of(words: list[np.ndarray], phase: int = 0, stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(words of both sides per position, words) of documents one after another; outside a document stands ``VOCABULARY``.

    Of each document only the positions that are ``phase`` modulo ``stride``.
    """
    gap = np.full(SIDE, VOCABULARY, dtype=np.uint16)
    line = np.concatenate([gap, *[x for w in words for x in (w, gap)]], dtype=np.uint16, casting="unsafe")
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    first = SIDE + np.cumsum(sizes + SIDE) - (sizes + SIDE) + phase % stride
    n = np.maximum(-(-(sizes - phase % stride) // stride), 0)
    own = np.arange(n.sum()) * stride + np.repeat(first - (np.cumsum(n) - n) * stride, n)
    steps = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
    return line[own[:, None] + steps], line[own]


def _documents(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(w, dtype="<u2") for w in pdf["words"]]


def train(net: Network, batches: Iterator[pd.DataFrame], phase: int, stride: int = STRIDE) -> int:
    """Adam over the positions of all documents that are ``phase`` modulo ``stride`` within their document; the number of examples."""
    weights = net.flat().astype(np.float32)
    first, second, spare = (np.zeros_like(weights) for _ in range(3))
    net.view(weights)
    seen, step = 0, 0
    wait_s: list[np.ndarray] = []
    wait_w: list[np.ndarray] = []
    held = 0

    def learn(sides: np.ndarray, words: np.ndarray) -> None:
        """Adam, its moments kept as sums (10 and 100 times the usual means)."""
        nonlocal step
        step += 1
        net.gradients(sides, words)
        root = (1 - 0.99 ** step) ** 0.5
        rate = np.float32(RATE * root / (1 - 0.9 ** step))
        np.multiply(first, np.float32(0.9), out=first)
        np.add(first, net.slope, out=first)
        np.multiply(second, np.float32(0.99), out=second)
        np.multiply(net.slope, net.slope, out=net.slope)
        np.add(second, net.slope, out=second)
        np.sqrt(second, out=spare)
        np.add(spare, np.float32(1e-6 * root), out=spare)
        np.divide(first, spare, out=spare)
        np.multiply(spare, rate, out=spare)
        np.subtract(weights, spare, out=weights)

    for pdf in batches:
        for docs in _slices(_documents(pdf)):
            sides, words = sides_of(docs, phase, stride)
            wait_s.append(sides)
            wait_w.append(words)
            held += len(words)
            if held >= 16 * BATCH:
                seen += _drain(wait_s, wait_w, learn, seen)
                held = 0
    return seen + _drain(wait_s, wait_w, learn, seen)


def _drain(wait_s: list, wait_w: list, learn, seed: int) -> int:
    sides, words = np.concatenate(wait_s or [np.empty((0, 2 * SIDE), np.uint16)]), np.concatenate(wait_w or [np.empty(0, np.uint16)])
    wait_s.clear()
    wait_w.clear()
    order = np.random.default_rng(seed).permutation(len(words))
    for at in range(0, len(order), BATCH):
        rows = order[at:at + BATCH]
        learn(sides[rows], words[rows])
    return len(words)


def _slices(docs: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Documents in groups of about ``CHUNK`` words; a longer one is a group of its own."""
    group: list[np.ndarray] = []
    size = 0
    for d in docs:
        if group and size + len(d) > CHUNK:
            yield group
            group, size = [], 0
        group.append(d)
        size += len(d)
    if group:
        yield group


def averaged(parts: DataFrame) -> tuple[int, np.ndarray | None]:
    """Example-weighted mean of the rows (part, n, weights), in a tree of groups of ``FAN_IN``."""
    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].sum())
        total = sum(float(k) * np.frombuffer(w, dtype=np.float32).astype(np.float64) for k, w in zip(pdf["n"], pdf["weights"], strict=True))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN_IN], "n": [n], "weights": [(total / n).astype(np.float32).tobytes()]})

    schema = "part int, n long, weights binary"
    while parts.count() > FAN_IN:
        grouped = parts.withColumn("g", F.floor(F.col("part") / FAN_IN)).groupBy("g")
        parts = cut_lineage(grouped.applyInPandas(lambda pdf: mean(pdf.drop(columns="g")), schema), "weights")
    rows = parts.collect()
    n = sum(r["n"] for r in rows)
    if not n:
        return 0, None
    return n, (sum(r["n"] * np.frombuffer(r["weights"], dtype=np.float32).astype(np.float64) for r in rows) / n).astype(np.float32)


def fit(words: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, stride: int = STRIDE) -> np.ndarray:
    """Weights trained over all rows (``words``: id, words)."""
    net = Network()
    net.start_at_counts(counts)
    flat = net.flat()
    for r in range(rounds):
        def one(batches: Iterator[pd.DataFrame], start: np.ndarray = flat, phase: int = r) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            local = Network(start)
            n = train(local, batches, phase, stride)
            if n:
                yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "weights": [local.flat().tobytes()]})

        parts = cut_lineage(words.select("words").mapInPandas(one, "part int, n long, weights binary"), "weights")
        n, mean = averaged(parts)
        if not n:
            break
        flat = mean
    return flat


def with_scores(words: DataFrame, flat: np.ndarray) -> DataFrame:
    """``row, id, n_tokens, log_likelihood`` per row of (row, id, words, listed_log); words in ``rare`` are scored as number 0 only."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = Network(flat)
        for pdf in batches:
            sums = []
            for docs in _slices(_documents(pdf)):
                sides, own = sides_of(docs)
                logs = np.concatenate([np.empty(0)] + [net.log_probs(sides[a:a + CHUNK], own[a:a + CHUNK]).astype(np.float64)
                                                       for a in range(0, len(own), CHUNK)])
                ends = np.cumsum([len(d) for d in docs])
                total = np.concatenate([[0.0], np.cumsum(logs)])
                sums.append(total[ends] - total[ends - [len(d) for d in docs]])
            n = [len(w) // 2 for w in pdf["words"]]
            yield pd.DataFrame({"row": pdf["row"], "id": pd.array([None if pd.isna(i) else int(i) for i in pdf["id"]], dtype="Int64"),
                                "n_tokens": n, "log_likelihood": np.concatenate(sums) + pdf["listed_log"].to_numpy() if sums else []})

    return words.select("row", "id", "words", "listed_log").mapInPandas(score, "row long, id long, n_tokens long, log_likelihood double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, per_token`` per row: trains on all rows, then scores all rows."""
    ship(docs.sparkSession)
    counts = cut_lineage(word_counts(docs, text), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 1).collect()
    listed = listed_words(counts, {r["word"] for r in top})
    total = counts.agg(F.sum("n")).first()[0] or 0
    known, often = (np.array([r["n"] for r in rows], dtype=np.float64) for rows in (top, listed))
    hashes, others = (np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64) for rows in (top, listed))
    n_other = total - known.sum()
    words = cut_lineage(numbered(docs, id_col, text, hashes, others, np.log(often / (n_other or 1))), "numbered")
    flat = fit(words, np.concatenate([[n_other], known]))
    scored = with_scores(words, flat).join(rare_logs(words, counts, n_other), "row", "left")
    scored = scored.withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("rare_log", F.lit(0.0)))
    return scored.select(F.col("id").alias(id_col), "n_tokens", "log_likelihood",
                         F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("per_token"))
