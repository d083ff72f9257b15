"""Order-preserving packing of token streams into windows of at most 4096 tokens by dynamic programming.

Documents, in ascending id order, form one token stream per id range.  A
window is a contiguous stretch of it; cuts fall on document ends (free), on
sentence ends (``SENTENCE_CUT`` each) and, inside sentences longer than
``LONG_SENTENCE`` tokens, every ``LONG_SENTENCE`` tokens (``HARD_CUT`` each).  The
cuts minimise padding plus these truncation penalties over the range:

    best(j) = L - S(j) + penalty(j) + min over i with S(j) - S(i) <= L of (best(i) + S(i))

where S is the token position of a boundary.  The minimum runs over a window
that only moves forward, so a monotone queue gives each transition in
constant time.  A window of exactly a power of two tokens is not padded.

With a ``seed`` the documents come in a random order instead: that of a hash of
(seed, id, text hash, number of the copy among equal rows).  Equal rows are tokenised
once and counted, so copies of a document are spread over all sequences.

Spark's part: one pass over the texts turns each into its boundaries (token
positions with the CRC32 of the ids before them, no ids are kept), which is
written once; ranges of ids of about ``RANGE_TOKENS`` tokens are then dealt by one
shuffle of these small rows and packed independently.  A range costs at most one
partly filled window.  The CRC32 of a piece comes from those of its two ends.

Defined results: null or empty text is one piece holding the end token; rows
with equal ids are documents of their own, in the order of their content; rows
without an id come first; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import bucket_of, cut_lineage, order_buckets, ship, shuffle_partitions
from innflow.llm.wordtok import encoder, tokenizer_path

LENGTH = 4096
END_ID = 2
SENTENCE_CUT = 2.0
HARD_CUT = 64.0
LONG_SENTENCE = 256
RANGE_TOKENS = 4_000_000

_CRC_POLY = 0xEDB88320


def _gf2_multiply(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, bits reflected as in the checksum."""
    product = 0
    while a:
        if a & 0x80000000:
            product ^= b
        b = (b >> 1) ^ (_CRC_POLY if b & 1 else 0)
        a = (a << 1) & 0xFFFFFFFF
    return product


_POWERS = [0x00800000]  # x^8: one byte; each next is the square of the last


def crc_of_suffix(before: int, whole: int, n_bytes: int) -> int:
    """CRC32 of the last ``n_bytes`` of a string, from the CRC32 before them and that of the whole string."""
    shift, k = 0x80000000, 0
    while n_bytes:
        if k == len(_POWERS):
            _POWERS.append(_gf2_multiply(_POWERS[-1], _POWERS[-1]))
        if n_bytes & 1:
            shift = _gf2_multiply(shift, _POWERS[k])
        n_bytes >>= 1
        k += 1
    return whole ^ _gf2_multiply(shift, before)


def boundaries(ids: np.ndarray, enders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut places of a document's ids (the end id included): token positions, CRC32 before each, and the kind of cut.

    The last place is the document's end (kind 0); 1 is a sentence end, 2 a place inside a long sentence.
    """
    n = len(ids)
    ends = np.flatnonzero(enders.take(ids)) + 1
    ends = ends[ends < n - 1]  # right before the end id counts as the end
    places = np.full(len(ends) + 1, n, dtype=np.int64)
    places[:-1] = ends
    gaps = places.copy()
    gaps[1:] -= ends
    kinds = np.ones(len(places), dtype=np.int8)
    kinds[-1] = 0
    if gaps.max() > LONG_SENTENCE:
        extra = np.concatenate([np.arange(p - g + LONG_SENTENCE, p, LONG_SENTENCE)
                                for p, g in zip(places, gaps, strict=True) if g > LONG_SENTENCE])
        places = np.concatenate([places, extra])
        kinds = np.concatenate([kinds, np.full(len(extra), 2, dtype=np.int8)])
        order = np.argsort(places, kind="stable")
        places, kinds = places[order], kinds[order]
    raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    crcs, crc, at, crc32 = [], 0, 0, zlib.crc32
    for p in (4 * places).tolist():
        crc = crc32(raw[at:p], crc)
        crcs.append(crc)
        at = p
    return places, np.array(crcs, dtype=np.uint32), kinds


def best_cuts(positions: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Indices of the boundaries that end the windows, least padding plus penalties.

    ``positions`` ascend strictly and gaps are at most ``length``; the last boundary always ends a window.
    """
    s, p = positions.tolist(), penalties.tolist()
    n = len(s)
    came = [0] * n
    value = [0.0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # best(i) + S(i) ascending, S(i), i
    for j in range(n):
        here = s[j]
        while here - queue[0][1] > length:
            queue.popleft()
        low, _, i = queue[0]
        came[j] = i
        value[j] = total = length - here + p[j] + low
        total += here
        while queue and queue[-1][0] >= total:
            queue.pop()
        queue.append((total, here, j))
    cuts, j = [], n - 1
    while j >= 0:
        cuts.append(j)
        j = came[j]
    return cuts[::-1]


def pack(docs: list[tuple], length: int = LENGTH) -> Iterator[tuple]:
    """Pieces of the documents (positions, crcs, kinds) in order: (document, start, tokens, crc, sequence, offset)."""
    if not docs:
        return
    sizes = np.array([d[0][-1] for d in docs], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    positions = np.concatenate([d[0] + starts[i] for i, d in enumerate(docs)])
    cost = np.array([0.0, SENTENCE_CUT, HARD_CUT])
    penalties = cost[np.concatenate([d[2] for d in docs])]
    owner = np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs])
    first = np.concatenate([[0], np.cumsum([len(d[0]) for d in docs])])
    at = 0  # first boundary of the window
    begin = 0
    for sequence, cut in enumerate(best_cuts(positions, penalties, length)):
        end = int(positions[cut])
        for d in range(int(owner[at]), int(owner[cut]) + 1):
            a = max(begin, int(starts[d])) - int(starts[d])
            b = min(end, int(starts[d + 1])) - int(starts[d])
            if b <= a:
                continue
            places, crcs, _ = docs[d]
            k = int(np.searchsorted(places, b))
            whole = int(crcs[k])
            if a:
                whole = crc_of_suffix(int(crcs[int(np.searchsorted(places, a))]), whole, 4 * (b - a))
            yield d, a, b - a, whole, sequence, int(starts[d]) + a - begin
        at, begin = cut + 1, end
    assert at == first[-1]


def token_boundaries(docs: DataFrame, id_col: str, text: str, tokenizer: str) -> DataFrame:
    """Per row of ``docs`` (and its ``copies``, if it has them): id, a digest that orders rows of equal ids, tokens, and its cut places as arrays."""
    ship(docs.sparkSession)

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        enders, end = enc.sentence_enders(), np.uint32(END_ID).tobytes()
        for pdf in batches:
            rows = []
            for t in pdf["t"]:
                rows.append(boundaries(enc.ids(t or "", end), enders))
            yield pd.DataFrame({
                "id": pdf["id"], "tie": pdf["tie"], "copies": pdf["copies"], "tokens": [int(r[0][-1]) for r in rows],
                "places": [r[0] for r in rows], "crcs": [r[1].astype(np.int64) for r in rows],
                "kinds": [r[2].astype(np.int32) for r in rows]})

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("tie"),
                         F.col("_pk_copies") if "_pk_copies" in docs.columns else F.lit(1).cast("bigint"))
    narrow = narrow.toDF("id", "t", "tie", "copies")
    return narrow.mapInPandas(places, "id long, tie long, copies long, tokens long, places array<long>, crcs array<long>, kinds array<int>")


def _pack_sorted(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket and document order; a bucket may span batches."""
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            whole = pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
            last = whole["bucket"].iloc[-1]
            if whole["bucket"].iloc[0] == last:
                continue
            done = whole["bucket"] != last
            for bucket, rows in whole[done].groupby("bucket", sort=True):
                yield _pack_bucket(int(bucket), rows, length)
            held = [whole[~done]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield _pack_bucket(int(rows["bucket"].iloc[0]), rows, length)

    return run


def _pack_bucket(bucket: int, rows: pd.DataFrame, length: int) -> pd.DataFrame:
    ids, tokens = rows["id"].tolist(), rows["tokens"].tolist()
    docs = [(np.asarray(p), np.asarray(c), np.asarray(k))
            for p, c, k in zip(rows["places"], rows["crcs"], rows["kinds"], strict=True)]
    out = [(ids[d], a, n, crc, tokens[d], (bucket << 40) + seq, at) for d, a, n, crc, seq, at in pack(docs, length)]
    frame = pd.DataFrame(out, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    frame["id"] = pd.array([None if pd.isna(i) else int(i) for i in frame["id"]], dtype="Int64")
    return frame


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
                   tokenizer: str | None = None, range_tokens: int = RANGE_TOKENS, seed: str | None = None) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (sequence ids grow with document order).

    Document order is that of the ids, or, with a ``seed``, of a hash that also tells equal rows apart.
    """
    if seed is not None:
        docs = docs.groupBy(F.col(id_col), F.col(text)).agg(F.count(F.lit(1)).alias("_pk_copies"))
    measured = cut_lineage(token_boundaries(docs, id_col, text, tokenizer or tokenizer_path()), "token_boundaries")
    spark = docs.sparkSession
    if seed is None:
        measured = measured.withColumn("place", F.col("id"))
    else:
        measured = measured.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        measured = measured.withColumn("place", F.xxhash64(F.lit(seed), "id", "tie", "copy"))
    total = measured.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).first()
    per_row = max(1.0, (total["t"] or 0) / max(1, total["n"]))
    bounds = order_buckets(measured.select("place"), "place", max(1, int(range_tokens / per_row)), 1)
    dealt = measured.withColumn("bucket", bucket_of(F.col("place"), bounds).cast("bigint"))
    n = min(max(shuffle_partitions(spark), 1), len(bounds) + 1)
    dealt = dealt.repartitionByRange(max(n, 1), "bucket").sortWithinPartitions(
        "bucket", F.col("place").asc_nulls_first(), F.col("id").asc_nulls_first(), "tie")
    packed = dealt.select("bucket", "id", "tokens", "places", "crcs", "kinds").mapInPandas(
        _pack_sorted(length),
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
