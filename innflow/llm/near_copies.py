"""SimHash near-duplicate groups by deletion-variant signatures.

Fingerprints are 64 bits and link at no more than ``max_bits`` = 4 differing
bits.  They are cut into 3 segments (22, 21, 21 bits): of two linked
fingerprints one segment differs in at most one bit, because three segments
with two or more differing bits each would make six.  Each segment is indexed
once per bit position with that position left out (a wildcard), 64 signatures in
all; segments that differ in at most one bit share such a signature.  Rows
meet by equality of signatures and every candidate pair is verified on its
full fingerprints.

A signature's group is searched for its linked sub-groups, not for its
pairs: from an unvisited fingerprint all unvisited ones within reach are taken
(one vectorised comparison), then those within reach of these, and so on.  A
group of thousands of near copies costs a few comparisons with the
remainder and gives one edge per fingerprint to the least of its sub-group,
where all pairs would grow with the square.  Equal fingerprints are one row
before the index is built.  Signatures are counted first (map-side combined); a
signature of more than ``GROUP_ROWS`` fingerprints is dealt in finer parts: the 64 bits are cut into 5 pieces, one of which two
linked fingerprints share exactly, and each signature and piece is a key of its own, so its parts go to different tasks.  That loses no
link, because components are merged afterwards.  Which signatures are that large is broadcast as bitmaps over their 28 bits: 32 MB at
most, whatever the number of fingerprints.

Defined results: null or wordless text has fingerprint zero and links like
any other; texts of one to three words have one shingle; null ``doc_id``s
take part and a component of null ids only has a null id; repeated rows are kept by ``near_groups``;
extra columns stay in ``keep_one_per_group`` and ``keep_one_row_per_group`` (columns named ``_nd_*`` are reserved).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.llm.common import cut_lineage, ship, shuffle_partitions
from innflow.llm.components import components
from innflow.operators.keybits import key_bitmaps, with_bit

SHINGLE_WORDS = 4
BROADCAST_ROWS = 2_000_000  # row numbers, 8 bytes each
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SEGMENT_BITS = 22  # the widest segment; a signature is the number of its wildcard and that many bits
GROUP_ROWS = 1 << 15
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SLICE = 1 << 16


def simhash64(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit k is 1 if set in over half of the shingles' XXH64 (seed 42); no words: 0."""
    import xxhash

    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    last = max(1, len(words) - shingle_words + 1)
    votes, seed = np.zeros(64, dtype=np.int64), 42
    digest = xxhash.xxh64_intdigest
    for at in range(0, last, _SLICE):  # a very long text is voted in slices
        hashes = np.array([digest(" ".join(words[i:i + shingle_words]), seed) for i in range(at, min(last, at + _SLICE))],
                          dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > last, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS, name: str = "_nd_fp",
                     keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) and ``name``: the fingerprint as a signed long."""
    ship(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def signed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([simhash64(t, shingle_words) for t in batch], dtype=np.uint64).view(np.int64))

    return docs.select(*[F.col(f"`{c}`") for c in (keep or docs.columns)], signed(F.col(text)).alias(name))


def signatures(fp: str = "fp") -> str:
    """SQL array of the 64 signatures: the wildcard position, and the other bits of its segment."""
    out = []
    for offset, width in SEGMENTS:
        for i in range(width):
            mask = ((1 << width) - 1) & ~(1 << i)
            out.append(f"{(offset + i) << SEGMENT_BITS}L | (shiftrightunsigned({fp}, {offset}) & {mask}L)")
    return f"array({', '.join(out)})"


def piece_keys(key: str, fp: str, max_bits: int) -> str:
    """SQL array of the finer keys of a signature: its own bits, the number of an exact piece, and the piece."""
    cuts = [64 * p // (max_bits + 1) for p in range(max_bits + 2)]
    pieces = [f"shiftleft((shiftrightunsigned({fp}, {a}) & {(1 << (b - a)) - 1}L) * {max_bits + 1} + {n + 1}, {SEGMENT_BITS + 6}) | {key}"
              for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    return f"array({', '.join(pieces)})"


def linked_groups(fps: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each of the unsigned fingerprints, the index of the least fingerprint linked to it through others of the array."""
    order = np.argsort(fps, kind="stable")
    value = fps[order]
    label = np.empty(len(value), dtype=np.int64)
    todo = np.arange(len(value))
    while len(todo):
        root, frontier, todo = todo[0], [todo[0]], todo[1:]
        label[root] = root
        while frontier and len(todo):
            near = np.bitwise_count(value[todo] ^ value[frontier.pop()]) <= max_bits
            if near.any():
                met, todo = todo[near], todo[~near]
                label[met] = root
                frontier.extend(met.tolist())
    out = np.empty(len(value), dtype=np.int64)
    out[order] = order[label]
    return out


def _group_edges(fps: np.ndarray, max_bits: int, group_rows: int) -> tuple[np.ndarray, np.ndarray]:
    if len(fps) <= group_rows:
        root = linked_groups(fps, max_bits)
        own = root != np.arange(len(fps))
        return fps[own], fps[root[own]]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    cuts = [64 * p // (max_bits + 1) for p in range(max_bits + 2)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        piece = (fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
        order = np.argsort(piece, kind="stable")
        ends = np.flatnonzero(np.diff(piece[order])) + 1
        for part in np.split(order, ends):
            if len(part) > 1:
                found.append(_group_edges(fps[part], max_bits, len(part)))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _edges_of_sorted(max_bits: int, group_rows: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key; a key's rows may span batches, so the last key of each batch is carried on."""
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for pdf in batches:
            keys = np.concatenate([keys, pdf["key"].to_numpy()])
            fps = np.concatenate([fps, pdf["fp"].to_numpy().view(np.uint64)])
            done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from _search_runs(keys[:done], fps[:done], max_bits, group_rows)
            keys, fps = keys[done:], fps[done:]
        yield from _search_runs(keys, fps, max_bits, group_rows)

    return search


def _search_runs(keys: np.ndarray, fps: np.ndarray, max_bits: int, group_rows: int) -> Iterator[pd.DataFrame]:
    if len(keys) < 2:
        return
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    size = np.diff(starts)
    big, low, high = [], [], []
    # short runs, all at once: compare each row with the one d places on
    short = np.repeat((size > 1) & (size <= 16), size)
    at = np.flatnonzero(short)
    left = np.repeat(starts[1:], size)[at] - at - 1  # rows of the run that follow
    d = 1
    while len(at):
        at, left = at[left >= d], left[left >= d]
        near = np.bitwise_count(fps[at] ^ fps[at + d]) <= max_bits
        low.append(fps[at[near]])
        high.append(fps[at[near] + d])
        d += 1
    for r in np.flatnonzero(size > 16):
        big.append(_group_edges(fps[starts[r]:starts[r + 1]], max_bits, group_rows))
    a = np.concatenate([*low, *[x for x, _ in big]]) if low or big else np.empty(0, np.uint64)
    b = np.concatenate([*high, *[y for _, y in big]]) if low or big else np.empty(0, np.uint64)
    if len(a):
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        yield pd.DataFrame({"a": pairs[:, 0].view(np.int64), "b": pairs[:, 1].view(np.int64)})


def fingerprint_links(prints: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges ``a, b`` between different fingerprints whose components are those of all links within ``max_bits``.

    Not every link is an edge: a linked sub-group of one signature gives one edge per fingerprint.
    """
    if not max_bits < 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find at most {2 * len(SEGMENTS) - 1} differing bits")
    ship(prints.sparkSession)
    n = max(shuffle_partitions(prints.sparkSession), 4)
    one = cut_lineage(prints.select(F.col(fp).alias("fp")).where("fp is not null").distinct().repartition(n, "fp"), "fingerprints")
    listed = one.select("fp", F.explode(F.expr(signatures())).alias("key"))
    large = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_rows).select("key")
    marked = with_bit(listed, F.col("key"), key_bitmaps(cut_lineage(large, "large")), "large")
    keys = F.when(F.col("large"), F.expr(piece_keys("key", "fp", max_bits))).otherwise(F.array("key"))
    dealt = marked.select("fp", F.explode(keys).alias("key")).repartition(4 * n, "key").sortWithinPartitions("key")
    return dealt.mapInPandas(_edges_of_sorted(max_bits, group_rows), "a long, b long").distinct()


def _grouped(docs: DataFrame, id_col: str, text: str, shingle_words: int, max_bits: int) -> DataFrame:
    """``_nd_id, _nd_hash, _nd_fp, component_id`` per row of ``docs``."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("_nd_id"), F.xxhash64(f"`{text}`").alias("_nd_hash"),
                        F.col(f"`{text}`").alias("_nd_text"))
    prints = cut_lineage(with_fingerprint(keyed, "_nd_text", shingle_words, keep=["_nd_id", "_nd_hash"]), "prints")
    labels = components(fingerprint_links(prints, "_nd_fp", max_bits))
    distinct = prints.groupBy("_nd_fp").agg(F.min("_nd_id").alias("_nd_low"))
    # both sides of the next join are written, so that Spark can split a component of very many fingerprints
    joined = cut_lineage(distinct.join(labels, distinct["_nd_fp"] == labels["node"], "left").select(
        "_nd_fp", "_nd_low", F.coalesce("label", "_nd_fp").alias("_nd_label")), "labelled")
    least = cut_lineage(joined.groupBy(F.col("_nd_label").alias("_nd_least")).agg(F.min("_nd_low").alias("component_id")), "least")
    member = joined.join(least, joined["_nd_label"] == least["_nd_least"]).select(
        F.col("_nd_fp").alias("_nd_of"), "component_id")
    return prints.join(member, prints["_nd_fp"] == member["_nd_of"]).drop("_nd_of")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row: component_id is the smallest id reachable over links, itself included."""
    return _grouped(docs, id_col, text, shingle_words, max_bits).select(
        F.col("_nd_id").alias(id_col), F.lower(F.lpad(F.hex("_nd_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their component, with all their columns.

    A row without an id stays only where its whole component has none; rows with
    equal id and text are one document and stay together (``keep_one_row_per_group`` keeps one of them).
    """
    groups = _grouped(docs, id_col, text, shingle_words, max_bits)
    gone = groups.where(~F.col("_nd_id").eqNullSafe(F.col("component_id"))).select(
        F.col("_nd_id").alias("_nd_gone"), F.col("_nd_hash").alias("_nd_gone_hash"))
    keyed = docs.withColumn("_nd_hash", F.xxhash64(f"`{text}`"))
    return keyed.join(gone, keyed[id_col].eqNullSafe(gone["_nd_gone"]) & (keyed["_nd_hash"] == gone["_nd_gone_hash"]),
                      "left_anti").drop("_nd_hash")


def keep_one_row_per_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                           max_bits: int = MAX_BITS) -> DataFrame:
    """Exactly one row of each component, with all its columns.

    It is the least by id (rows without an id last), then text hash; of rows repeated with the same id and text any one.
    The rows are written first, so that a row's own number tells repeated rows apart.
    """
    rows = cut_lineage(docs.withColumn("_nd_row", F.monotonically_increasing_id()), "rows")
    keyed = rows.select(F.col(f"`{id_col}`").alias("_nd_id"), F.xxhash64(f"`{text}`").alias("_nd_hash"), "_nd_row",
                        F.col(f"`{text}`").alias("_nd_text"))
    prints = cut_lineage(with_fingerprint(keyed, "_nd_text", shingle_words, keep=["_nd_id", "_nd_hash", "_nd_row"]), "prints")
    labels = components(fingerprint_links(prints, "_nd_fp", max_bits))
    # the least row of a fingerprint, then of a component: aggregates that combine map-side, so no group is held by one task
    order = F.struct(F.col("_nd_id").isNull().alias("no_id"), F.col("_nd_id").alias("id"), F.col("_nd_hash").alias("h"), F.col("_nd_row").alias("row"))
    distinct = prints.groupBy("_nd_fp").agg(F.min(order).alias("_nd_low"))
    joined = distinct.join(labels, distinct["_nd_fp"] == labels["node"], "left")
    least = joined.groupBy(F.coalesce("label", "_nd_fp")).agg(F.min("_nd_low").alias("_nd_least"))
    kept = least.select(F.col("_nd_least.row").alias("_nd_kept"))
    # the rows that go are the smaller part: their numbers are found among narrow rows and broadcast up to a bound, so texts stay where they are
    gone = cut_lineage(prints.select(F.col("_nd_row").alias("_nd_gone")).join(kept, F.col("_nd_gone") == kept["_nd_kept"], "left_anti"), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return rows.join(gone, rows["_nd_row"] == gone["_nd_gone"], "left_anti").select(*[f"`{c}`" for c in docs.columns])
