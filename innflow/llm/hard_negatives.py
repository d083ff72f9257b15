"""Hard-negative mining by a secondary-sort shuffle.

Vectors become integers (each component x becomes floor(256 x)) and a pair's score is its inner product with the
anchor.  The anchors are a stated query set; they meet all rows in blocks: chunks of at most
``CHUNK_BYTES`` are broadcast one after another, and a task multiplies its rows with a chunk by
matrix products of ``ROWS`` x ``COLUMNS``, so neither all pairs nor a score table of a task ever exist.

Per chunk, a first job finds each anchor's positives (the best rows of its label: a task keeps
the best few, a window over those small rows the final ones).  Each positive opens a window of scores, so a second
pass knows which rows can be negatives: a task keeps the best few of every window, which
is exact, as the best of all are among the best of each task.  Then the secondary sort: pairs are packed into keys (anchor,
descending score, positives before negatives, id), ``repartitionAndSortWithinPartitions`` deals them by anchor and
sorts them by key, and one streaming pass opens a window at each positive and emits negatives into the open
windows.  It holds the few open windows of one anchor only.  A vector of very many copies adds a few rows per task.

Scores are exact: float64 products where no partial sum can reach 2^50, else Python integers.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part;
components are held within 2^58, scores beyond a long are reported as the nearest long; a vector shorter than the others counts as
ending in zeros; rows that share the anchor's id are not its partners, and equal anchor rows answer once; other repeated rows are rows of
their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.llm.common import cut_lineage, ship, shuffle_partitions

CHUNK_BYTES = 16 << 20
ROWS, COLUMNS = 4096, 512
EXACT = 1 << 50
LARGEST = 1 << 58
_LOW = np.iinfo(np.int64).min
_FOUND = "tag bigint, score decimal(38,0), id bigint"
_RESULT = T.StructType([T.StructField(n, T.IntegerType() if n == "rank" else T.LongType()) for n in (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])


def prepared(vectors: DataFrame, id_col: str, label: Column, vector: str, scale: float) -> DataFrame:
    """``id``, ``label``, ``v`` (integer components) of the rows that take part."""
    top = F.lit(float(LARGEST))
    whole = F.transform(F.col(vector), lambda x: F.least(F.greatest(F.floor(x.cast("double") * F.lit(scale)).cast("double"), -top), top).cast("bigint"))
    finite = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).alias("_x"), finite.alias("_ok"),
                          whole.alias("v")).where("id is not null and label is not null and _x is not null and _ok").select("id", "label", "v")


def _matrix(lists: pa.ListArray, width: int | None = None) -> tuple[np.ndarray, int]:
    """Rows of an integer list column, ended with zeros (or cut) to ``width``, and the largest absolute value."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = flat[inside]
    return out, int(np.abs(out).max(initial=0))


class Anchors:
    """A chunk of anchors: ids, labels, components; ``windows`` holds per place among the positives their scores and which anchors have one."""

    def __init__(self, table: pa.Table):
        self.ids = table["id"].to_numpy()
        self.labels = table["label"].to_numpy()
        self.v, self.most = _matrix(pa.concat_arrays(table["v"].chunks))
        self.windows: list[tuple[np.ndarray, np.ndarray]] = []

    def open(self, found: list[tuple[int, int]], positives: int) -> None:
        """``found``: (anchor, score) of the positives, best first for each anchor."""
        places: list[list[tuple[int, int]]] = [[] for _ in range(positives)]
        met = [0] * len(self.ids)
        for i, score in found:
            places[met[i]].append((i, score))
            met[i] += 1
        for taken in places:
            kind = np.int64 if all(abs(s) < EXACT for _, s in taken) else object
            scores, has = np.zeros(len(self.ids), kind), np.zeros(len(self.ids), bool)
            for i, score in taken:
                scores[i], has[i] = score, True
            self.windows.append((scores, has))

    def scores(self, block: np.ndarray, block_most: int, part: slice) -> np.ndarray:
        """Exact inner products, anchors by rows; of Python integers where they might not fit."""
        if block_most * self.most * max(block.shape[1], 1) < EXACT:
            return np.rint(self.v[part].astype(np.float64) @ block.T.astype(np.float64)).astype(np.int64)
        return self.v[part].astype(object) @ block.T.astype(object)


def _best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per row of ``scores`` the k allowed columns of highest score, ties to smaller id, as (-score, id); ids ascend."""
    if scores.dtype == object:
        return [sorted((-int(s[c]), int(ids[c])) for c in np.flatnonzero(ok))[:k] for s, ok in zip(scores, allowed, strict=True)]
    # (score, place from the end) is one distinct number: scores stay below 2^50, blocks at 4,096 rows
    n = len(ids)
    keys = np.where(allowed, scores * ROWS + np.arange(n - 1, -1, -1), _LOW)
    if n > k:
        keys = np.partition(keys, n - k, axis=1)[:, n - k:]
    keys = -np.sort(-keys, axis=1)
    return [[(-int(x // ROWS), int(ids[n - 1 - x % ROWS])) for x in row if x != _LOW] for row in keys]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Ids, labels and components of up to ``ROWS`` rows, by ascending id, and the largest component."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            ids = part.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            v, most = _matrix(part.column("v"), width)
            yield ids[order], part.column("label").to_numpy()[order], v[order], most


def _finder(shared, positives: int, negatives: int, low: int, high: int):
    """A ``mapInArrow`` function: a task's best positives, or (once the chunk's windows are open) its best negatives of every window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        take = negatives if anchors.windows else positives
        for ids, labels, v, most in _blocks(batches, anchors.v.shape[1]):
            for start in range(0, len(anchors.ids), COLUMNS):
                part = slice(start, start + COLUMNS)
                scores = anchors.scores(v, most, part)
                other = anchors.ids[part][:, None] != ids[None, :]
                same = anchors.labels[part][:, None] == labels[None, :]
                if anchors.windows:
                    scaled = high * scores
                    rounds = [(j, other & ~same & has[part][:, None] & (scaled <= high * top[part][:, None]).astype(bool)
                               & (scaled >= low * top[part][:, None]).astype(bool)) for j, (top, has) in enumerate(anchors.windows) if has[part].any()]
                else:
                    rounds = [(0, other & same)]
                for j, allowed in rounds:
                    for i, found in enumerate(_best(scores, ids, allowed, take)):
                        if found:
                            key = (start + i, j)
                            best[key] = sorted(best[key] + found)[:take] if key in best else found
        # a row found for several windows goes out once, repeated rows as often as the window that holds most of them
        merged: dict[int, Counter] = defaultdict(Counter)
        for (i, _), found in best.items():
            merged[i] |= Counter(found)
        rows = [(i, -score, x) for i, found in merged.items() for score, x in found.elements()]
        tags, scores, ids = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(tags, pa.int64()), pa.array([Decimal(s) for s in scores], pa.decimal128(38, 0)),
                                          pa.array(ids, pa.int64())], names=["tag", "score", "id"])

    return find


def _long(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def _streamed(negatives: int, low: int, high: int):
    """Over keys (anchor id, anchor, descending score, positive before negative, id) in order: rows of the result."""

    def stream(pairs: Iterator[tuple[tuple[int, int, int, int, int], None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        anchor = None
        windows: list[list[int]] = []  # positive id, its score, negatives taken
        for (anchor_id, tag, down, kind, x), _ in pairs:
            if (anchor_id, tag) != anchor:
                anchor, windows = (anchor_id, tag), []
            if not kind:
                windows.append([x, -down, 0])
                continue
            for window in windows:
                if window[2] < negatives and low * window[1] <= -high * down:
                    window[2] += 1
                    yield anchor_id, window[0], window[2], x, _long(window[1]), _long(-down)

    return stream


def mined(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: Column | None = None, vector: str = "embedding", scale: float = 256.0,
          positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Per anchor, positive and rank: the first ``negatives`` rows of another label with low * positive_score <= high * negative_score <= high * positive_score.

    ``is_anchor`` is a condition on ``id``; ``low`` and ``high`` are whole numbers.
    """
    spark = vectors.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    rows = prepared(vectors, id_col, F.col("label") if label is None else label, vector, scale)
    rows = cut_lineage(rows.repartition(parts), "negatives-rows")
    anchors = rows.where(is_anchor).distinct()
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v") + 2).alias("longs")).first()
    if not size["n"]:
        return spark.createDataFrame([], _RESULT)
    chunks = -(-8 * size["longs"] // CHUNK_BYTES)
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("id", "label", "v", F.lit(7)), F.lit(chunks)))
    if chunks > 1:
        anchors = cut_lineage(anchors.repartition(parts, "chunk"), "negatives-anchors")
    options = (positives, negatives, low, high)
    keyed = []
    for chunk in range(chunks):
        table = anchors.where(F.col("chunk") == chunk).select("id", "label", "v").toArrow()  # about CHUNK_BYTES
        if not table.num_rows:
            continue
        held = Anchors(table)
        first = rows.mapInArrow(_finder(spark.sparkContext.broadcast(held), *options), _FOUND)
        order = Window.partitionBy("tag").orderBy(F.col("score").desc(), "id")
        best = first.select("tag", "score", "id", F.row_number().over(order).alias("place")).where(F.col("place") <= positives)
        found = [(r.tag, int(r.score), r.id) for r in best.collect()]  # at most ``positives`` small rows for each anchor of the chunk
        found.sort(key=lambda r: (r[0], -r[1], r[2]))
        held.open([(i, s) for i, s, _ in found], positives)
        shared = spark.sparkContext.broadcast(held)
        second = rows.mapInArrow(_finder(shared, *options), _FOUND)
        ids = held.ids.tolist()
        opened = spark.sparkContext.parallelize([((ids[i], chunk << 32 | i, -s, 0, x), None) for i, s, x in found], max(1, len(found) // 50_000))
        closed = second.select("tag", "score", "id").rdd.map(
            lambda r, shared=shared, chunk=chunk: ((int(shared.value.ids[r[0]]), chunk << 32 | r[0], -int(r[1]), 1, r[2]), None))
        keyed += [opened, closed]
    pairs = spark.sparkContext.union(keyed)
    dealt = pairs.repartitionAndSortWithinPartitions(parts, lambda key: hash((key[0], key[1])))
    return spark.createDataFrame(dealt.mapPartitions(_streamed(negatives, low, high)), _RESULT)


ORACLE = """
with taken as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::double)::bigint for x in embedding] as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
pairs as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_dot_product(a.v::double[], r.v::double[])::bigint as score
    from (select * from taken where vec_id % 100 = 0) a join taken r on a.vec_id <> r.vec_id),
positives as (
    select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from pairs where same) where place <= 5),
ranked as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
           row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as rank
    from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 5
"""
