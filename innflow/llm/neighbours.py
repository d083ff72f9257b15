"""Approximate nearest neighbours (Euclidean) by multiprobe p-stable hashing with exact reranking.

Each of ``TABLES`` tables hashes a vector to a bucket of ``PROJECTIONS``
cells, floor((a.v + b) / width) for Gaussian a and uniform b.  All rows are indexed.  A query visits in every table its own
bucket and then perturbed ones (a cell moved by one), in the order of the
sum of squared distances to the crossed cell walls, which estimates how
likely each holds a near vector; ``PROBES`` buckets per table in all.  Candidates are
compared by their exact distance on the original vectors, in double
precision, and merged over buckets and tables.

Spark's part: index rows and probes meet by (table, bucket).  Of equal vectors only
the ``k + 1`` smallest ids can be among anybody's k nearest, so only these are
indexed and each distinct query vector is searched once; the window that selects them is
limited before its shuffle.  A bucket of more than ``BUCKET_ROWS`` index rows is split
by id and its probes go to every part.  A task keeps the best k + 1 per query over the buckets it
sees and hands them on when it holds ``HELD`` of them.  Queries that have found
fewer than k + 1 are compared with all rows, in blocks.

Measured against brute force, recall of the 10 nearest is 0.95 and more on the supplied embeddings,
which are close to uniform on the sphere, the hardest case; tests hold it at 0.9.

Defined results: vectors that are null, empty, zero, or hold nulls, NaN or infinity take no part, nor do
those without an id or of another length than most; ids are expected to be unique, of rows with equal id and
vector one stands; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, ship, shuffle_partitions

TABLES, PROJECTIONS, WIDTH, PROBES = 12, 6, 1.3, 110
BUCKET_ROWS = 4_000
HELD = 200_000
BLOCK = 2_000_000


def projections(size: int, tables: int, count: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(tables * count, size)), rng.uniform(0, width, tables * count)


def probe_sequence(inside: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """The ``probes`` least costly perturbations for one table, cheapest first; ``inside``: place in each cell, 0 to 1.

    Costs are squared distances to the cell walls; sets are grown from a heap by shifting or extending the last member
    of the sorted walls, and those that move a cell both ways are skipped.
    """
    walls = sorted([(x * x, j, -1) for j, x in enumerate(inside)] + [((1 - x) ** 2, j, 1) for j, x in enumerate(inside)])
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(walls[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < len(walls):
            step = walls[last + 1][0]
            heapq.heappush(heap, (cost - walls[last][0] + step, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + step, (*chosen, last + 1)))
        if len({walls[c][1] for c in chosen}) == len(chosen):
            out.append([walls[c][1:] for c in chosen])
    return out


def _bucket_names(cells: np.ndarray) -> np.ndarray:
    """One long per row of cells (int64), mixed so that equal cells and only these agree (cells are within +-2^20)."""
    out = np.zeros(len(cells), dtype=np.uint64)
    for j in range(cells.shape[1]):
        out = (out ^ (cells[:, j].astype(np.int64) + (1 << 20)).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _hashed(size: int, tables: int, count: int, width: float, probes: int, seed: int):
    """Rows (id, vec) -> (table, bucket, id, vec): the own bucket in each table, and with ``probes`` > 1 perturbed ones."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = projections(size, tables, count, width, seed)
        for pdf in batches:
            if not len(pdf):
                continue
            place = (np.stack(pdf["vec"].to_numpy()).astype(np.float64) @ a.T + b) / width
            cells = np.floor(place)
            inside = place - cells
            cells = np.clip(cells, -(1 << 19), 1 << 19).astype(np.int64)
            for t in range(tables):
                own = cells[:, t * count:(t + 1) * count]
                if probes == 1:
                    yield pd.DataFrame({"tab": t, "bucket": _bucket_names(own), "id": pdf["id"], "vec": pdf["vec"]})
                    continue
                for at in range(0, len(pdf), 256):
                    rows, visits = [], []
                    for r in range(at, min(at + 256, len(pdf))):
                        sets = probe_sequence(inside[r, t * count:(t + 1) * count], probes)
                        moved = np.repeat(own[r][None], len(sets), axis=0)
                        for s, moves in enumerate(sets):
                            for j, step in moves:
                                moved[s, j] += step
                        rows.append(np.full(len(sets), r))
                        visits.append(moved)
                    picked = np.concatenate(rows)
                    yield pd.DataFrame({"tab": t, "bucket": _bucket_names(np.concatenate(visits)),
                                        "id": pdf["id"].to_numpy()[picked], "vec": pdf["vec"].to_numpy()[picked]})

    return run


class _Best:
    """The k best (distance, id) per query seen by a task."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, query: int, distance: np.ndarray, ids: np.ndarray) -> None:
        if query in self.found:
            d, i = self.found[query]
            distance, ids = np.concatenate([d, distance]), np.concatenate([i, ids])
        order = np.lexsort((ids, distance))
        ids, distance = ids[order], distance[order]
        if len(ids) > 1:  # the same row from another table has the same distance, so it stands beside itself
            new = np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(distance) != 0)])
            ids, distance = ids[new], distance[new]
        self.found[query] = (distance[:self.k], ids[:self.k])

    def flush(self) -> pd.DataFrame:
        frame = pd.DataFrame({
            "query": np.repeat(np.fromiter(self.found, dtype=np.int64, count=len(self.found)), [len(i) for _, i in self.found.values()]),
            "id": np.concatenate([i for _, i in self.found.values()]),
            "score": np.concatenate([d for d, _ in self.found.values()])})
        self.found = {}
        return frame


def _search(k: int):
    """Rows sorted by (tab, bucket, part, kind): a group's index rows (kind 0), then its probes (kind 1)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, group = _Best(k), None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[["tab", "bucket", "part", "kind"]].to_numpy()
            cut = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, [len(keys)]])
            all_ids, all_vecs = pdf["id"].to_numpy(), np.stack(pdf["vec"].to_numpy()).astype(np.float64)
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                key = tuple(keys[s, :3])
                if key != group:
                    group, ids, vectors = key, [], []
                if keys[s, 3] == 0:
                    ids.append(all_ids[s:e])
                    vectors.append(all_vecs[s:e])
                elif ids:
                    if len(ids) > 1:
                        ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    step = max(1, BLOCK // vectors[0].size)
                    for at in range(s, e, step):
                        some = all_vecs[at:min(e, at + step)]
                        distance = np.sqrt(((some[:, None, :] - vectors[0][None]) ** 2).sum(axis=2))
                        for q, d in zip(all_ids[at:min(e, at + step)].tolist(), distance, strict=True):
                            few = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                            best.add(q, d[few], ids[0][few])
                    if len(best.found) * k > HELD:
                        yield best.flush()
        if best.found:
            yield best.flush()

    return run


def _matched(index: DataFrame, probes: DataFrame, k: int, bucket_rows: int) -> DataFrame:
    """``query, id, score``: the best k of each probe group, for rows (tab, bucket, id, vec) that meet by (tab, bucket)."""
    counts = index.groupBy(F.col("tab").alias("_t"), F.col("bucket").alias("_b")).agg(F.count(F.lit(1)).alias("n"))
    parts = cut_lineage(counts.select("_t", "_b", F.ceil(F.col("n") / F.lit(bucket_rows)).cast("int").alias("parts")), "buckets")
    split = parts.where("parts > 1")
    held = index.join(split, (index["tab"] == split["_t"]) & (index["bucket"] == split["_b"]), "left").select(
        "tab", "bucket", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
        F.lit(0).alias("kind"), "id", "vec")
    # probes of buckets without rows end here
    asked = probes.join(parts, (probes["tab"] == parts["_t"]) & (probes["bucket"] == parts["_b"])).select(
        "tab", "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "id", "vec")
    n = 2 * shuffle_partitions(index.sparkSession)
    met = held.unionByName(asked).repartition(n, "tab", "bucket", "part").sortWithinPartitions("tab", "bucket", "part", "kind")
    return met.mapInPandas(_search(k), "query long, id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best different ids per query."""
    order = Window.partitionBy("query").orderBy("score", "id")
    return found.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = rows.where(F.col("id").isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return good.where(F.size("vec") == F.lit(sizes["s"] if sizes else 0)).dropDuplicates(["id", "vec"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            tables: int = TABLES, count: int = PROJECTIONS, width: float = WIDTH, probes: int = PROBES, seed: int = 11,
            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found of each row of ``queries`` (a selection of the rows of ``vectors``)."""
    ship(vectors.sparkSession)
    rows = cut_lineage(usable(vectors, id_col, vec_col), "vectors")
    least = Window.partitionBy("vec").orderBy("id")
    index = cut_lineage(rows.withColumn("rn", F.row_number().over(least)).where(F.col("rn") <= k + 1), "index")
    wanted = queries.select(F.col(id_col).cast("bigint").alias("q"))
    asked = rows.join(wanted.distinct(), rows["id"] == F.col("q")).select("id", "vec")
    first = index.where("rn = 1").select(F.col("id").alias("class"), F.col("vec").alias("_v"))
    member = cut_lineage(asked.join(first, asked["vec"] == first["_v"]).select("id", "class", "vec"), "queries")
    classes = member.groupBy("class").agg(F.first("vec").alias("vec")).select(F.col("class").alias("id"), "vec")
    head = index.select("vec").first()
    size = len(head["vec"]) if head else 1
    schema = "tab int, bucket long, id long, vec array<double>"
    held = index.select("id", "vec").mapInPandas(_hashed(size, tables, count, width, 1, seed), schema)
    probed = classes.mapInPandas(_hashed(size, tables, count, width, max(2, probes), seed), schema)
    found = cut_lineage(_matched(held, probed, k + 1, bucket_rows), "found")
    short = found.select("query", "id").distinct().groupBy("query").agg(F.count(F.lit(1)).alias("n"))
    few = classes.join(short.where(F.col("n") > k), F.col("id") == F.col("query"), "left_anti")
    total = index.count()
    if few.limit(1).count() and total:
        blocks = -(-total // bucket_rows)
        by_block = index.select(F.lit(0).alias("tab"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("bucket"), "id", "vec")
        to_all = few.select(F.lit(0).alias("tab"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("bucket"),
                            "id", "vec")
        found = found.unionByName(_matched(by_block, to_all, k + 1, bucket_rows))
    best = _top(found, k + 1).select(F.col("query").alias("_c"), F.col("id").alias("vec_id"), "score")
    each = member.select("id", "class").join(best, F.col("class") == F.col("_c")).where("id <> vec_id")
    order = Window.partitionBy("id").orderBy("score", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
