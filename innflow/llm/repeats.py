"""Removal of passages that repeat across documents, by prefix-partitioned suffix groups.

A window of ``WINDOW`` = 50 words goes where the same words start a window in a document with
a smaller id; a word goes if any such window covers it.  In a suffix tree of all texts these
windows are the leaves under nodes of depth 50 that also hold a leaf of a smaller document.  The
tree is never whole anywhere:

1. Suffixes are indexed at anchors only: of the ``PREFIX``-word prefixes that
   start inside a window and end in it, the one of least hash.  Equal windows choose
   the same anchor, so every repeat of 50 words shows at one; about one word in
   twenty is an anchor.
2. Anchors are counted by their prefix (map-side combined).  A prefix in one
   document only has no branch to another document; it is dropped, with its suffixes.
3. Texts with remaining anchors are fetched.  Each remaining suffix group is a
   subtree: its rows are the runs of windows that hold the anchor, as hashes of
   the paths of depth 50.  Sorting a group by path finds its deep nodes, and the
   least document of each.
4. A prefix with more than ``GROUP_ROWS`` suffixes is split by a hash of (id, text); each part settles all
   but its least document per path, and those few meet again under the longer
   prefix, the whole path: the least id of a path is an aggregate, which its rows then join.
   So no task holds a large group, and none is capped.

Rows of equal id and equal text are judged alike: they become one before their suffixes are grouped (combined in
each task first), and all lists kept per row are of one text's own prefixes or ranges.

Rows move between steps as tables in the shared folder.

Defined results: null text has no words; rows without an id lose and remove nothing; rows with
equal ids are judged each, by their own text, against smaller ids only; texts under 50 words are unchanged;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, ship, shuffle_partitions, text_or_empty
from innflow.llm.wordhash import run_hashes, window_argmin, word_hashes

WINDOW = 50
PREFIX = 8
GROUP_ROWS = 4_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def anchors(words: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray]:
    """For the windows of a text: the prefix hashes of all positions, and each window's anchor position."""
    heads = run_hashes(words, prefix)
    return heads, window_argmin(heads, window - prefix + 1)


def find_anchors(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """``key, id, h, times``: the different prefixes at the anchors of every row, and at how many each stands (``docs``: id, h, t)."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, times = [], []
            for t in pdf["t"]:
                heads, chosen = anchors(word_hashes(t), window, prefix)
                different, n = np.unique(heads[np.unique(chosen)], return_counts=True)
                keys.append(different)
                times.append(n)
            if keys:
                n = [len(k) for k in keys]
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "id": np.repeat(pdf["id"].to_numpy(dtype=np.int64), n),
                                    "h": np.repeat(pdf["h"].to_numpy(dtype=np.int64), n), "times": np.concatenate(times)})

    return docs.mapInPandas(scan, "key long, id long, h long, times long")


def find_runs(texts: DataFrame, window: int, prefix: int) -> DataFrame:
    """``key, salt, id, h, start, paths``: per remaining anchor the consecutive windows that chose it."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, h, t, marks in zip(pdf["id"], pdf["h"], pdf["t"], pdf["marks"], strict=True):
                words = word_hashes(t)
                heads, chosen = anchors(words, window, prefix)
                if not len(chosen):
                    continue
                paths = run_hashes(words, window).view(np.int64)
                salts = {m["key"]: m["salt"] for m in marks}
                first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1, [len(chosen)]])
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    key = int(heads[chosen[a]].view(np.int64))
                    if key in salts:
                        rows.append((key, salts[key], i, h, a, paths[a:b]))
            yield pd.DataFrame(rows, columns=["key", "salt", "id", "h", "start", "paths"])

    return texts.mapInPandas(scan, "key long, salt int, id long, h long, start int, paths array<long>")


def _settle(window: int):
    """Sorted rows of (key, salt) groups -> ranges of words to remove, and the least rows of groups in parts (path not null)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            key, salt = pdf["key"].to_numpy(), pdf["salt"].to_numpy()
            last = (key == key[-1]) & (salt == salt[-1])
            if last.all() and _same_group(held[0], pdf):
                continue
            rows = pd.concat(held, ignore_index=True)
            cut = len(rows) - int(last.sum())
            yield _settled(rows.iloc[:cut], window)
            held = [rows.iloc[cut:]]
        if held:
            yield _settled(pd.concat(held, ignore_index=True), window)

    return run


def _same_group(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    return a["key"].iloc[0] == b["key"].iloc[-1] and a["salt"].iloc[0] == b["salt"].iloc[-1]


_OUT = ["id", "h", "start", "stop", "key", "path"]


def _settled(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame(columns=_OUT)
    sizes = np.fromiter(map(len, rows["paths"]), dtype=np.int64, count=len(rows))
    path = np.concatenate(rows["paths"].to_numpy())
    row = np.repeat(np.arange(len(rows)), sizes)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = rows["start"].to_numpy().astype(np.int64)[row] + np.arange(len(path)) - begin[row]
    key, salt, ids, h = (rows[c].to_numpy()[row] for c in ("key", "salt", "id", "h"))
    order = np.lexsort((ids, path, salt, key))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(path[order]) != 0) | (np.diff(key[order]) != 0) | (np.diff(salt[order]) != 0)
    group = np.cumsum(new) - 1
    least = ids[order][np.flatnonzero(new)][group]
    gone = np.zeros(len(order), dtype=bool)
    gone[order] = ids[order] > least
    parts = ~gone & (salt >= 0)  # salt -1: the group is whole
    # consecutive removed windows of a run make one range of words
    g = np.flatnonzero(gone)
    breaks = np.ones(len(g), dtype=bool)
    breaks[1:] = (np.diff(g) != 1) | (row[g][1:] != row[g][:-1])
    first = g[breaks]
    last = g[np.concatenate([np.flatnonzero(breaks)[1:] - 1, [len(g) - 1]])] if len(g) else g
    p = np.flatnonzero(parts)
    none = np.full(len(first), None, dtype=object)
    return pd.concat([
        pd.DataFrame({"id": ids[first], "h": h[first], "start": at[first], "stop": at[last] + window,
                      "key": pd.array(none, dtype="Int64"), "path": pd.array(none, dtype="Int64")}),
        pd.DataFrame({"id": ids[p], "h": h[p], "start": at[p], "stop": at[p] + window,
                      "key": pd.array(key[p], dtype="Int64"), "path": pd.array(path[p], dtype="Int64")}),
    ], ignore_index=True)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_rows: int = GROUP_ROWS
                    ) -> tuple[DataFrame, DataFrame]:
    """(different texts with remaining anchors: id, h, t; word ranges to remove: id, h, start, stop) for ``docs`` (id, h, t)."""
    ship(docs.sparkSession)
    known = docs.where("id is not null and t is not null")
    found = cut_lineage(find_anchors(known.select("id", "h", "t"), window, prefix), "anchors")
    branching = found.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("times").alias("n"))
    branching = cut_lineage(branching.where("lo < hi").select(F.col("key").alias("_k"), "n"), "prefixes")
    parts = F.ceil(F.col("n") / F.lit(group_rows))
    salt = F.when(F.col("n") > group_rows, F.pmod(F.xxhash64("id", "h"), parts)).otherwise(F.lit(-1)).cast("int")
    marks = found.join(branching, found["key"] == branching["_k"]).select("id", "h", F.struct("key", salt.alias("salt")).alias("m"))
    per_text = marks.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(F.collect_set("m").alias("marks"))
    once = known.dropDuplicates(["id", "h"])
    texts = cut_lineage(once.join(per_text, (once["id"] == per_text["_id"]) & (once["h"] == per_text["_h"]))
                        .select("id", "h", "t", "marks"), "texts")
    n = 2 * shuffle_partitions(docs.sparkSession)
    runs = find_runs(texts, window, prefix).repartition(n, "key", "salt").sortWithinPartitions("key", "salt")
    schema = "id long, h long, start long, stop long, key long, path long"
    settled = cut_lineage(runs.mapInPandas(_settle(window), schema), "ranges")
    # the least documents of each part of a split prefix meet under their whole path
    waiting = settled.where("path is not null")
    least = waiting.groupBy(F.col("key").alias("_k"), F.col("path").alias("_p")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    least = least.where("lo < hi").drop("hi")
    later = waiting.join(least, (waiting["key"] == least["_k"]) & (waiting["path"] == least["_p"])).where("id > lo")
    ranges = settled.where("path is null").select("id", "h", "start", "stop").unionByName(later.select("id", "h", "start", "stop"))
    return texts.select("id", "h", "t"), ranges


def _kept(texts: pd.Series, ranges: pd.Series) -> tuple[list[int], list[str]]:
    removed, kept = [], []
    for t, spans in zip(texts, ranges, strict=True):
        words = _WORD.findall(t)
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        for s in spans:
            gone[s["start"]] += 1
            gone[s["stop"]] -= 1
        keep = np.cumsum(gone)[:-1] == 0
        removed.append(int(len(words) - keep.sum()))
        kept.append(" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]))
    return removed, kept


def shortened(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, h, n_removed, kept`` of the texts that lose words (``docs``: id, h, t); kept words joined by one space."""
    texts, ranges = repeated_ranges(docs, window)
    per_doc = ranges.groupBy(F.col("id").alias("_id"), F.col("h").alias("_h")).agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = texts.join(per_doc, (texts["id"] == per_doc["_id"]) & (texts["h"] == per_doc["_h"])).select("id", "h", "t", "ranges")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            removed, kept = _kept(pdf["t"], pdf["ranges"])
            yield pd.DataFrame({"id": pdf["id"], "h": pdf["h"], "n_removed": removed, "kept": kept})

    return joined.mapInPandas(cut, "id long, h long, n_removed long, kept string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``kept_sha256`` (kept words joined by one space, UTF-8)."""
    body = text_or_empty(text)
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(body).alias("h"), body.alias("t"))
    changed = shortened(keyed, window).select(
        F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("n_removed").alias("_n"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("_sha"))
    words = F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    plain = keyed.select("id", "h", words.alias("w")).select(
        "id", "h", F.size("w").cast("bigint").alias("n_words"), F.sha2(F.array_join("w", " ").cast("binary"), 256).alias("sha"))
    joined = plain.join(changed, (plain["id"] == changed["_id"]) & (plain["h"] == changed["_h"]), "left")
    return joined.select(F.col("id").alias(id_col), "n_words", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_removed"),
                         F.coalesce("_sha", "sha").alias("kept_sha256"))
