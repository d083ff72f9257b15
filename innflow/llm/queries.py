"""Registered queries of this folder: each applies one operator with production parameters to its whole table.

``QUERIES`` maps a name to (spark, sf_dir) -> DataFrame and ``ORACLE_SQL`` a
name to DuckDB SQL for the same rows where SQL can express them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innflow.llm import conversations, fingerprints, hard_negatives, masked_lm, mixing, near_copies, neighbours, packing, privacy, quality, repeats, revisits, toxicity
from innflow.llm.common import cut_lineage, documents, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_lineage(fingerprints.fingerprint_and_edit(documents(spark, sf_dir)), "fingerprints")
    return fingerprints.with_neighbours(rows, radius=3).drop("hi", "lo")


def op2_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.private_report(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicated(documents(spark, sf_dir))


def op8_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_groups(documents(spark, sf_dir), shingle_words=4, max_bits=4)


def op9_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score_documents(documents(spark, sf_dir))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolve(revisits.capture_log(read_table(spark, sf_dir, "pages")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(read_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_privacy": op2_privacy,
    "op3_packing": op3_packing,
    "op4_repeats": op4_repeats,
    "op5_toxicity": op5_toxicity,
    "op6_neighbours": op6_neighbours,
    "op7_mixing": op7_mixing,
    "op8_near_copies": op8_near_copies,
    "op9_masked_lm": op9_masked_lm,
    "op10_revisits": op10_revisits,
    "op11_quality": op11_quality,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL: dict[str, str] = {
    "op7_mixing": mixing.ORACLE,
    "op10_revisits": revisits.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
