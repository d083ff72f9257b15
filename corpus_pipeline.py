"""A corpus pipeline over ``documents``: toxicity filter, near-copies, privacy, source mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, all but the last with the columns of documents.  ``run``
writes each stage's result as a parquet table in the shared folder and hands the
re-read table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innflow.llm import mixing, near_copies, packing, privacy, toxicity
from innflow.llm.common import cut_lineage, documents, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return toxicity.keep_ordinary(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of SimHash near-copies stays (4-word shingles, 4 bits)."""
    return near_copies.keep_one_row_per_group(docs, shingle_words=4, max_bits=4)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal identifiers and the terms that reveal them are masked; ``n_chars`` follows the new text."""
    clean = privacy.sanitise(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("bigint"))
    return clean.withColumn("n_chars", length)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is brought to its target weight by Poisson replication, copies in global random order."""
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all copies in sequences of at most 4096 tokens, in a random order that spreads the copies of a document."""
    return packing.pack_documents(docs, seed="pack")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("privacy", mask_private),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# A fitted classifier, connected components and a tokenizer: SQL cannot express them; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
