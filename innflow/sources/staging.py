"""Staged tables: write a frame once under the shared checkpoint folder, read it back.

Used where one plan feeds two outputs (accepted and rejected rows of a
classified entity): the classified frame is computed once, the lineage is
cut (a lost executor re-reads files instead of recomputing the joins), the
optimizer cannot re-inline the classification into each consumer's filter,
and later readers get parquet column pruning, filter pushdown and exact
row counts from the footers.

The folder comes from the session's ``spark.checkpoint.dir`` (the shared
folder the cluster names); only when unset (local tests) a scratch folder is
made by ``innflow.session.ensure_checkpoint_dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from innflow.session import ensure_checkpoint_dir


def stage_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/innflow-stage"


def new_run_dir(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame, run_dir: str, name: str) -> DataFrame:
    """Write ``df`` as parquet at ``run_dir/name`` (overwrite) and return the re-read table."""
    return stage_at(df, f"{run_dir}/{name}")


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` (overwrite) and return the re-read table."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
