"""The supplied parquet tables (read lazily, one reader per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SUPPLIED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; columns are pruned and filters pushed by the scan itself."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


class Tables:
    """Lazy accessor over a folder of supplied tables (each read once per instance)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
