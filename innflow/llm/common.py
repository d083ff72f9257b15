"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import innflow
from innflow.sources.staging import new_run_dir, stage
from innflow.sources.tables import read_table

__all__ = ["cut_lineage", "documents", "order_buckets", "read_table", "ship", "shuffle_partitions", "text_or_empty"]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, as ``--py-files`` would (once per Spark application)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(innflow.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="innflow-ship-")) / "innflow-package.zip"  # the driver's own copy; Spark serves it
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(target))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder (``spark.checkpoint.dir``) and read it back."""
    return stage(df, new_run_dir(df.sparkSession), name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def order_buckets(ids: DataFrame, column: str, rows_per_bucket: int, at_least: int, at_most: int = 65_536) -> list[int]:
    """Sorted distinct lower bounds (values of ``column``) that cut its non-null values into contiguous buckets.

    One aggregate over the narrow column; the driver gets at most ``at_most``
    numbers.  Bucket b holds the values from bound b-1 (inclusive) to bound b
    (exclusive); bucket 0 also holds nulls.
    """
    n = ids.where(F.col(column).isNotNull()).count()
    wanted = min(at_most, max(at_least, -(-n // rows_per_bucket)), max(1, n))
    if wanted <= 1:
        return []
    shares = [i / wanted for i in range(1, wanted)]
    row = ids.agg(F.percentile_approx(column, shares, max(10_000, 4 * wanted)).alias("b"), F.min(column).alias("lo")).first()
    return sorted({int(x) for x in row["b"] if x > row["lo"]})


def bucket_of(column: Column, bounds: list[int]) -> Column:
    """Number of bounds not above the value (null: 0), by binary search, inside a native expression."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    table = F.lit(bounds).cast("array<bigint>")
    size = len(bounds)

    def step(position: Column, half: Column) -> Column:
        ahead = position + half
        return F.when((ahead <= size) & (F.element_at(table, F.least(ahead, F.lit(size))) <= column), ahead).otherwise(position)

    halves = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])
    return F.coalesce(F.aggregate(halves, F.lit(0), step), F.lit(0))
