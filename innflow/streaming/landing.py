"""Incremental landing of raw extract files into bronze with Structured Streaming.

New CSV files dropped into ``<landing_dir>/<table>/`` are appended to
``<bronze_dir>/<table>/`` exactly once: the file source remembers processed
files in the checkpoint, and each micro-batch overwrites only its own
``_batch`` partition, so a batch replayed after a failure replaces rather than
duplicates its rows.  ``trigger(availableNow=True)`` processes whatever has
arrived and stops, which suits a scheduled run.  Values stay text; the arrival
order is (batch, file, position), a total order like that of ``innflow.sources.files.read_raw_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.plans.roles import RAW_COLUMNS
from innflow.sources.files import CSV_OPTIONS, file_stamp


def _schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


def _append_batch(bronze_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(
            *_text_columns(batch),
            F.col("_source_file"),
            F.current_timestamp().cast("timestamp_ntz").alias("_ingested_at"),
            F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.col("_source_file").alias("file"),
                     F.monotonically_increasing_id().alias("row")).alias("_seq"),
            F.lit(batch_id).cast("bigint").alias("_batch"),
        )
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch")
         .parquet(bronze_path))
    return write


def _text_columns(batch: DataFrame) -> list:
    return [F.col(c) for c in batch.columns if c != "_source_file"]


def land(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str, table: str) -> int:
    """Process every file that has arrived for ``table`` and stop; returns rows now in bronze."""
    stream = (
        spark.readStream.schema(_schema(table)).options(**CSV_OPTIONS)
        .csv(f"{landing_dir}/{table}")
        .withColumn("_source_file", F.col("_metadata.file_name"))
    )
    query = (
        stream.writeStream.foreachBatch(_append_batch(f"{bronze_dir}/{table}"))
        .option("checkpointLocation", f"{checkpoint_dir}/{table}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed = f"{bronze_dir}/{table}"
    return spark.read.parquet(landed).count() if file_stamp(spark, landed) else 0
