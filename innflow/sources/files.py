"""Raw text extracts: CSV in (all strings, lineage, arrival order), CSV out.

Reading keeps every value as text (no inference), so nothing is coerced
before the cleaning job sees it.  ``multiLine`` + ``escape='"'`` read quoted
fields with doubled quotes and embedded newlines; the empty field reads as
NULL.  A row with too many or too few fields is kept whole, as text, in ``_malformed``.  A multi-line CSV file is not split, so large extracts should arrive
as many part files (a folder per table is accepted), which may be compressed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from innflow.functions.normalize import normalize_header

# enforceSchema=false: a part file whose header differs from the first one's fails instead of being read by position
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "inferSchema": "false", "mode": "PERMISSIVE",
               "enforceSchema": "false", "columnPruning": "false"}  # the fields of a row are counted whichever columns are read
# the text of a row whose fields are not as many as the header's (NULL: the row is well formed)
MALFORMED = "_malformed"


class MissingSourceError(FileNotFoundError):
    """An expected raw extract is absent."""


def _status(spark: SparkSession, path: str):
    """The file status by the path's own file system, or None where nothing is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(place) if system.exists(place) else None


def file_stamp(spark: SparkSession, path: str) -> tuple:
    """(size, modification time) of a file or folder on any file system; () where there is none."""
    status = _status(spark, path)
    return (status.getLen(), status.getModificationTime()) if status else ()


def source_path(spark: SparkSession, raw_dir: str, table: str) -> str:
    """``<raw_dir>/<table>.csv`` (one file) or ``<raw_dir>/<table>/`` (part files), on whatever file system the path names."""
    single, folder = (f"{raw_dir.rstrip('/')}/{table}{end}" for end in (".csv", ""))
    for place in (single, folder):
        if _status(spark, place):
            return place
    raise MissingSourceError(f"expected source extract not found for table '{table}': {single} or {folder}/")


def read_raw_csv(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """All-text scan of one extract, ``_malformed``, and lineage: ``_source_file``, ``_ingested_at`` and ``_seq``.

    A malformed row's other columns hold what fields it has, by position; the cleaning quarantines it by ``_malformed``.
    ``_seq`` = (file name, position in the scan) is the arrival order used by
    keep-first; it is stored in bronze so it never changes afterwards.
    """
    path = source_path(spark, raw_dir, table)
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in (*header, MALFORMED)])
    df = spark.read.options(**CSV_OPTIONS, columnNameOfCorruptRecord=MALFORMED).schema(schema).csv(path)
    df = df.toDF(*normalize_header(header), MALFORMED)
    return df.select(
        *df.columns,
        F.col("_metadata.file_name").alias("_source_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("_ingested_at"),
        F.struct(F.col("_metadata.file_name").alias("file"),
                 F.monotonically_increasing_id().alias("row")).alias("_seq"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Text extract with a header row (quotes doubled, so ``read_raw_csv`` reads it back), as gzip: a multi-line CSV file is not
    split anyway."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "true")
     .option("emptyValue", "").option("compression", "gzip").csv(path))


def write_with_count(df: DataFrame, path: str, name: str, partition_by: str | None = None) -> int:
    """Full-refresh parquet write; the row count is observed on the write itself (no second pass)."""
    obs = Observation(f"rows_{name}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return int(obs.get["rows"])
