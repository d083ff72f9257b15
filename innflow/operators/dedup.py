"""Keep-first de-duplication and duplicate-key reports.

Keep-first is an aggregate, not a window: ``min_by(row, order)`` per key is
split into a map-side partial and a final step, so a key holding a third of
all rows is collapsed to one row per map task before the shuffle instead of
landing whole in one sort task.

``keep_first_narrow`` gives the same rows without moving those whose key occurs once: eight-byte
hashes of the keys are counted first (a hash aggregate), the hashes seen more than once become a bitmap of bounded size, and
only rows whose hash is in it go through the aggregate.  Rows that share a bit by chance go with them, which is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.operators.keybits import BITMAP_MAX_BYTES, LEAST_BITS, key_bitmaps, with_bit
from innflow.sources.staging import new_run_dir, stage

COPIES = "_copies"
BITS_PER_HASH = 16  # bits of the bitmap per repeated hash: one in 16 other rows goes with them
MOST_BITS = BITMAP_MAX_BYTES * 8


def keep_first(df: DataFrame, key: str, order: Column | str, payload: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order``; ``_copies`` = rows that shared the key.

    ``order`` must be a total order within a key (ties would make the pick arbitrary).
    """
    order_col = F.col(order) if isinstance(order, str) else order
    cols = [c for c in (payload if payload is not None else df.columns) if c != key]
    first = (
        df.groupBy(key)
        .agg(
            F.min_by(F.struct(*[F.col(c) for c in cols]), order_col).alias("_first"),
            F.count(F.lit(1)).alias(COPIES),
        )
    )
    return first.select(F.col(key), *[F.col(f"_first.{c}").alias(c) for c in cols], F.col(COPIES))


def keep_first_narrow(df: DataFrame, key: str, order: Column | str, payload: Sequence[str] | None = None,
                      run_dir: str | None = None) -> DataFrame:
    """The rows of ``keep_first``; ``df`` is read three times, so it should be a written table.

    The repeated hashes are written (under ``run_dir``) to be counted; the bitmap has 16 bits for each, at most 64 MB.
    """
    cols = [c for c in (payload if payload is not None else df.columns) if c != key]
    hashes = df.select(F.xxhash64(key).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(hashes.where(F.col("_n") > 1).select("_h"), run_dir or new_run_dir(df.sparkSession), f"repeated_{key}")
    bits = F.lit(min(MOST_BITS, max(LEAST_BITS, BITS_PER_HASH * repeated.count()))).cast("bigint")
    marks = key_bitmaps(repeated.select((F.pmod("_h", bits) + 1).alias("_slot")))  # slots from 1: buckets begin there
    marked = with_bit(df, F.pmod(F.xxhash64(key), bits) + 1, marks, "_again")
    alone = marked.where(~F.col("_again")).select(key, *cols, F.lit(1).cast("bigint").alias(COPIES))
    return alone.unionByName(keep_first(marked.where("_again").drop("_again"), key, order, payload=cols))


def duplicate_keys(df: DataFrame, key: str, skip_null: bool = False) -> DataFrame:
    """Keys seen more than once (GROUP BY k HAVING count(*) > 1); NULL forms a group unless skipped."""
    src = df.where(F.col(key).isNotNull()) if skip_null else df
    return (
        src.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )
