"""Bitmaps of integer keys: membership against very large key sets without moving the child.

A bitmap holds 32,768 neighbouring ids in 4 KB (``bitmap_construct_agg`` per ``bitmap_bucket_number``), built by
an ordinary grouped aggregate.  Its size in bytes is known before it is broadcast: buckets x 4 KB, whatever the number of ids:
100 million dense ids take 12.5 MB, and all ids of the INTEGER range can never take more than 512 MB.  The child
then looks its bit up in the broadcast bucket, so neither its rows nor the parent's are shuffled by the
key and a hot key costs nothing extra.

A null id is in no bitmap.  Duplicates among the ids change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BYTES = 4096
PIECE_BYTES = 128
# largest bitmap set to broadcast; as the runtime broadcast bound of the sessions
BITMAP_MAX_BYTES = 64 << 20
# fewest bits of a bitmap of hashes: one bucket
LEAST_BITS = 1 << 15

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def key_bitmaps(ids: DataFrame) -> DataFrame:
    """``_bucket, _bits`` of the one column of ``ids``: one row of 4 KB per 32,768 neighbouring values that holds any."""
    value = F.col(ids.columns[0]).cast("bigint")
    keyed = ids.where(value.isNotNull()).select(
        F.bitmap_bucket_number(value).alias("_bucket"), F.bitmap_bit_position(value).alias("_position"))
    return keyed.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))


def bitmap_bytes(ids: DataFrame) -> int:
    """What ``key_bitmaps`` will take: an aggregate over bucket numbers, one row per bucket."""
    value = F.col(ids.columns[0]).cast("bigint")
    return ids.where(value.isNotNull()).select(F.bitmap_bucket_number(value).alias("b")).distinct().count() * BUCKET_BYTES


def with_bit(df: DataFrame, key: Column, bitmaps: DataFrame, flag: str) -> DataFrame:
    """``df`` and a boolean ``flag``: whether ``key`` is set in ``bitmaps``, which are broadcast (their size was checked).

    They are broadcast in pieces, since a lookup copies the bytes it meets.
    """
    value, columns = key.cast("bigint"), df.columns
    pieces = bitmaps.select("_bucket", "_bits", F.explode(F.sequence(F.lit(0), F.lit(BUCKET_BYTES // PIECE_BYTES - 1))).alias("_n")).select(
        (F.col("_bucket") * (BUCKET_BYTES // PIECE_BYTES) + F.col("_n")).alias("_kb_piece"),
        F.substring("_bits", F.col("_n") * PIECE_BYTES + 1, F.lit(PIECE_BYTES)).alias("_kb_bits"))
    met = df.withColumn("_kb_value", value).withColumn("_kb_position", F.bitmap_bit_position("_kb_value"))
    piece = F.bitmap_bucket_number("_kb_value") * (BUCKET_BYTES // PIECE_BYTES) + F.expr(f"_kb_position div {PIECE_BYTES * 8}")
    met = met.join(F.broadcast(pieces), piece == F.col("_kb_piece"), "left")
    # the byte of the position as a number 0..255 (Latin-1 maps bytes to code points one to one)
    at = F.expr(f"cast(_kb_position % {PIECE_BYTES * 8} div 8 as int)") + 1
    byte = F.ascii(F.decode(F.substring("_kb_bits", at, F.lit(1)), "ISO-8859-1"))
    bit = F.getbit(byte, (F.col("_kb_position") % 8).cast("int")) == 1
    return met.select(*columns, F.coalesce(bit, F.lit(False)).alias(flag))
