"""Foreign-key membership: flags for the quarantine rules, orphan counts for the checks.

``with_parent_flags`` marks, for several references of one child at once,
whether the key is among its parent's keys (one row per key):

* a parent whose measured row count is at most ``BROADCAST_MAX_ROWS`` is broadcast;
* a larger one with integer keys is broadcast as bitmaps (``keybits``) if they measure at most ``BITMAP_MAX_BYTES``;
* one with other keys (text, sparse integers) is broadcast as bitmaps of its keys' hashes.  A clear bit settles a child row; a
  set one is right unless the key shares it by chance, and those keys are found exactly beforehand: one aggregate over the
  different keys of both sides (map-side combined, no other column) gives the child's keys without a parent, and
  those of them whose bit is set are broadcast too.  No child row is moved or written, so the cost per row does not jump
  where a parent outgrows the first bound.  The child's key column is computed twice;
* only where those keys are more than ``BROADCAST_MAX_ROWS`` (or on demand) the child is written once and read back.  One aggregate
  over all their keys (map-side combined) finds hot keys; rows without a key never
  reach that join; a hot key's rows are split by a hash of their arrival
  order over ceil(rows / ``HOT_KEY_ROWS``) parts and its parent row is repeated for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innflow.operators.keybits import BITMAP_MAX_BYTES, INTEGRAL, LEAST_BITS, bitmap_bytes, key_bitmaps, with_bit
from innflow.sources.staging import new_run_dir, stage

# Parent key sets up to this many rows are broadcast (a key is 8-40 bytes,
# so the bound keeps the hashed relation far below the 8 GB broadcast limit).
BROADCAST_MAX_ROWS = 2_000_000
# In a shuffle join, a child key with more rows than this is split into
# ceil(rows / HOT_KEY_ROWS) parts, so no task receives more than about this many rows of one key.
HOT_KEY_ROWS = 2_000_000
# Bits of a hash bitmap per parent key: about one in 64 keys without a parent shares a bit (more where the byte bound is reached).
BITS_PER_KEY = 64


@dataclass(frozen=True)
class Reference:
    """A child column, the one-column frame of its parent's keys, the flag to add, and the parent's measured smallness."""

    key: str
    parent_keys: DataFrame
    flag: str
    small: bool


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a count: no columns are read, one row per task is exchanged)."""
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def with_parent_flags(child: DataFrame, references: Sequence[Reference], hot_key_rows: int | None = None,
                      run_dir: str | None = None, bitmap_max_bytes: int = BITMAP_MAX_BYTES) -> DataFrame:
    """``child`` with a boolean column per reference; a NULL key is not among the keys.

    ``bitmap_max_bytes`` = 0 takes large parents through the shuffle join at any size.
    """
    columns, run_dir = child.columns, run_dir or new_run_dir(child.sparkSession)
    as_bits = {r.flag for r in references if not r.small and bitmap_max_bytes and _fits_bitmaps(child, r, bitmap_max_bytes)}
    hashed = {r.flag: _hash_bitmaps(child, r, bitmap_max_bytes, run_dir) for r in references
              if not r.small and bitmap_max_bytes and r.flag not in as_bits and _hashes_alike(child, r)}
    hashed = {flag: found for flag, found in hashed.items() if found}
    large = [r for r in references if not r.small and r.flag not in as_bits and r.flag not in hashed]
    if large:
        name = "flagged_" + "_".join(r.flag.strip("_") for r in large)
        child = stage(child, run_dir, name)
        hot = _hot_keys(child, large, hot_key_rows or HOT_KEY_ROWS, run_dir, name)
    for r in references:
        keys = r.parent_keys.select(F.col(r.parent_keys.columns[0]).alias("_fk")).withColumn(r.flag, F.lit(True))
        if r.small:
            child = child.join(F.broadcast(keys), child[r.key] == F.col("_fk"), "left").drop("_fk")
        elif r.flag in as_bits:
            child = with_bit(child, F.col(r.key), key_bitmaps(r.parent_keys), r.flag)
        elif r.flag in hashed:
            child = hashed[r.flag].flagged(child, r)
        else:
            child = _shuffled_flag(child, r, keys, hot)
    return child.select(*columns, *[F.coalesce(F.col(r.flag), F.lit(False)).alias(r.flag) for r in references])


def _fits_bitmaps(child: DataFrame, r: Reference, max_bytes: int) -> bool:
    """Integer keys on both sides whose bitmaps, measured, take at most ``max_bytes``."""
    types = (child.schema[r.key].dataType, r.parent_keys.schema[0].dataType)
    return all(isinstance(t, INTEGRAL) for t in types) and bitmap_bytes(r.parent_keys) <= max_bytes


def _hashes_alike(child: DataFrame, r: Reference) -> bool:
    """Equal keys of both sides have equal hashes: text or integers of one type on both (not so floating zeros or collated text)."""
    kind = child.schema[r.key].dataType
    return kind == r.parent_keys.schema[0].dataType and (kind == T.StringType() or isinstance(kind, INTEGRAL))


@dataclass(frozen=True)
class _HashBitmaps:
    """Bitmaps of a parent's key hashes, and the child's keys (written, ``wrong_keys`` of them) whose bit is set though no parent has them."""

    bits: int
    marks: DataFrame
    wrong: DataFrame
    wrong_keys: int

    def flagged(self, child: DataFrame, r: Reference) -> DataFrame:
        columns = child.columns
        marked = with_bit(child, _slot(r.key, self.bits), self.marks, r.flag)
        if not self.wrong_keys:
            return marked
        met = marked.join(F.broadcast(self.wrong), marked[r.key] == F.col("_wrong_key"), "left")
        return met.select(*columns, (F.col(r.flag) & F.col("_wrong_key").isNull()).alias(r.flag))


def _slot(key: str, bits: int) -> Column:
    """The bit of a key, from 1 (buckets begin there); NULL for a NULL key."""
    return F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(bits).cast("bigint")) + 1)


def _hash_bitmaps(child: DataFrame, r: Reference, max_bytes: int, run_dir: str) -> _HashBitmaps | None:
    """None where too many keys share a bit by chance for a broadcast."""
    parent = r.parent_keys.select(F.col(r.parent_keys.columns[0]).alias("_k")).where("_k is not null")
    bits = min(max_bytes * 8, max(LEAST_BITS, BITS_PER_KEY * parent.count()))
    run_dir = f"{run_dir}/{uuid.uuid4().hex}"  # several children may have a reference of this name
    marks = stage(key_bitmaps(parent.select(_slot("_k", bits))), run_dir, "bits")
    seen = child.select(F.col(r.key).alias("_k")).where("_k is not null").withColumn("_own", F.lit(0)).unionByName(
        parent.withColumn("_own", F.lit(1)))
    orphans = seen.groupBy("_k").agg(F.max("_own").alias("_own")).where("_own = 0").select("_k")
    wrong = stage(with_bit(orphans, _slot("_k", bits), marks, "_hit").where("_hit").select(F.col("_k").alias("_wrong_key")), run_dir, "wrong")
    n = wrong.count()
    return _HashBitmaps(bits, marks, wrong, n) if n <= BROADCAST_MAX_ROWS else None


def _hot_keys(child: DataFrame, references: Sequence[Reference], limit: int, run_dir: str, name: str) -> DataFrame:
    """``_ref, _hk, _buckets``: keys with more than ``limit`` rows, over all references in one pass."""
    pairs = F.array(*[F.struct(F.lit(r.key).alias("_ref"), F.col(r.key).cast("string").alias("_hk")) for r in references])
    counts = child.select(F.explode(pairs).alias("p")).select("p.*").where("_hk is not null").groupBy("_ref", "_hk").agg(
        F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > limit).select("_ref", "_hk", F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_buckets"))
    return stage(hot, run_dir, name + "_hot")


def _shuffled_flag(child: DataFrame, r: Reference, keys: DataFrame, hot: DataFrame) -> DataFrame:
    columns = child.columns
    with_key, without = child.where(F.col(r.key).isNotNull()), child.where(F.col(r.key).isNull())
    mine = hot.where(F.col("_ref") == r.key).select("_hk", "_buckets")
    if mine.limit(1).count() == 0:
        joined = with_key.join(keys, with_key[r.key] == keys["_fk"], "left")
    else:
        mine = broadcast_if_small(mine)
        spread = F.xxhash64("_seq") if "_seq" in columns else F.xxhash64(*columns)
        salted = with_key.join(mine, with_key[r.key].cast("string") == mine["_hk"], "left").select(
            *columns, F.pmod(spread, F.coalesce("_buckets", F.lit(1))).cast("int").alias("_salt"))
        parent = keys.join(mine, keys["_fk"].cast("string") == mine["_hk"], "left").select(
            "_fk", r.flag, F.explode(F.sequence(F.lit(0), F.coalesce("_buckets", F.lit(1)) - 1)).alias("_part"))
        joined = salted.join(parent, (salted[r.key] == parent["_fk"]) & (salted["_salt"] == parent["_part"]), "left")
    return joined.select(*columns, r.flag).unionByName(without.withColumn(r.flag, F.lit(False)))


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                 skip_null: bool = False) -> DataFrame:
    """Child rows whose key has no parent row (LEFT JOIN ... WHERE parent IS NULL), as one count.

    Child keys are pre-aggregated (map-side combine) before the anti join, so a
    hot child key is one row by the time it meets the parent.  A NULL child
    key counts as an orphan, as in the SQL check; ``skip_null`` gives the
    declarative-test meaning instead.
    """
    per_key = child.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    if skip_null:
        per_key = per_key.where(F.col("_ck").isNotNull())
    # an anti join never multiplies rows, so the parent keys need no de-duplication
    parent_keys = parent.select(F.col(parent_key).alias("_pk")).where(F.col("_pk").isNotNull())
    orphans = per_key.join(parent_keys, per_key["_ck"] == parent_keys["_pk"], "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failing_rows"))
