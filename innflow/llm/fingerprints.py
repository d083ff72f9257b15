"""Document fingerprints by SimHash, and a search over them by permuted block tables.  Native: DataFrame functions only.

A text is lower-cased, cut at white space and read as overlapping word pairs
(one word alone: that word).  Every occurrence of a pair counts, so a pair's
weight is its number of occurrences; each pair's 64-bit hashes vote with that
weight for (bit set) or against (bit clear) each of ``BITS`` bits, and the
fingerprint has the bits with more votes for than against.

Votes are counted in an ordinary aggregate: one long holds the counters of
two bits, 32 bits each (a text would need 2^32 words to overflow one), so 128
bits cost 64 sums inside generated code and map-side combining applies.

Defined results: null or blank text has the zero fingerprint (32 zeros);
equal texts have equal fingerprints; rows with equal ids are kept, each as a
document of its own; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innflow.llm.common import bucket_of, cut_lineage, order_buckets, shuffle_partitions, text_or_empty

BITS = 128
_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    return F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r")), r"[ \t-\r]+")


def terms(words: Column) -> Column:
    """Array of (first word, second word) of the overlapping pairs; one word alone is (word, null)."""
    after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.arrays_zip(words.alias("a"), after.alias("b"))
    # the last word has no partner; it is a term only where it is the one word
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(1)))


def term_hashes(first: Column, second: Column) -> list[Column]:
    """The 128 hash bits of a term as two longs; the term of a blank text has none set."""
    blank = (first == "") & second.isNull()
    return [F.when(~blank, h).otherwise(F.lit(0).cast("bigint")).alias(f"h{j}")
            for j, h in enumerate((F.xxhash64(first, second), F.xxhash64(second, first, F.lit(1))))]


def vote_sums() -> list[Column]:
    """Aggregates over ``h0``, ``h1``: ``v0..v63``, each the votes for bits k and k+32 of a half, and ``n`` terms."""
    sums = [F.expr(f"sum(shiftrightunsigned(h{j}, {k}) & {_LANES}L) AS v{32 * j + k}") for j in (0, 1) for k in range(32)]
    return [*sums, F.count(F.lit(1)).alias("n")]


def fingerprint_of_votes() -> list[Column]:
    """The two 64-bit halves ``hi``, ``lo`` from the sums of ``vote_sums``."""
    def bit(counter: str, k: int) -> str:
        return f"if({counter} * 2 > n, shiftleft(1L, {k}), 0L)"

    out = []
    for j, name in enumerate(("hi", "lo")):
        low = [bit(f"(v{32 * j + k} & 4294967295L)", k) for k in range(32)]
        high = [bit(f"shiftrightunsigned(v{32 * j + k}, 32)", k + 32) for k in range(32)]
        out.append(F.expr(" | ".join(low + high)).alias(name))
    return out


def as_hex(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(a_hi: Column, a_lo: Column, b_hi: Column, b_lo: Column) -> Column:
    return F.bit_count(a_hi.bitwiseXOR(b_hi)) + F.bit_count(a_lo.bitwiseXOR(b_lo))


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per distinct ``keys`` with ``hi`` and ``lo``; ``keys`` should identify a text.

    Where the rows are already partitioned by some of the keys, the votes are summed without a shuffle.
    """
    words = df.select(*keys, words_of(text_or_empty(text)).alias("_w"))
    exploded = words.select(*keys, F.explode(terms(F.col("_w"))).alias("_t"))
    hashed = exploded.select(*keys, *term_hashes(F.col("_t.a"), F.col("_t.b")))
    return hashed.groupBy(*keys).agg(*vote_sums()).select(*keys, *fingerprint_of_votes())


def with_next(df: DataFrame, id_col: str, text: str, rows_per_bucket: int = 1_000) -> DataFrame:
    """Columns ``bucket``, ``place``, id, text and ``next_text``: the text of the next row by ascending id (last: first).

    Rows are dealt to contiguous id buckets; the first row of a bucket is
    also sent to the bucket before it as a guard, so ``lead`` inside a bucket sees
    every successor and the texts are shuffled once.  Guards are marked and stay
    in the result for the caller to drop.  Rows without an id come first;
    rows with equal ids follow the order of their texts.
    """
    spark = df.sparkSession
    ids = df.select(id_col)
    bounds = order_buckets(ids, id_col, rows_per_bucket, 4 * shuffle_partitions(spark))
    ends = ids.agg(F.min(id_col).alias("lo"), F.count(F.when(F.col(id_col).isNull(), 1)).alias("nulls")).first()
    i = F.col(id_col)
    own = bucket_of(i, bounds)
    starts_all = i.isNull() if ends["nulls"] else i == F.lit(ends["lo"])
    # a row whose id is its bucket's bound is the bucket's first
    starts_one = F.coalesce((own > 0) & (F.element_at(F.lit(bounds), F.greatest(own, F.lit(1))) == i), F.lit(False)) if bounds else F.lit(False)
    last = len(bounds)
    spots = F.array_compact(F.array(
        F.struct(own.alias("bucket"), F.lit(0).alias("guard")),
        F.when(starts_one, F.struct((own - 1).alias("bucket"), F.lit(1).alias("guard"))),
        F.when(F.coalesce(starts_all, F.lit(False)), F.struct(F.lit(last).alias("bucket"), F.lit(2).alias("guard"))),
    ))
    dealt = df.select(i.alias("_id"), text_or_empty(text).alias("_text"), F.explode(spots).alias("_s")).select(
        F.col("_s.bucket").alias("bucket"), F.col("_s.guard").alias("guard"), "_id", "_text")
    order = Window.partitionBy("bucket").orderBy("guard", F.col("_id").asc_nulls_first(), F.xxhash64("_text"), "_text")
    return dealt.select("bucket", "guard", F.row_number().over(order).alias("place"), "_id", "_text",
                        F.coalesce(F.lead("_text").over(order), F.lit("")).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprint_and_edit(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the text's fingerprint (text, and halves ``hi``, ``lo``), that of its edited text, and likenesses (1 - differing / all bits).

    The buckets of ``with_next`` stay the partitioning throughout: summing
    votes, pairing the two texts of a row and looking at the next row's fingerprint
    need no further shuffle.
    """
    rows = with_next(df, id_col, text)
    rows = rows.withColumn("_edited", edited(F.col("_text"), F.col("next_text")))
    keys = ["bucket", "guard", "place", "_id", "n_chars", "edited_sha256"]
    both = rows.select(
        "bucket", "guard", "place", "_id", F.char_length("_text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("edit"), F.col("_text").alias("body")),
                          F.struct(F.lit(1).alias("edit"), F.col("_edited").alias("body")))).alias("_v"),
    ).select(*keys, F.col("_v.edit").alias("edit"), F.col("_v.body").alias("body")).where("guard = 0 or edit = 0")
    prints = fingerprints(both, [*keys, "edit"], "body")
    pivot = prints.groupBy(*keys).agg(*[
        F.max(F.when(F.col("edit") == e, F.col(c))).alias(f"{c}{e}") for e in (0, 1) for c in ("hi", "lo")])
    order = Window.partitionBy("bucket").orderBy("guard", "place")
    seen = pivot.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("hi0", "lo0")]).where("guard = 0")
    col = F.col
    near = lambda hi, lo: 1.0 - distance(col("hi0"), col("lo0"), col(hi), col(lo)) / F.lit(float(BITS))
    return seen.select(
        col("_id").alias(id_col), "n_chars", "edited_sha256",
        as_hex(col("hi0"), col("lo0")).alias("fingerprint"), as_hex(col("hi1"), col("lo1")).alias("edited_fingerprint"),
        near("hi1", "lo1").alias("near_edited"), near("next_hi0", "next_lo0").alias("near_next"),
        col("hi0").alias("hi"), col("lo0").alias("lo"))


def block_tables(radius: int, blocks: int | None = None, bits: int = BITS) -> list[list[tuple[int, int]]]:
    """The tables of a search within ``radius``: each lists the (offset, width) blocks whose bits lead its permutation.

    Two fingerprints within the radius differ in at most ``radius`` of the ``blocks`` blocks, so
    they agree on all of some ``blocks - radius`` of them: one table for each such choice finds every pair.
    """
    blocks = blocks or radius + 2
    if not radius < blocks <= bits:
        raise ValueError("need radius < blocks <= bits")
    cuts = [bits * b // blocks for b in range(blocks + 1)]
    spans = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [list(chosen) for chosen in combinations(spans, blocks - radius)]


def _block(hi: Column, lo: Column, offset: int, width: int) -> Column:
    """Bits offset..offset+width of the 128, counted from the lowest of ``lo``, as one long (width under 64)."""
    mask = F.lit((1 << width) - 1)
    if offset >= 64:
        return F.shiftrightunsigned(hi, offset - 64).bitwiseAND(mask)
    part = F.shiftrightunsigned(lo, offset)
    if offset + width > 64:
        part = part.bitwiseOR(F.shiftleft(hi, 64 - offset))
    return part.bitwiseAND(mask)


def within_radius(prints: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """All pairs of different fingerprints (``hi``, ``lo``) at most ``radius`` bits apart, each once.

    Input rows with equal fingerprints count once (they are one class; the
    caller keeps its own membership).  Each table groups the fingerprints by its
    leading blocks; a pair met in several tables is reported by the first of
    them only, decided from the two fingerprints alone, so no distinct is needed.
    Result: ``a_hi, a_lo, b_hi, b_lo, bits`` with (a_hi, a_lo) below (b_hi, b_lo).
    """
    col = F.col
    tables = block_tables(radius, blocks)
    one = prints.select("hi", "lo").where("hi is not null and lo is not null").distinct()
    keys = [F.xxhash64(F.lit(t), *[_block(col("hi"), col("lo"), o, w) for o, w in spans]) for t, spans in enumerate(tables)]
    listed = one.select("hi", "lo", F.posexplode(F.array(*keys)).alias("table", "key"))
    a, b = listed.alias("a"), listed.alias("b")
    agree = [
        F.forall(F.array(*[_block(col("a.hi"), col("a.lo"), o, w) == _block(col("b.hi"), col("b.lo"), o, w) for o, w in spans]),
                 lambda x: x) for spans in tables]
    first = F.coalesce(*[F.when(ok, F.lit(t)) for t, ok in enumerate(agree)])
    below = (col("a.hi") < col("b.hi")) | ((col("a.hi") == col("b.hi")) & (col("a.lo") < col("b.lo")))
    bits = distance(col("a.hi"), col("a.lo"), col("b.hi"), col("b.lo"))
    return a.join(b, (col("a.table") == col("b.table")) & (col("a.key") == col("b.key")) & below
                  & (bits <= radius) & (first == col("a.table"))).select(
        col("a.hi").alias("a_hi"), col("a.lo").alias("a_lo"), col("b.hi").alias("b_hi"), col("b.lo").alias("b_lo"),
        bits.alias("bits"))


def with_neighbours(rows: DataFrame, radius: int = 3) -> DataFrame:
    """``rows`` (with ``hi``, ``lo``) and ``n_within``: how many other rows have a fingerprint at most ``radius`` bits away.

    Rows of equal fingerprints are counted as a class, and only different fingerprints are searched for each other.
    """
    col = F.col
    sizes = rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("size"))
    pairs = within_radius(rows, radius)
    both = pairs.select("a_hi", "a_lo", "b_hi", "b_lo").union(pairs.select("b_hi", "b_lo", "a_hi", "a_lo"))
    met = both.join(sizes, (col("b_hi") == col("hi")) & (col("b_lo") == col("lo"))).groupBy("a_hi", "a_lo").agg(F.sum("size").alias("others"))
    counted = sizes.join(met, (col("hi") == col("a_hi")) & (col("lo") == col("a_lo")), "left").select(
        col("hi").alias("_hi"), col("lo").alias("_lo"), (col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_within"))
    # written first, so that the join's two sides are plain exchanges and a fingerprint of very many rows can be split
    counted = cut_lineage(counted, "neighbours")
    return rows.join(counted, (col("hi") == col("_hi")) & (col("lo") == col("_lo"))).drop("_hi", "_lo")
