"""Deterministic fault injection over any DataFrame.

Every choice is key arithmetic (``pmod(key, n)``), never a random draw, so a
Spark plan and a plain SQL statement over the same table produce the same
messy text row for row.  Used to turn the clean supplied tables into raw
entity extracts that exercise every quarantine rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def every(key: Column, n: int, r: int = 0) -> Column:
    """Selector: rows whose key falls in residue ``r`` of ``n``."""
    return F.pmod(key, F.lit(n)) == r


def blank(c: Column, when: Column) -> Column:
    """G1: the value becomes empty text."""
    return F.when(when, F.lit("")).otherwise(c)


def pad(c: Column, when: Column, left: str = "  ", right: str = "  ") -> Column:
    """G2: surround with whitespace."""
    return F.when(when, F.concat(F.lit(left), c, F.lit(right))).otherwise(c)


def upper_some(c: Column, when: Column) -> Column:
    """G3: upper-case some values."""
    return F.when(when, F.upper(c)).otherwise(c)


def pick(variants: Sequence[str], index: Column) -> Column:
    """G4: variant number ``index`` (0-based, taken modulo the list length)."""
    arr = F.array(*[F.lit(v) for v in variants])
    return F.element_at(arr, (F.pmod(index, F.lit(len(variants))) + 1).cast("int"))


def format_variant(ts: Column, index: Column, patterns: Sequence[str]) -> Column:
    """G5: render a timestamp with pattern number ``index`` of ``patterns``.

    Each pattern is a literal, so its formatter is made once and not for every row; the choice is a function over a
    one-element array, which keeps the generated method of a row short enough to be compiled.
    """
    def chosen(v: Column) -> Column:
        out = F.when(v == 0, F.date_format(ts, patterns[0]))
        for i, pattern in enumerate(patterns[1:], start=1):
            out = out.when(v == i, F.date_format(ts, pattern))
        return out

    return F.transform(F.array(F.pmod(index, F.lit(len(patterns)))), chosen)[0]


def duplicate_rows(df: DataFrame, when: Column, seq_col: str, seq_shift: int, **overrides: Column) -> DataFrame:
    """G6/G7: add a copy of the selected rows (optionally with changed columns), in one pass.

    ``seq_shift`` moves the copy in the arrival order (``seq_col``), so a copy
    can arrive after (positive) or before (negative) its original.
    """
    return with_copies(df, seq_col, [(when, seq_shift, overrides)])


def with_copies(df: DataFrame, seq_col: str, copies: Sequence[tuple[Column, int, dict]]) -> DataFrame:
    """Emit each row once, plus one extra row per ``(condition, seq_shift, overrides)`` that holds.

    A single scan: every row carries a small array of variant numbers
    (0 = the original) that is exploded, and each column is chosen per variant.
    """
    variants = F.array_compact(F.array(F.lit(0), *[F.when(c, F.lit(i + 1)) for i, (c, _, _) in enumerate(copies)]))
    exploded = df.select("*", F.explode(variants).alias("_variant"))
    v = F.col("_variant")
    cols = []
    for name in df.columns:
        expr = None
        for i, (_, shift, overrides) in enumerate(copies, start=1):
            if name == seq_col:
                value = F.col(name) + F.lit(shift)
            elif name in overrides:
                value = overrides[name]
            else:
                continue
            expr = F.when(v == i, value) if expr is None else expr.when(v == i, value)
        cols.append(F.col(name) if expr is None else expr.otherwise(F.col(name)).alias(name))
    return exploded.select(*cols)


def orphan_reference(fk: Column, when: Column, offset: int) -> Column:
    """G8: point some foreign keys past every parent key."""
    return F.when(when, fk + F.lit(offset)).otherwise(fk)
