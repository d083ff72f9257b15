"""Many checks over many tables in one tagged pass.

Every check becomes rows ``(tag, key, child, own)`` of the table it looks at: a reference emits its child's keys
(``child`` = 1) and its parent's (``own`` = 1), a uniqueness check the keys themselves, a condition only the rows that
fail it.  Each table is read once, its rows exploded over its checks; one ``groupBy(tag, key)``, combined in every task
first, meets all keys of all checks, so a hot key is one row per task; a second, tiny aggregate adds up per check.
Conditions and null keys share one group per check and cost nothing beyond that combining.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# how the groups of a check count
SUM, UNIQUE, DISTINCT = 0, 1, 2


@dataclass(frozen=True)
class Condition:
    """Rows of ``table`` for which ``failing`` is true."""

    table: str
    failing: Column


@dataclass(frozen=True)
class Unique:
    """Keys of ``table`` that occur more than once (null is a key unless skipped)."""

    table: str
    key: str
    skip_null: bool = False


@dataclass(frozen=True)
class Reference:
    """Rows of ``table`` whose key is no key of ``parent`` (null keys fail unless skipped)."""

    table: str
    key: str
    parent: str
    parent_key: str
    skip_null: bool = False


@dataclass(frozen=True)
class Listed:
    """Different non-null values of ``column`` outside ``values``."""

    table: str
    column: str
    values: tuple


Check = Condition | Unique | Reference | Listed
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _entry(types: dict, tag: int, key: str | None, child: int, own: int, when: Column | None) -> Column:
    """One row of a check, or null where ``when`` is not true; integral keys stay numbers, others become text."""
    number, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if key is not None:
        if types[key] in _INTEGRAL:
            number = F.col(key).cast("bigint")
        else:
            text = F.col(key).cast("string")
    entry = F.struct(F.lit(tag).alias("tag"), number.alias("number"), text.alias("text"),
                     F.lit(child).cast("bigint").alias("child"), F.lit(own).cast("bigint").alias("own"))
    return entry if when is None else F.when(when, entry)


def _entries(name: str, types: dict, checks: Sequence[Check]) -> list[Column]:
    out = []
    for tag, c in enumerate(checks):
        if isinstance(c, Reference) and c.parent == name:
            out.append(_entry(types, tag, c.parent_key, 0, 1, F.col(c.parent_key).isNotNull()))
        if c.table != name:
            continue
        if isinstance(c, Condition):
            out.append(_entry(types, tag, None, 1, 0, c.failing))
        elif isinstance(c, Unique):
            out.append(_entry(types, tag, c.key, 0, 1, F.col(c.key).isNotNull() if c.skip_null else None))
        elif isinstance(c, Reference):
            out.append(_entry(types, tag, c.key, 1, 0, F.col(c.key).isNotNull() if c.skip_null else None))
        else:
            out.append(_entry(types, tag, c.column, 1, 0, F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)))
    return out


def _kind(check: Check) -> int:
    return UNIQUE if isinstance(check, Unique) else DISTINCT if isinstance(check, Listed) else SUM


def failing_rows(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """``tag, failing_rows``: one row per check (``tag`` is its place in ``checks``), 0 where nothing fails.

    Keys of a reference must be integral on both sides or text on both sides.  Tables without a check are not read.
    """
    spark = next(iter(tables.values())).sparkSession
    # a row of zeros per check, so that a check over empty tables still has a result
    rows = spark.range(len(checks), numPartitions=1).select(
        F.col("id").cast("int").alias("tag"), F.lit(None).cast("bigint").alias("number"), F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("child"), F.lit(0).cast("bigint").alias("own"))
    for name, df in tables.items():
        entries = _entries(name, dict(df.dtypes), checks)
        if entries:
            exploded = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
            rows = rows.unionByName(exploded.select("e.*"))
    kind = F.element_at(F.array(*[F.lit(_kind(c)) for c in checks]), F.col("tag") + 1)
    groups = rows.groupBy("tag", "number", "text").agg(F.sum("child").alias("child"), F.sum("own").alias("own"))
    failing = (F.when(kind == UNIQUE, (F.col("own") > 1).cast("bigint"))
               .when(kind == DISTINCT, (F.col("child") > 0).cast("bigint"))
               .otherwise(F.when(F.col("own") == 0, F.col("child")).otherwise(0)))
    return groups.groupBy("tag").agg(F.sum(failing).alias("failing_rows"))


def labelled(result: DataFrame, labels: Sequence[dict[str, str]]) -> DataFrame:
    """The label columns of each check before its count (a literal of one entry per check, no join)."""
    table = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in one.items()]) for one in labels])
    return result.select(F.element_at(table, F.col("tag") + 1).alias("l"), "failing_rows").select("l.*", "failing_rows")
