"""Ordered quarantine rules: first matching rule names the one reason of a row.

A rule list becomes a single CASE WHEN column, so the whole rule set is one
projection inside whole-stage codegen; accepted and rejected rows are two
filters over the same classified frame (no row ever fails the batch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reason"
SEQ = "_seq"


@dataclass(frozen=True)
class Rule:
    """Row is rejected with ``reason`` when ``predicate`` is true (NULL counts as false)."""

    name: str
    predicate: Column
    reason: str


def reason_column(rules: Sequence[Rule]) -> Column:
    """CASE WHEN r1 THEN reason1 WHEN r2 THEN reason2 ... END (first match wins)."""
    if not rules:
        return F.lit(None).cast("string")
    expr = F.when(rules[0].predicate, F.lit(rules[0].reason))
    for r in rules[1:]:
        expr = expr.when(r.predicate, F.lit(r.reason))
    return expr


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the ``_reason`` column (NULL = accepted)."""
    return df.withColumn(REASON, reason_column(rules))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull())


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNotNull())


def contract_rules(limits: dict[str, int], not_null: Sequence[str] = (), prefix: str = "") -> list[Rule]:
    """Write-time contract of the warehouse table: NOT NULL columns and VARCHAR lengths."""
    out = [Rule(f"contract_{c}_null", F.col(c).isNull(), f"{prefix}{c}") for c in not_null]
    out += [Rule(f"contract_{c}_len", F.length(F.col(c)) > n, f"{prefix}{c}") for c, n in limits.items()]
    return out


def reject_summary(rejects: DataFrame) -> DataFrame:
    """Rejected rows per table and reason, largest first (the audit query)."""
    return (
        rejects.groupBy("source_table", "rejection_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        .orderBy(F.desc("rejected_rows"), "source_table", "rejection_reason")
    )
