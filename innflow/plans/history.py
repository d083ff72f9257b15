"""Properties and rooms as slowly changing dimensions: every state of a row with the time it was valid.

A delivery is a snapshot of a dimension (one row per key) and the moment from which it holds.  ``advance`` compares
row hashes with the open rows: a changed or missing row is closed at that moment, a new or changed one is
opened.  Intervals are half open (``valid_from <= t < valid_to``, an open row has no ``valid_to``), so those of one key never
overlap; a key that goes and comes back has a gap.

Stored in a versioned store as two tables: ``<name>_open``, dealt over parts by a hash of the key, of
which a delivery writes only parts that change, and ``<name>_closed``, to which a delivery adds
one part of its own and which is never written again.  Reading a date skips the closed parts that ended before it.

``as_of_join`` gives every fact the state of its key that was valid at the fact's own time.  Defined results: facts
without a key or time, and those no state covers, get nulls; repeated facts stay; columns of the facts keep their names, so
columns to be added must not clash (an error).  Null values in a dimension's columns are values like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.operators.membership import BROADCAST_MAX_ROWS, HOT_KEY_ROWS, broadcast_if_small, has_at_most
from innflow.plans import marts as M
from innflow.plans.entities import CLEAN_SCHEMAS, KEYS
from innflow.sources.staging import new_run_dir, stage
from innflow.sources.versions import Draft, Version, VersionedStore

OPEN_PARTS = 64
MOMENT = "timestamp_ntz"


@dataclass(frozen=True)
class Dimension:
    name: str

    @property
    def key(self) -> str:
        return KEYS[self.name]

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in CLEAN_SCHEMAS[self.name]]

    @property
    def open(self) -> str:
        return f"{self.name}_open"

    @property
    def closed(self) -> str:
        return f"{self.name}_closed"


PROPERTIES, ROOMS = Dimension("properties"), Dimension("rooms")


@dataclass
class AdvanceReport:
    new: int
    changed: int
    gone: int
    unchanged: int
    parts_written: list[str]


def _moments(draft_or_version, dim: Dimension) -> list[str]:
    return draft_or_version.state.get(f"{dim.name}_moments", [])


def advance(draft: Draft, dim: Dimension, snapshot: DataFrame, moment: str, complete: bool = True) -> AdvanceReport:
    """Bring the history to ``moment`` (``yyyy-MM-dd HH:mm:ss``, later than every earlier one).

    A complete snapshot closes the rows of keys it lacks; of a partial one missing keys stay as they are.  ``snapshot`` has
    one row per non-null key, as keep-first tables do.
    """
    before = _moments(draft, dim)
    if before and moment <= before[-1]:
        raise ValueError(f"{dim.name}: {moment} is not after {before[-1]}")
    spark, store, key, cols = snapshot.sparkSession, draft.store, dim.key, dim.columns
    run_dir, at = new_run_dir(spark), F.lit(moment).cast(MOMENT)
    part = F.pmod(F.xxhash64(key), F.lit(draft.state.setdefault("open_parts", OPEN_PARTS))).cast("string")
    row_hash = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    incoming = snapshot.select(*cols).withColumn("_hash", row_hash)
    if dim.open in draft.tables:
        touched = None if complete else [r["p"] for r in incoming.select(part.alias("p")).distinct().collect()]  # at most open_parts
        old = store.read(dim.open, Version(draft.parent.number, draft.tables, draft.state), touched)
    else:
        old = incoming.where("false").withColumn("valid_from", at).select(*cols, "valid_from", "_hash")
    a = incoming.select(F.struct(*cols, "_hash").alias("now"), F.col(key).alias("_now_key"))
    b = old.select(F.struct(*cols, "_hash").alias("was"), F.col(key).alias("_was_key"), "valid_from")
    kind = (F.when(F.col("_was_key").isNull(), "new").when(F.col("_now_key").isNull(), "gone" if complete else "unchanged")
            .when(F.col("now._hash") == F.col("was._hash"), "unchanged").otherwise("changed"))
    met = a.join(b, F.col("_now_key") == F.col("_was_key"), "full").withColumn("_kind", kind).withColumn(
        key, F.coalesce("_now_key", "_was_key")).withColumn("_part", part)
    judged = stage(met, run_dir, "judged")
    counts = {r["_kind"]: r["count"] for r in judged.groupBy("_kind").count().collect()}

    ended = judged.where("_kind in ('changed', 'gone')").select(*[F.col(f"was.{c}").alias(c) for c in cols], "valid_from", at.alias("valid_to"))
    number = str(len(before) + 1)
    draft.write_parts(dim.closed, ended.withColumn("_delivery", F.lit(number)), "_delivery", replaced=[number])

    parts = [r["_part"] for r in judged.where("_kind <> 'unchanged'").select("_part").distinct().collect()]  # at most open_parts
    stays = judged.where((F.col("_kind") == "unchanged") & F.col("_part").isin(parts)).select(
        *[F.col(f"was.{c}").alias(c) for c in cols], "valid_from", F.col("was._hash").alias("_hash"), "_part")
    opened = judged.where("_kind in ('new', 'changed')").select(
        *[F.col(f"now.{c}").alias(c) for c in cols], at.alias("valid_from"), F.col("now._hash").alias("_hash"), "_part")
    written = draft.write_parts(dim.open, stays.unionByName(opened).repartition("_part"), "_part", replaced=parts)
    draft.state[f"{dim.name}_moments"] = [*before, moment]
    return AdvanceReport(*(counts.get(k, 0) for k in ("new", "changed", "gone", "unchanged")), written)


def history(store: VersionedStore, dim: Dimension, version: Version | None = None, after: str | None = None) -> DataFrame:
    """All states with ``valid_from`` and ``valid_to``; with ``after`` only those that ended later than it."""
    version = version or store.current()
    ends = {str(i + 1): m for i, m in enumerate(_moments(version, dim))}
    parts = [n for n, m in ends.items() if after is None or m > after]
    still = store.read(dim.open, version).drop("_hash").withColumn("valid_to", F.lit(None).cast(MOMENT))
    return still.unionByName(store.read(dim.closed, version, parts))


def valid_at(store: VersionedStore, dim: Dimension, moment: str, version: Version | None = None) -> DataFrame:
    """The dimension's rows as they were at ``moment``."""
    at = F.lit(moment).cast(MOMENT)
    return history(store, dim, version, after=moment).where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))).select(*dim.columns)


def as_of_join(facts: DataFrame, states: DataFrame, key: str, at: str, add: dict[str, str], broadcast_rows: int = BROADCAST_MAX_ROWS,
               hot_rows: int = HOT_KEY_ROWS, run_dir: str | None = None) -> DataFrame:
    """``facts`` and, from the state of ``key`` valid at the fact's ``at``, the columns ``add`` (name in states -> new name).

    States counted at most ``broadcast_rows`` are broadcast.  Beyond it, facts and states meet by (key, year): a state is
    repeated for the years it covers within those of the facts, so a fact is compared with the states of its year only; a (key, year) of more than
    ``hot_rows`` facts is split by row number over ceil(n / hot_rows) parts and its states are repeated for each.  The facts are written first, so
    that their row numbers stand when a task is run again.
    """
    clash = sorted(set(add.values()) & set(facts.columns))
    if clash:
        raise ValueError(f"columns {clash} occur in the facts already")
    names = list(add.values())
    v = states.select(F.col(key).alias("_v_key"), F.col("valid_from").alias("_v_from"), F.col("valid_to").alias("_v_to"),
                      *[F.col(c).alias(n) for c, n in add.items()])
    covers = (F.col(at) >= F.col("_v_from")) & (F.col("_v_to").isNull() | (F.col(at) < F.col("_v_to")))
    if has_at_most(v, broadcast_rows):
        return facts.join(F.broadcast(v), (F.col(key) == F.col("_v_key")) & covers, "left").select(*facts.columns, *names)
    run_dir = run_dir or new_run_dir(facts.sparkSession)
    rows = stage(facts.withColumn("_f_row", F.monotonically_increasing_id()).withColumn("_f_year", F.year(at)), run_dir, f"facts_{key}")
    meets = F.col(key).isNotNull() & F.col("_f_year").isNotNull()
    span = rows.where(meets).agg(F.min("_f_year").alias("lo"), F.max("_f_year").alias("hi")).first()
    without = rows.where(~meets).select(*facts.columns, *[F.lit(None).cast(v.schema[n].dataType).alias(n) for n in names])
    if span["lo"] is None:
        return without
    hot = rows.where(meets).groupBy(F.col(key).alias("_h_key"), F.col("_f_year").alias("_h_year")).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > hot_rows).select("_h_key", "_h_year", F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_split"))
    hot = broadcast_if_small(stage(hot, run_dir, f"hot_{key}"))
    split = F.coalesce("_split", F.lit(1))
    first = F.greatest(F.year("_v_from"), F.lit(span["lo"]))
    last = F.least(F.coalesce(F.year("_v_to"), F.lit(span["hi"])), F.lit(span["hi"]))
    yearly = v.where(first <= last).withColumn("_v_year", F.explode(F.sequence(first, last)))
    yearly = yearly.join(hot, (F.col("_v_key") == F.col("_h_key")) & (F.col("_v_year") == F.col("_h_year")), "left").select(
        *v.columns, "_v_year", F.explode(F.sequence(F.lit(0), split - 1)).alias("_v_part"))
    dealt = rows.where(meets).join(hot, (F.col(key) == F.col("_h_key")) & (F.col("_f_year") == F.col("_h_year")), "left").select(
        *facts.columns, "_f_year", F.pmod(F.xxhash64("_f_row"), split).cast("int").alias("_f_part"))
    met = dealt.join(yearly, (F.col(key) == F.col("_v_key")) & (F.col("_f_year") == F.col("_v_year")) & (F.col("_f_part") == F.col("_v_part")) & covers, "left")
    return met.select(*facts.columns, *names).unionByName(without)


def performance_as_of(store: VersionedStore, warehouse: M.Warehouse, moment: str) -> DataFrame:
    """The property mart of a date: properties and rooms valid then, bookings and payments dated up to it."""
    at = F.lit(moment).cast(MOMENT)
    return M.agg_property_performance({
        "properties": valid_at(store, PROPERTIES, moment), "rooms": valid_at(store, ROOMS, moment),
        "reservations": warehouse["reservations"].where(F.col("booking_date") <= at),
        "payments": warehouse["payments"].where(F.col("payment_date") <= at)})
