"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

The raw booking extracts are derived from the supplied tables (``roles``),
cleaned once per session and folder (``cleaned``), and every query reads
from those staged tables, so the work of every query grows with the data.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innflow.functions import normalize as N
from innflow.functions import vocab as V
from innflow.operators.dedup import COPIES, duplicate_keys, keep_first_narrow
from innflow.operators.keybits import BITMAP_MAX_BYTES
from innflow.operators.membership import Reference, with_parent_flags
from innflow.operators.quarantine import REASON, reject_summary
from innflow.operators.tagged import Reference as TaggedReference
from innflow.operators.tagged import failing_rows, labelled
from innflow.plans import history as H
from innflow.plans import marts as M
from innflow.plans.checks import MODEL_KEYS, spoiled
from innflow.plans.checks import contract_tests as _contract_tests
from innflow.plans.checks import warehouse_checks as _warehouse_checks
from innflow.plans.entities import KEYS, LOAD_ORDER, Cleaned, transform_all, transform_rooms
from innflow.plans.incremental import PAYMENTS, RESERVATIONS, refresh_marts, upsert
from innflow.plans.incremental import agg_property_performance as kept_property_performance
from innflow.plans.incremental import dim_guests as kept_guests
from innflow.plans.job import run_job
from innflow.plans.replay import replay
from innflow.plans.roles import RAW_BUILDERS, raw_entities, write_raw_extracts, write_uneven_rooms
from innflow.sources.files import file_stamp, read_raw_csv
from innflow.sources.staging import new_run_dir, stage
from innflow.sources.tables import Tables
from innflow.sources.versions import VersionedStore

_LOCK = threading.Lock()
_CLEANED: dict[tuple, Cleaned] = {}
_RAW: dict[tuple, dict[str, DataFrame]] = {}


def _memo_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Session, folder, and size and time of the supplied tables as their file system reports them (any scheme)."""
    stamps = tuple(file_stamp(spark, f"{sf_dir}/{n}.parquet") for n in ("nation", "region", "customer", "supplier", "orders", "lineitem"))
    return (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), stamps)


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = _memo_key(spark, sf_dir)
    with _LOCK:
        if key not in _RAW:
            _RAW[key] = raw_entities(Tables(spark, sf_dir))
        return _RAW[key]


def cleaned(spark: SparkSession, sf_dir: str) -> Cleaned:
    """The five cleaned entities for this folder, staged once per session."""
    key = _memo_key(spark, sf_dir)
    with _LOCK:
        if key not in _CLEANED:
            _CLEANED[key] = transform_all(raw_entities(Tables(spark, sf_dir)))
        return _CLEANED[key]


# --- 2.1 sources and sinks ----------------------------------------------------

def bronze_ingest_counts(spark, sf_dir):
    r = raw(spark, sf_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in r.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    total = out.agg(F.sum("row_count").cast("bigint").alias("row_count")).select(
        F.lit("total").alias("table_name"), "row_count")
    return out.unionByName(total)


def load_warehouse_counts(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    parts = [c[n].clean.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n in LOAD_ORDER]
    parts.append(c.rejects.agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit("rejected_records").alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quarantine_records(spark, sf_dir):
    return cleaned(spark, sf_dir).rejects.select("source_table", "raw_record", "rejection_reason")


# --- 2.2 normalisation --------------------------------------------------------

def normalize_guest_strings(spark, sf_dir):
    g = raw(spark, sf_dir)["guests"]
    return g.select(
        F.col("_seq").alias("seq"),
        F.col("guest_id").alias("raw_guest_id"),
        N.clean_str("first_name").alias("first_name"),
        N.clean_str("last_name").alias("last_name"),
        F.lower(N.clean_str("email")).alias("email"),
        N.clean_str("phone").alias("phone"),
        N.clean_str("country").alias("country"),
    )


def _text_values(spark, sf_dir, columns: dict[str, list[str]], fn: Callable, value_name: str) -> DataFrame:
    r = raw(spark, sf_dir)
    out = None
    for table, cols in columns.items():
        for c in cols:
            part = r[table].select(
                F.lit(f"{table}.{c}").alias("source_column"),
                F.col(c).alias("raw_text"),
                fn(c).alias(value_name),
            )
            out = part if out is None else out.unionByName(part)
    return out


def coerce_integer_ids(spark, sf_dir):
    cols = {"guests": ["guest_id"], "properties": ["property_id"], "rooms": ["room_id", "property_id", "capacity"],
            "reservations": ["guest_id", "property_id", "room_id"]}
    return _text_values(spark, sf_dir, cols, N.to_long, "value")


def coerce_amounts(spark, sf_dir):
    p = raw(spark, sf_dir)["payments"]
    d = N.to_double("amount")
    return p.select(
        F.col("amount").alias("raw_text"),
        d.isNotNull().alias("is_number"),
        (d < 0).alias("is_negative"),
        N.to_decimal("amount").alias("amount"),
    )


def standardize_booking_status(spark, sf_dir):
    r = raw(spark, sf_dir)["reservations"]
    return r.select(F.col("booking_status").alias("raw_text"), N.booking_status("booking_status").alias("status"))


def standardize_payment_status(spark, sf_dir):
    p = raw(spark, sf_dir)["payments"]
    return p.select(F.col("payment_status").alias("raw_text"), N.payment_status("payment_status").alias("status"))


def parse_flexible_dates(spark, sf_dir):
    cols = {"reservations": ["check_in_date", "check_out_date"]}
    return _text_values(spark, sf_dir, cols, N.parse_date, "parsed")


def parse_flexible_timestamps(spark, sf_dir):
    cols = {"reservations": ["booking_date"], "payments": ["payment_date"]}
    return _text_values(spark, sf_dir, cols, N.parse_timestamp, "parsed")


def _staging(name):
    def q(spark, sf_dir):
        return M.STAGING[name](warehouse_tables(cleaned(spark, sf_dir)))
    q.__name__ = name
    return q


# --- 2.3 quarantine -------------------------------------------------------------

def _rejects(name):
    def q(spark, sf_dir):
        return cleaned(spark, sf_dir)[name].rejects.select("source_table", "raw_record", "rejection_reason")
    q.__name__ = f"rejects_{name}"
    return q


def _clean(name):
    def q(spark, sf_dir):
        return cleaned(spark, sf_dir)[name].clean
    q.__name__ = f"clean_{name}"
    return q


# --- 2.4 joins -------------------------------------------------------------------

def _flagged(child: DataFrame, parents, large: bool = False, bitmaps: bool = False) -> DataFrame:
    """Membership flags of (parent, key, flag); ``large`` takes the path of parents too large to broadcast, with keys of
    more than ``FORCED_HOT_ROWS`` rows split, whatever the sizes are; ``bitmaps`` that of large parents with integer keys."""
    references = [Reference(key, parent.clean.select(key), flag, not large and parent.keys_small) for parent, key, flag in parents]
    if bitmaps:
        return with_parent_flags(child, [replace(r, small=False) for r in references])
    return with_parent_flags(child, references, hot_key_rows=FORCED_HOT_ROWS if large else None, bitmap_max_bytes=0 if large else BITMAP_MAX_BYTES)


FORCED_HOT_ROWS = 50


def _rooms_refs(spark, sf_dir, large=False, bitmaps=False):
    c = cleaned(spark, sf_dir)
    rooms = c.rooms.classified.select(F.col("_r_room_id").alias("raw_room_id"), "property_id", "_seq")
    return _flagged(rooms, [(c.properties, "property_id", "property_found")], large, bitmaps).drop("_seq")


def _reservations_refs(spark, sf_dir, large=False, bitmaps=False):
    c = cleaned(spark, sf_dir)
    r = c.reservations.classified.select(
        F.col("_r_reservation_id").alias("raw_reservation_id"), "guest_id", "property_id", "room_id", "_seq")
    return _flagged(r, [(c.guests, "guest_id", "guest_found"), (c.properties, "property_id", "property_found"),
                        (c.rooms, "room_id", "room_found")], large, bitmaps).drop("_seq")


def _payments_refs(spark, sf_dir, large=False):
    c = cleaned(spark, sf_dir)
    p = c.payments.classified.select(F.col("_r_payment_id").alias("raw_payment_id"), "reservation_id", "_seq")
    return _flagged(p, [(c.reservations, "reservation_id", "reservation_found")], large).drop("_seq")


def fk_rooms_property(spark, sf_dir):
    return _rooms_refs(spark, sf_dir)


def fk_reservations_any(spark, sf_dir):
    return _reservations_refs(spark, sf_dir)


def fk_payments_reservation(spark, sf_dir):
    return _payments_refs(spark, sf_dir)


def fk_rooms_property_large(spark, sf_dir):
    return _rooms_refs(spark, sf_dir, large=True)


def fk_reservations_any_large(spark, sf_dir):
    return _reservations_refs(spark, sf_dir, large=True)


def fk_payments_reservation_large(spark, sf_dir):
    return _payments_refs(spark, sf_dir, large=True)


def fk_rooms_property_bitmap(spark, sf_dir):
    return _rooms_refs(spark, sf_dir, bitmaps=True)


def fk_reservations_any_bitmap(spark, sf_dir):
    return _reservations_refs(spark, sf_dir, bitmaps=True)


def orphan_counts(spark, sf_dir):
    """Typed child rows (accepted or not) whose key has no surviving parent (NULL keys count)."""
    c = cleaned(spark, sf_dir)
    references = {
        "rooms.property_id": TaggedReference("rooms", "property_id", "kept properties", "property_id"),
        "reservations.guest_id": TaggedReference("reservations", "guest_id", "kept guests", "guest_id"),
        "reservations.property_id": TaggedReference("reservations", "property_id", "kept properties", "property_id"),
        "reservations.room_id": TaggedReference("reservations", "room_id", "kept rooms", "room_id"),
        "payments.reservation_id": TaggedReference("payments", "reservation_id", "kept reservations", "reservation_id"),
    }
    tables = {n: c[n].classified for n in ("rooms", "reservations", "payments")}
    tables.update({f"kept {n}": c[n].clean for n in ("properties", "rooms", "guests", "reservations")})
    counted = labelled(failing_rows(tables, list(references.values())), [{"relationship": name} for name in references])
    return counted.withColumnRenamed("failing_rows", "orphan_rows")


def rooms_per_property(spark, sf_dir):
    return M.rooms_per_property(warehouse_tables(cleaned(spark, sf_dir)))


# --- 2.5 aggregation and de-duplication -------------------------------------

def payments_per_reservation(spark, sf_dir):
    return M.payments_per_reservation(warehouse_tables(cleaned(spark, sf_dir)))


def guest_activity(spark, sf_dir):
    return M.guest_activity(warehouse_tables(cleaned(spark, sf_dir)))


def property_activity(spark, sf_dir):
    a = M.property_activity(warehouse_tables(cleaned(spark, sf_dir)))
    return a.select("property_id", "total_reservations", "completed_stays", "cancelled_reservations",
                    "no_show_reservations", "total_revenue",
                    M.half_up_avg("_nights_total", "_nights_n").alias("avg_nights_booked"))


def dedup_keep_first(spark, sf_dir):
    d = cleaned(spark, sf_dir).payments.deduplicated
    return d.select("payment_id", "reservation_id", "payment_date", "payment_method", "amount", "payment_status",
                    F.col(COPIES).alias("copies"))


def dedup_keep_first_narrow(spark, sf_dir):
    """Keep-first of payments where only rows whose key may repeat are moved."""
    c = cleaned(spark, sf_dir).payments
    kept = keep_first_narrow(c.accepted.select("payment_id", "reservation_id", "payment_date", "payment_method", "amount", "payment_status", "_seq"),
                             "payment_id", "_seq")
    return kept.withColumnRenamed(COPIES, "copies").drop("_seq")


def duplicate_counts(spark, sf_dir):
    """Row balance per table: raw = rejected + accepted, accepted = kept + duplicates_dropped."""
    c = cleaned(spark, sf_dir)
    out = None
    zero = F.lit(0).cast("bigint")
    for n in LOAD_ORDER:
        raw_rows = c[n].classified.select(
            F.lit(n).alias("table_name"), F.lit(1).cast("bigint").alias("raw"),
            F.col(REASON).isNotNull().cast("bigint").alias("rejected"), zero.alias("copies"), zero.alias("kept"))
        kept = c[n].deduplicated.select(
            F.lit(n).alias("table_name"), zero.alias("raw"), zero.alias("rejected"), F.col(COPIES).alias("copies"),
            F.lit(1).cast("bigint").alias("kept"))
        out = raw_rows.unionByName(kept) if out is None else out.unionByName(raw_rows).unionByName(kept)
    return out.groupBy("table_name").agg(
        F.sum("raw").alias("raw_rows"), F.sum("rejected").alias("rejected_rows"), F.sum("copies").alias("accepted_rows"),
        F.sum("kept").alias("kept_rows"), (F.sum("copies") - F.sum("kept")).alias("duplicates_dropped"))


def duplicate_keys_report(spark, sf_dir):
    """Keys that occur more than once among accepted rows, before keep-first."""
    c = cleaned(spark, sf_dir)
    out = None
    for n in LOAD_ORDER:
        key = KEYS[n]
        d = duplicate_keys(c[n].accepted, key).select(
            F.lit(n).alias("table_name"), F.col(key).cast("string").alias("key_text"), "occurrences")
        out = d if out is None else out.unionByName(d)
    return out


def reject_summary_q(spark, sf_dir):
    return reject_summary(cleaned(spark, sf_dir).rejects)


# --- 2.9 marts, 2.10 checks, 2.11 tests, 2.12 mess ------------------------------

def fct_reservations(spark, sf_dir):
    return M.fct_reservations(warehouse_tables(cleaned(spark, sf_dir)))


def dim_guests(spark, sf_dir):
    return M.dim_guests(warehouse_tables(cleaned(spark, sf_dir)))


def agg_property_performance(spark, sf_dir):
    return M.agg_property_performance(warehouse_tables(cleaned(spark, sf_dir)))


def warehouse_tables(c: Cleaned) -> dict[str, DataFrame]:
    return {n: c[n].clean for n in LOAD_ORDER}


def warehouse_checks(spark, sf_dir):
    return _warehouse_checks(warehouse_tables(cleaned(spark, sf_dir)))


def model_frames(w: M.Warehouse) -> dict[str, DataFrame]:
    """Staging views, and the marts as written tables (several tests read each)."""
    models = {name: fn(w) for name, fn in M.STAGING.items()}
    run_dir = new_run_dir(next(iter(w.values())).sparkSession)
    models.update({name: stage(fn(w), run_dir, name) for name, fn in M.MARTS.items()})
    return models


def warehouse_checks_spoiled(spark, sf_dir):
    """The same checks on tables where every one must fail (see ``spoiled``)."""
    tables = warehouse_tables(cleaned(spark, sf_dir))
    return _warehouse_checks({n: spoiled(df, KEYS[n]) for n, df in tables.items()})


def contract_tests_spoiled(spark, sf_dir):
    """The same model tests on models where every one must fail."""
    models = model_frames(warehouse_tables(cleaned(spark, sf_dir)))
    return _contract_tests({n: spoiled(df, MODEL_KEYS[n]) for n, df in models.items()})


def job_through_files(spark, sf_dir):
    """The whole job over CSV extracts: written warehouse rows (as text), quarantine reasons, marts and check counts."""
    folder = new_run_dir(spark)
    write_raw_extracts(Tables(spark, sf_dir), f"{folder}/raw")
    run_job(spark, f"{folder}/raw", f"{folder}/out")
    out = None
    places = {**{n: f"warehouse/{n}" for n in LOAD_ORDER}, **{n: f"marts/{n}" for n in M.MARTS}}
    for name, place in places.items():
        df = spark.read.parquet(f"{folder}/out/{place}").drop("loaded_at", COPIES)
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)])
        part = df.select(F.lit(name).alias("table_name"), row.alias("row_text"))
        out = part if out is None else out.unionByName(part)
    rejects = spark.read.parquet(f"{folder}/out/warehouse/rejected_records").select(
        F.lit("rejected_records").alias("table_name"), F.concat_ws("|", "source_table", "rejection_reason").alias("row_text"))
    checks = spark.read.parquet(f"{folder}/out/checks").select(
        F.lit("checks").alias("table_name"), F.concat_ws("|", "check", "status").alias("row_text"))
    return out.unionByName(rejects).unionByName(checks)


_STORES: dict[tuple, VersionedStore] = {}


def _in_deliveries(spark, sf_dir) -> VersionedStore:
    """Accepted bookings and payments in two deliveries, once per session: the second brings new rows, re-sent ones and later
    states of stored ones."""
    c, key = cleaned(spark, sf_dir), _memo_key(spark, sf_dir)
    with _LOCK:
        if key not in _STORES:
            _STORES[key] = _deliver(spark, c)
        return _STORES[key]


def _deliver(spark, c: Cleaned) -> VersionedStore:
    # arrival 4k is a booking, 4k + 1 its exact re-send, 4k + 2 a later state; every fifth booking arrives late
    bookings, late = c.reservations.accepted, (F.pmod("_seq", F.lit(4)) > 0) | (F.pmod(F.floor(F.col("_seq") / 4), F.lit(5)) == 3)
    payments, later = c.payments.accepted, F.pmod(F.col("_seq.partkey"), F.lit(3)) == 0
    store = VersionedStore(spark, new_run_dir(spark))
    for first in (True, False):
        draft = store.begin()
        booked = upsert(draft, RESERVATIONS, bookings.where(~late if first else late))
        paid = upsert(draft, PAYMENTS, payments.where(~later if first else later))
        refresh_marts(draft, booked.changes, paid.changes)
        draft.publish()
    return store


def upsert_two_deliveries(spark, sf_dir):
    """Bookings after two upserts: per id the accepted row of the latest booking date (then arrival)."""
    return _in_deliveries(spark, sf_dir).read("reservations")


def incremental_property_performance(spark, sf_dir):
    """The property mart from states that two deliveries have merged."""
    c = cleaned(spark, sf_dir)
    return kept_property_performance(_in_deliveries(spark, sf_dir), c.properties.clean, c.rooms.clean)


def incremental_guests(spark, sf_dir):
    """The guest dimension from states that two deliveries have merged."""
    return kept_guests(_in_deliveries(spark, sf_dir), cleaned(spark, sf_dir).guests.clean)


_HISTORIES: dict[tuple, VersionedStore] = {}
# moments of the four snapshots, and the date of the mart as it was between the last two
SNAPSHOT_MOMENTS = ("1992-01-01 00:00:00", "1994-07-01 00:00:00", "1996-07-01 00:00:00", "1997-07-01 00:00:00")
MART_MOMENT = "1996-12-31 00:00:00"


def _snapshot(name: str, df: DataFrame, n: int) -> DataFrame:
    """State n (1 to 4) of a dimension: some rows open late, change, change back, close for a time."""
    key = F.col(KEYS[name])
    if name == "properties":
        renamed = F.when((key % 3 == 1) & F.lit(n in (2, 3)), F.concat("property_name", F.lit(" & Spa"))).otherwise(F.col("property_name"))
        moved = F.when((key % 4 == 2) & F.lit(n >= 3), F.lit(None).cast("string")).otherwise(F.col("city"))
        df = df.withColumn("property_name", renamed).withColumn("city", moved)
        return df.where(key % 5 != 4) if n == 1 else df.where(key % 7 != 3) if n == 3 else df
    larger = F.when(key % 3 == 1, F.col("capacity") + F.lit(min(n, 3) - 1)).otherwise(F.col("capacity")).cast("smallint")
    return (df.where(key % 11 != 5) if n == 3 else df).withColumn("capacity", larger)


def _histories(spark, sf_dir) -> VersionedStore:
    """Histories of properties and rooms after four snapshots, once per session; each snapshot is one version."""
    c, key = cleaned(spark, sf_dir), _memo_key(spark, sf_dir)
    with _LOCK:
        if key not in _HISTORIES:
            store = VersionedStore(spark, new_run_dir(spark))
            for n, moment in enumerate(SNAPSHOT_MOMENTS, 1):
                draft = store.begin()
                for dim in (H.PROPERTIES, H.ROOMS):
                    H.advance(draft, dim, _snapshot(dim.name, c[dim.name].clean, n), moment)
                draft.publish()
            _HISTORIES[key] = store
        return _HISTORIES[key]


def property_history(spark, sf_dir):
    return H.history(_histories(spark, sf_dir), H.PROPERTIES)


def room_history(spark, sf_dir):
    return H.history(_histories(spark, sf_dir), H.ROOMS)


def _bookings_as_of(spark, sf_dir, **limits):
    store = _histories(spark, sf_dir)
    r = cleaned(spark, sf_dir).reservations.clean.select("reservation_id", "property_id", "room_id", "booking_date")
    r = H.as_of_join(r, H.history(store, H.PROPERTIES), "property_id", "booking_date", {"property_name": "property_name", "city": "city"}, **limits)
    return H.as_of_join(r, H.history(store, H.ROOMS), "room_id", "booking_date", {"room_type": "room_type", "capacity": "capacity"}, **limits)


def bookings_as_of(spark, sf_dir):
    """Every booking with its property and room as they were when it was made."""
    return _bookings_as_of(spark, sf_dir)


def bookings_as_of_large(spark, sf_dir):
    """The same on the path of dimensions too large to broadcast, with hot (key, year) groups split."""
    return _bookings_as_of(spark, sf_dir, broadcast_rows=0, hot_rows=FORCED_HOT_ROWS)


def property_performance_as_of(spark, sf_dir):
    return H.performance_as_of(_histories(spark, sf_dir), warehouse_tables(cleaned(spark, sf_dir)), MART_MOMENT)


def _as_text(name: str, df: DataFrame) -> DataFrame:
    """``table_name, row_text``: all values of a row in the order of the column names."""
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)])
    return df.select(F.lit(name).alias("table_name"), row.alias("row_text"))


def _arrives_late(name: str):
    """Rows of the second delivery: some properties, rooms, guests and bookings, so that children wait at every level."""
    return {"properties": F.pmod("_seq", F.lit(3)) == 1, "rooms": F.pmod("_seq", F.lit(6)) == 4, "guests": F.pmod("_seq", F.lit(5)) == 2,
            "reservations": F.pmod("_seq", F.lit(7)) == 3}.get(name, F.lit(False))


def replay_late_parents(spark, sf_dir):
    """Clean tables and quarantine after orphans of a first delivery were replayed with the parents of a second."""
    extracts = raw(spark, sf_dir)
    first = transform_all({n: df.where(~_arrives_late(n)) for n, df in extracts.items()})
    c = replay(first, {n: extracts[n].where(_arrives_late(n)) for n in ("properties", "rooms", "guests", "reservations")})
    out = None
    for n in LOAD_ORDER:
        part = _as_text(n, c[n].clean)
        out = part if out is None else out.unionByName(part)
    return out.unionByName(c.rejects.select(
        F.lit("rejected_records").alias("table_name"),
        F.concat_ws("|", "source_table", "rejection_reason", "raw_record").alias("row_text")))


def quarantine_malformed_rows(spark, sf_dir):
    """Rooms through a CSV extract some of whose rows have a field too many or too few: kept rows, and the malformed text."""
    folder = new_run_dir(spark)
    write_uneven_rooms(raw(spark, sf_dir)["rooms"], f"{folder}/raw/rooms")
    rooms = transform_rooms(read_raw_csv(spark, f"{folder}/raw", "rooms"), cleaned(spark, sf_dir).properties)
    malformed = rooms.rejects.where(F.col("rejection_reason") == V.R_MALFORMED).select(
        F.lit("malformed").alias("table_name"), F.get_json_object("raw_record", "$.malformed_row").alias("row_text"))
    return _as_text("rooms", rooms.clean).unionByName(malformed)


def contract_tests(spark, sf_dir):
    return _contract_tests(model_frames(warehouse_tables(cleaned(spark, sf_dir))))


def inject_mess_reservations(spark, sf_dir):
    return RAW_BUILDERS["reservations"](Tables(spark, sf_dir)).withColumnRenamed("_seq", "seq")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_ingest_counts": bronze_ingest_counts,
    "load_warehouse_counts": load_warehouse_counts,
    "quarantine_records": quarantine_records,
    "normalize_guest_strings": normalize_guest_strings,
    "coerce_integer_ids": coerce_integer_ids,
    "coerce_amounts": coerce_amounts,
    "standardize_booking_status": standardize_booking_status,
    "standardize_payment_status": standardize_payment_status,
    "parse_flexible_dates": parse_flexible_dates,
    "parse_flexible_timestamps": parse_flexible_timestamps,
    **{name: _staging(name) for name in M.STAGING},
    **{f"rejects_{n}": _rejects(n) for n in ("guests", "properties", "rooms", "reservations", "payments")},
    **{f"clean_{n}": _clean(n) for n in ("guests", "properties", "rooms", "reservations", "payments")},
    "fk_rooms_property": fk_rooms_property,
    "fk_reservations_any": fk_reservations_any,
    "fk_payments_reservation": fk_payments_reservation,
    "fk_rooms_property_large": fk_rooms_property_large,
    "fk_reservations_any_large": fk_reservations_any_large,
    "fk_payments_reservation_large": fk_payments_reservation_large,
    "fk_rooms_property_bitmap": fk_rooms_property_bitmap,
    "fk_reservations_any_bitmap": fk_reservations_any_bitmap,
    "orphan_counts": orphan_counts,
    "rooms_per_property": rooms_per_property,
    "payments_per_reservation": payments_per_reservation,
    "guest_activity": guest_activity,
    "property_activity": property_activity,
    "dedup_keep_first": dedup_keep_first,
    "dedup_keep_first_narrow": dedup_keep_first_narrow,
    "duplicate_counts": duplicate_counts,
    "duplicate_keys": duplicate_keys_report,
    "reject_summary": reject_summary_q,
    "fct_reservations": fct_reservations,
    "dim_guests": dim_guests,
    "agg_property_performance": agg_property_performance,
    "warehouse_checks": warehouse_checks,
    "contract_tests": contract_tests,
    "warehouse_checks_spoiled": warehouse_checks_spoiled,
    "contract_tests_spoiled": contract_tests_spoiled,
    "job_through_files": job_through_files,
    "upsert_two_deliveries": upsert_two_deliveries,
    "incremental_property_performance": incremental_property_performance,
    "incremental_guests": incremental_guests,
    "property_history": property_history,
    "room_history": room_history,
    "bookings_as_of": bookings_as_of,
    "bookings_as_of_large": bookings_as_of_large,
    "property_performance_as_of": property_performance_as_of,
    "replay_late_parents": replay_late_parents,
    "quarantine_malformed_rows": quarantine_malformed_rows,
    "inject_mess_reservations": inject_mess_reservations,
}
