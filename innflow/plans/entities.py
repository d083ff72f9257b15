"""Per-entity cleaning jobs: normalise -> flag references -> classify -> split -> keep-first.

Each ``transform_*`` is a pure function of DataFrames.  Children are checked
against the keys that survived the parent's rules and de-duplication
(rooms -> properties; reservations -> guests, properties, rooms;
payments -> reservations), so a rejected parent cascades to its children.

Plan shape per entity: staged projections for the normalisation, one left
join per foreign key (broadcast when the parent is proven small, else a
shuffle join over the child written once, with hot keys split), one CASE WHEN for the reason,
then one write of the classified table (the lineage cut both outputs read
from), and one aggregate for keep-first (partial + final), also written once.
Raw text travels through the joins; typed columns that no join needs are
computed after them, so shuffles carry the raw row once.  Dates are parsed in two projections (rewritten text, then the
time it denotes), so that the text is matched once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.functions import normalize as N
from innflow.functions import vocab as V
from innflow.operators.dedup import keep_first
from innflow.operators.membership import BROADCAST_MAX_ROWS, Reference, with_parent_flags
from innflow.operators.quarantine import REASON, SEQ, Rule, accepted, classify, contract_rules, rejected
from innflow.plans.roles import RAW_COLUMNS
from innflow.sources.files import MALFORMED
from innflow.sources.staging import new_run_dir, stage, stage_at

CLEAN_SCHEMAS = {
    "guests": [("guest_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
               ("email", "string"), ("phone", "string"), ("country", "string")],
    "properties": [("property_id", "bigint"), ("property_name", "string"), ("city", "string"),
                   ("country", "string")],
    "rooms": [("room_id", "bigint"), ("property_id", "bigint"), ("room_type", "string"),
              ("capacity", "smallint")],
    "reservations": [("reservation_id", "string"), ("guest_id", "bigint"), ("property_id", "bigint"),
                     ("room_id", "bigint"), ("check_in_date", "date"), ("check_out_date", "date"),
                     ("booking_status", "string"), ("booking_date", "timestamp_ntz")],
    "payments": [("payment_id", "string"), ("reservation_id", "string"), ("payment_date", "timestamp_ntz"),
                 ("payment_method", "string"), ("amount", V.AMOUNT_TYPE), ("payment_status", "string")],
}
KEYS = {"guests": "guest_id", "properties": "property_id", "rooms": "room_id",
        "reservations": "reservation_id", "payments": "payment_id"}
LOAD_ORDER = ("properties", "rooms", "guests", "reservations", "payments")
RAW_RECORD = "raw_record"


def _r(c: str) -> Column:
    """The raw text of column ``c``."""
    return F.col(f"_r_{c}")


def _long(c: str) -> Column:
    """bigint from the stripped text ``_t_<c>``; only text that is no plain integer is held against the number pattern."""
    return N.to_long(f"_t_{c}", stripped=True)


def _str(c: str) -> Column:
    return N.clean_str(f"_t_{c}", stripped=True)


@dataclass
class EntityResult:
    """Outputs of one entity job, all read from one staged classified table.

    ``classified`` holds per raw row: the typed columns, ``_reason`` (NULL =
    accepted), ``_seq``, the raw text of the key (``_r_<key>``) and, for
    rejected rows only, the raw row as JSON (``raw_record``).
    """

    name: str
    raw: DataFrame
    classified: DataFrame
    parent_small: dict = field(default_factory=dict)
    run_dir: str | None = None
    kept_path: str | None = None  # where the keep-first table goes (default: <run_dir>/<name>_kept)

    @property
    def key(self) -> str:
        return KEYS[self.name]

    @cached_property
    def accepted(self) -> DataFrame:
        return accepted(self.classified)

    @cached_property
    def deduplicated(self) -> DataFrame:
        """Keep-first survivors with ``_copies`` (accepted rows that shared the key), staged once.

        Every downstream consumer (children's reference checks, marts, checks,
        model tests) reads this small table instead of re-running the aggregate.
        """
        cols = [c for c, _ in CLEAN_SCHEMAS[self.name]]
        first = keep_first(self.accepted.select(*cols, SEQ), self.key, SEQ, payload=cols)
        if self.run_dir is None and self.kept_path is None:
            return first
        first = first.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
        return stage_at(first, self.kept_path or f"{self.run_dir}/{self.name}_kept")

    @cached_property
    def clean(self) -> DataFrame:
        """The typed warehouse table (one row per key)."""
        return self.deduplicated.select(*[F.col(c).cast(t).alias(c) for c, t in CLEAN_SCHEMAS[self.name]])

    @cached_property
    def rejects(self) -> DataFrame:
        """source_table, raw_record (original text as JSON), rejection_reason, _seq (arrival order as text)."""
        return rejected(self.classified).select(
            F.lit(self.name).alias("source_table"),
            F.col(RAW_RECORD),
            F.col(REASON).alias("rejection_reason"),
            F.col(SEQ).cast("string").alias(SEQ),
        )

    @cached_property
    def row_count(self) -> int:
        """Raw rows of the entity (from the staged parquet footers, no scan)."""
        return self.classified.count()

    @cached_property
    def keys_small(self) -> bool:
        """Proven bound for broadcasting this entity's key set: keys <= raw rows <= the limit."""
        return self.row_count <= BROADCAST_MAX_ROWS


def _result(name: str, raw: DataFrame, classified: DataFrame, smalls: dict, run_dir: str) -> EntityResult:
    """The run folder the classified table went to also receives the keep-first table."""
    return EntityResult(name, raw, classified, smalls, run_dir)


def _run_dir(raw: DataFrame, run_dir: str | None) -> str:
    return run_dir or new_run_dir(raw.sparkSession)


def _prepare(raw: DataFrame, name: str, numeric: Sequence[str] = ()) -> DataFrame:
    """Header normalisation, then per raw column: ``_r_<c>`` raw text and ``_t_<c>`` stripped text;
    ``_n_<c>`` number-gated doubles for ``numeric`` columns.  Three projections, so each
    sub-expression is evaluated once per row."""
    raw = raw.toDF(*N.normalize_header(raw.columns))
    raw = _spread(raw)
    cols = RAW_COLUMNS[name]
    missing = [c for c in cols if c not in raw.columns]
    if missing:
        raise ValueError(f"{name}: raw extract lacks columns {missing}")
    whole = [MALFORMED] if MALFORMED in raw.columns else []
    r = raw.select(*[F.col(c).cast("string").alias(f"_r_{c}") for c in cols], F.col(SEQ), *whole)
    r = r.select("*", *[N.strip_text(f"_r_{c}").alias(f"_t_{c}") for c in cols])
    if numeric:
        r = r.select("*", *[N.number_text(f"_t_{c}", stripped=True).alias(f"_n_{c}") for c in numeric])
    return r


def _spread(raw: DataFrame) -> DataFrame:
    """Local runs read extracts of one file (one split): there ``spark.innflow.localSpread`` names the tasks to spread rows over.

    Only ``local_session`` sets it; on a cluster the scan's own splits stand.
    """
    tasks = raw.sparkSession.conf.get("spark.innflow.localSpread", None)
    return raw.repartition(int(tasks)) if tasks else raw


def _contract(name: str, not_null: Sequence[str] = ()) -> list[Rule]:
    """NOT NULL and length rules, then the INTEGER range of every id column (all bigint columns of the typed table)."""
    ids = [c for c, t in CLEAN_SCHEMAS[name] if t == "bigint"]
    return contract_rules(V.VARCHAR_LIMITS[name], not_null, prefix=V.CONTRACT_PREFIX) + [
        Rule(f"C_{c}", ~F.col(c).between(V.INTEGER_MIN, V.INTEGER_MAX), V.CONTRACT_PREFIX + c) for c in ids]


def _finish(df: DataFrame, name: str, rules: list[Rule], typed: dict[str, Column],
            run_dir: str | None, extra: dict[str, Column] | None = None) -> DataFrame:
    """Typed columns, reason, then one staged write: typed columns, reason, seq, raw key text,
    and the raw row as JSON for rejected rows only."""
    df = df.select("*", *[c.alias(n) for n, c in typed.items() if n not in df.columns])
    malformed = MALFORMED in df.columns
    if malformed:  # before all other rules: its fields may stand in the wrong columns
        rules = [Rule("S1", F.col(MALFORMED).isNotNull(), V.R_MALFORMED), *rules]
    df = classify(df, rules)
    if extra:
        df = df.select("*", *[c.alias(n) for n, c in extra.items()])
    # raw text is kept whole only where it is needed: as JSON on rejected rows
    raw_json = F.to_json(F.struct(*[_r(c).alias(c) for c in RAW_COLUMNS[name]]), {"ignoreNullFields": "false"})
    if malformed:
        raw_json = F.when(F.col(MALFORMED).isNotNull(), F.to_json(F.struct(F.col(MALFORMED).alias("malformed_row")))).otherwise(raw_json)
    df = df.select(
        *[c for c, _ in CLEAN_SCHEMAS[name]], REASON, SEQ, f"_r_{KEYS[name]}",
        F.when(F.col(REASON).isNotNull(), raw_json).alias(RAW_RECORD),
    )
    return stage(df, run_dir, name)


def transform_guests(raw: DataFrame, run_dir: str | None = None) -> EntityResult:
    run_dir = _run_dir(raw, run_dir)
    r = _prepare(raw, "guests")
    typed = {
        "guest_id": _long("guest_id"),
        "first_name": _str("first_name"),
        "last_name": _str("last_name"),
        "email": F.lower(_str("email")),
        "phone": _str("phone"),
        "country": _str("country"),
    }
    rules = [
        Rule("R1", F.col("guest_id").isNull(), V.R_GUEST_ID),
        Rule("R2", F.col("first_name").isNull() | F.col("last_name").isNull(), V.R_GUEST_NAME),
        *_contract("guests"),
    ]
    return _result("guests", raw, _finish(r, "guests", rules, typed, run_dir), {}, run_dir)


def transform_properties(raw: DataFrame, run_dir: str | None = None) -> EntityResult:
    run_dir = _run_dir(raw, run_dir)
    r = _prepare(raw, "properties")
    typed = {
        "property_id": _long("property_id"),
        "property_name": _str("property_name"),
        "city": _str("city"),
        "country": _str("country"),
    }
    rules = [
        Rule("R3", F.col("property_id").isNull(), V.R_PROPERTY_ID),
        *_contract("properties", not_null=["property_name"]),
    ]
    return _result("properties", raw, _finish(r, "properties", rules, typed, run_dir), {}, run_dir)


def transform_rooms(raw: DataFrame, properties: EntityResult, run_dir: str | None = None) -> EntityResult:
    run_dir = _run_dir(raw, run_dir)
    r = _prepare(raw, "rooms")
    r = r.withColumn("property_id", _long("property_id"))
    small = properties.keys_small
    r = with_parent_flags(r, [Reference("property_id", properties.clean.select("property_id"), "_property_ok", small)],
                          run_dir=run_dir)
    typed = {
        "room_id": _long("room_id"),
        "room_type": _str("room_type"),
        "capacity": _long("capacity"),
    }
    rules = [
        Rule("R4", F.col("room_id").isNull() | F.col("property_id").isNull() | F.col("capacity").isNull()
             | (F.col("capacity") <= 0), V.R_ROOM_FIELDS),
        Rule("R5", ~F.col("_property_ok"), V.R_ROOM_PROPERTY),
        *_contract("rooms", not_null=["room_type"]),
        Rule("C_capacity", F.col("capacity") > V.SMALLINT_MAX, V.CONTRACT_PREFIX + "capacity"),
    ]
    return _result("rooms", raw, _finish(r, "rooms", rules, typed, run_dir), {"properties": small}, run_dir)


def transform_reservations(
    raw: DataFrame, guests: EntityResult, properties: EntityResult, rooms: EntityResult,
    run_dir: str | None = None,
) -> EntityResult:
    run_dir = _run_dir(raw, run_dir)
    r = _prepare(raw, "reservations").select(
        "*",
        _long("guest_id").alias("guest_id"),
        _long("property_id").alias("property_id"),
        _long("room_id").alias("room_id"),
    )
    parents = ((properties, "property_id", "_property_ok"), (rooms, "room_id", "_room_ok"), (guests, "guest_id", "_guest_ok"))
    smalls = {parent.name: parent.keys_small for parent, _, _ in parents}
    r = with_parent_flags(r, [Reference(key, parent.clean.select(key), flag, smalls[parent.name]) for parent, key, flag in parents],
                          run_dir=run_dir)
    r = r.select(
        "*",
        N.rewritten_date("_t_check_in_date", stripped=True).alias("_w_check_in_date"),
        N.rewritten_date("_t_check_out_date", stripped=True).alias("_w_check_out_date"),
        N.rewritten_timestamp("_t_booking_date", stripped=True).alias("_w_booking_date"),
    )
    typed = {
        "reservation_id": _str("reservation_id"),
        "_check_in_ts": N.parse_date("_t_check_in_date", rewritten="_w_check_in_date"),
        "_check_out_ts": N.parse_date("_t_check_out_date", rewritten="_w_check_out_date"),
        "booking_status": N.booking_status("_t_booking_status", stripped=True),
        "booking_date": N.parse_timestamp("_t_booking_date", rewritten="_w_booking_date"),
    }
    required = ["reservation_id", "guest_id", "property_id", "room_id", "_check_in_ts", "booking_date"]
    rules = [
        Rule("R6", _any_null(required), V.R_REQUIRED),
        Rule("R7", ~F.col("_guest_ok") | ~F.col("_property_ok") | ~F.col("_room_ok"), V.R_RES_REFERENCE),
        Rule("R8", F.col("_check_out_ts").isNotNull() & (F.col("_check_out_ts") < F.col("_check_in_ts")),
             V.R_DATES),
        Rule("R9", F.col("booking_status") == V.UNKNOWN_STATUS, V.R_BOOKING_STATUS),
        *_contract("reservations"),
    ]
    dates = {
        "check_in_date": F.col("_check_in_ts").cast("date"),
        "check_out_date": F.col("_check_out_ts").cast("date"),
    }
    classified = _finish(r, "reservations", rules, typed, run_dir, extra=dates)
    return _result("reservations", raw, classified, smalls, run_dir)


def transform_payments(raw: DataFrame, reservations: EntityResult, run_dir: str | None = None) -> EntityResult:
    run_dir = _run_dir(raw, run_dir)
    r = _prepare(raw, "payments", numeric=["amount"]).withColumn("reservation_id", _str("reservation_id"))
    small = reservations.keys_small
    r = with_parent_flags(r, [Reference("reservation_id", reservations.clean.select("reservation_id"), "_reservation_ok", small)],
                          run_dir=run_dir)
    r = r.select("*", N.rewritten_timestamp("_t_payment_date", stripped=True).alias("_w_payment_date"))
    typed = {
        "payment_id": _str("payment_id"),
        "payment_method": _str("payment_method"),
        "_amount_value": N.to_double("_t_amount", stripped=True, number="_n_amount"),
        "amount": N.to_decimal("_t_amount", V.AMOUNT_TYPE, stripped=True),
        "payment_date": N.parse_timestamp("_t_payment_date", rewritten="_w_payment_date"),
        "payment_status": N.payment_status("_t_payment_status", stripped=True),
    }
    rules = [
        Rule("R10", _any_null(["payment_id", "reservation_id", "_amount_value"]), V.R_REQUIRED),
        Rule("R11", ~F.col("_reservation_ok"), V.R_PAYMENT_RESERVATION),
        Rule("R12", F.col("_amount_value") < 0, V.R_NEGATIVE),
        Rule("R13", F.col("payment_status") == V.UNKNOWN_STATUS, V.R_PAYMENT_STATUS),
        *_contract("payments", not_null=["payment_method"]),
        Rule("C_amount", F.col("amount").isNull(), V.CONTRACT_PREFIX + "amount"),
    ]
    return _result("payments", raw, _finish(r, "payments", rules, typed, run_dir), {"reservations": small},
                   run_dir)


def _any_null(cols: Sequence[str]) -> Column:
    expr = F.col(cols[0]).isNull()
    for c in cols[1:]:
        expr = expr | F.col(c).isNull()
    return expr


@dataclass
class Cleaned:
    """All five entity results of one run, children checked against surviving parents."""

    properties: EntityResult
    rooms: EntityResult
    guests: EntityResult
    reservations: EntityResult
    payments: EntityResult

    def __getitem__(self, name: str) -> EntityResult:
        return getattr(self, name)

    def entities(self) -> list[EntityResult]:
        return [self[n] for n in LOAD_ORDER]

    @cached_property
    def rejects(self) -> DataFrame:
        """Rejects of all tables in one frame (UNION ALL)."""
        out = None
        for e in self.entities():
            out = e.rejects if out is None else out.unionByName(e.rejects)
        return out


def transform_all(raw: dict[str, DataFrame], run_dir: str | None = None, kept_dir: str | None = None) -> Cleaned:
    """Clean all five entities; each classified table is staged under ``run_dir``.

    The keep-first tables go to ``kept_dir/<name>`` when given (the job passes
    its warehouse folder, so the clean data is written once), else next to the
    classified tables.  Guests do not depend on properties or rooms, so that
    chain runs as concurrent Spark jobs next to properties -> rooms;
    reservations wait for all three survivors, payments for reservations.
    """
    if run_dir is None:
        run_dir = new_run_dir(next(iter(raw.values())).sparkSession)

    def place(e: EntityResult) -> EntityResult:
        if kept_dir:
            e.kept_path = f"{kept_dir}/{e.name}"
        return e

    def guests_chain() -> EntityResult:
        g = place(transform_guests(raw["guests"], run_dir))
        g.keys_small, g.clean  # noqa: B018 - stage the kept table in this thread
        return g

    with ThreadPoolExecutor(max_workers=1) as pool:
        pending_guests = pool.submit(guests_chain)
        properties = place(transform_properties(raw["properties"], run_dir))
        rooms = place(transform_rooms(raw["rooms"], properties, run_dir))
        guests = pending_guests.result()
    reservations = place(transform_reservations(raw["reservations"], guests, properties, rooms, run_dir))
    payments = place(transform_payments(raw["payments"], reservations, run_dir))
    for e in (rooms, reservations, payments):
        e.clean  # noqa: B018 - every kept table is written, parents first
    return Cleaned(properties, rooms, guests, reservations, payments)


TRANSFORMS: dict[str, Callable] = {
    "guests": transform_guests,
    "properties": transform_properties,
    "rooms": transform_rooms,
    "reservations": transform_reservations,
    "payments": transform_payments,
}
