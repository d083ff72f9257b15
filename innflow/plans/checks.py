"""Warehouse checks (the hard gate) and declarative model tests.

Both return small DataFrames, one row per check or test, computed from the
whole tables in one tagged pass (``operators.tagged``): each table is read once, all keys of
all checks meet in one shuffle.  Only the final result (<= 40 rows) reaches the driver, in
``gate``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innflow.functions import vocab as V
from innflow.operators.tagged import Condition, Listed, Reference, Unique, failing_rows, labelled


class GateFailed(RuntimeError):
    """Raised when a warehouse check finds failing rows: marts must not be built."""


def _status(failing: Column) -> Column:
    return F.when(failing == 0, F.lit("PASS")).otherwise(F.lit("FAIL"))


# --- warehouse checks -------------------------------------------------------

def warehouse_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """V1-V17 over the warehouse tables: check, failing_rows, status (PASS iff 0)."""
    checks = {
        "V01 guests.guest_id unique": Unique("guests", "guest_id"),
        "V02 guests names present": Condition("guests", F.col("first_name").isNull() | F.col("last_name").isNull()),
        "V03 properties.property_id unique": Unique("properties", "property_id"),
        "V04 rooms.room_id unique": Unique("rooms", "room_id"),
        "V05 rooms.property_id has a property": Reference("rooms", "property_id", "properties", "property_id"),
        "V06 rooms.capacity positive": Condition("rooms", F.col("capacity") <= 0),
        "V07 reservations.reservation_id unique": Unique("reservations", "reservation_id"),
        "V08 reservations.guest_id has a guest": Reference("reservations", "guest_id", "guests", "guest_id"),
        "V09 reservations.property_id has a property": Reference("reservations", "property_id", "properties", "property_id"),
        "V10 reservations.room_id has a room": Reference("reservations", "room_id", "rooms", "room_id"),
        "V11 reservations.booking_status known": Condition("reservations", ~F.col("booking_status").isin(*V.BOOKING_STATUSES)),
        "V12 reservations check-out not before check-in": Condition(
            "reservations", F.col("check_out_date").isNotNull() & (F.col("check_out_date") < F.col("check_in_date"))),
        "V13 reservations check-in and booking dates present": Condition(
            "reservations", F.col("check_in_date").isNull() | F.col("booking_date").isNull()),
        "V14 payments.payment_id unique": Unique("payments", "payment_id"),
        "V15 payments.reservation_id has a reservation": Reference("payments", "reservation_id", "reservations", "reservation_id"),
        "V16 payments.payment_status known": Condition("payments", ~F.col("payment_status").isin(*V.PAYMENT_STATUSES)),
        "V17 payments.amount not negative": Condition("payments", F.col("amount") < 0),
    }
    counted = labelled(failing_rows(tables, list(checks.values())), [{"check": name} for name in checks])
    return counted.select("check", "failing_rows", _status(F.col("failing_rows")).alias("status"))


def gate(results: DataFrame) -> DataFrame:
    """V18: PASS iff every check has 0 failing rows; raises ``GateFailed`` otherwise.

    Collects only the check table (one row per check).
    """
    rows = results.collect()
    failed = [r for r in rows if r["status"] != "PASS"]
    if failed:
        raise GateFailed("; ".join(f"{r[0]}: {r['failing_rows']}" for r in failed))
    return results


# --- tables on which every check must fail ------------------------------------

MODEL_KEYS = {"stg_guests": "guest_id", "stg_properties": "property_id", "stg_rooms": "room_id",
              "stg_reservations": "reservation_id", "stg_payments": "payment_id", "fct_reservations": "reservation_id",
              "dim_guests": "guest_id", "agg_property_performance": "property_id"}


def spoiled(df: DataFrame, key: str) -> DataFrame:
    """``df`` four times over: as it is, again (keys repeat), with every value NULL, and with wrong values.

    Wrong: the key and other ids moved past every parent (by different steps), text marked, numbers negated, the check-out
    date 4000 days early.  A check that counts nothing here cannot fail at all.
    """
    def wrong(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "bigint" and name.endswith("_id"):
            return c + F.lit(1_000_000_000_000 if name == key else 2_000_000_000_000)
        if kind == "string":
            return F.concat(F.lit("~" if name == key else "^"), c)
        if kind == "smallint" or kind.startswith("decimal"):
            return (-c).cast(kind)
        return F.date_sub(c, 4000) if name == "check_out_date" else c

    nulls = df.select(*[F.lit(None).cast(k).alias(n) for n, k in df.dtypes])
    moved = df.select(*[wrong(n, k).alias(n) for n, k in df.dtypes])
    return df.unionByName(df).unionByName(nulls).unionByName(moved)


# --- declarative model tests ------------------------------------------------

@dataclass(frozen=True)
class Test:
    model: str
    column: str
    test: str            # unique | not_null | accepted_values | relationships
    values: tuple = ()   # accepted values
    to: tuple = ()       # (parent model, parent column)


def _spec() -> list[Test]:
    t: list[Test] = []

    def cols(model: str, *entries):
        for column, tests in entries:
            for test in tests:
                if isinstance(test, Test):
                    t.append(test)
                else:
                    t.append(Test(model, column, test))

    cols("stg_guests", ("guest_id", ["unique", "not_null"]), ("first_name", ["not_null"]),
         ("last_name", ["not_null"]))
    cols("stg_properties", ("property_id", ["unique", "not_null"]), ("property_name", ["not_null"]))
    cols("stg_rooms", ("room_id", ["unique", "not_null"]),
         ("property_id", ["not_null", Test("stg_rooms", "property_id", "relationships",
                                           to=("stg_properties", "property_id"))]),
         ("capacity", ["not_null"]))
    cols("stg_reservations", ("reservation_id", ["unique", "not_null"]),
         ("guest_id", ["not_null", Test("stg_reservations", "guest_id", "relationships",
                                        to=("stg_guests", "guest_id"))]),
         ("property_id", ["not_null", Test("stg_reservations", "property_id", "relationships",
                                           to=("stg_properties", "property_id"))]),
         ("room_id", ["not_null", Test("stg_reservations", "room_id", "relationships",
                                       to=("stg_rooms", "room_id"))]),
         ("booking_status", ["not_null", Test("stg_reservations", "booking_status", "accepted_values",
                                              values=V.BOOKING_STATUSES)]),
         ("check_in_date", ["not_null"]))
    cols("stg_payments", ("payment_id", ["unique", "not_null"]),
         ("reservation_id", ["not_null", Test("stg_payments", "reservation_id", "relationships",
                                              to=("stg_reservations", "reservation_id"))]),
         ("payment_status", ["not_null", Test("stg_payments", "payment_status", "accepted_values",
                                              values=V.PAYMENT_STATUSES)]),
         ("amount", ["not_null"]))
    cols("fct_reservations", ("reservation_id", ["unique", "not_null"]),
         ("guest_id", ["not_null", Test("fct_reservations", "guest_id", "relationships",
                                        to=("dim_guests", "guest_id"))]),
         ("amount_paid", ["not_null"]))
    cols("dim_guests", ("guest_id", ["unique", "not_null"]))
    cols("agg_property_performance", ("property_id", ["unique", "not_null"]), ("total_revenue", ["not_null"]))
    return t


MODEL_TESTS = _spec()


def contract_tests(models: dict[str, DataFrame], tests: Sequence[Test] = MODEL_TESTS) -> DataFrame:
    """D1-D4: model, column, test, failing_rows, status.  NULLs are skipped by unique,
    accepted_values and relationships (they are the not_null test's business)."""
    def check(t: Test) -> Condition | Unique | Listed | Reference:
        if t.test == "not_null":
            return Condition(t.model, F.col(t.column).isNull())
        if t.test == "unique":
            return Unique(t.model, t.column, skip_null=True)
        if t.test == "accepted_values":
            return Listed(t.model, t.column, tuple(t.values))
        return Reference(t.model, t.column, *t.to, skip_null=True)

    counted = labelled(failing_rows(models, [check(t) for t in tests]),
                       [{"model": t.model, "column": t.column, "test": t.test} for t in tests])
    return counted.select("model", "column", "test", "failing_rows", _status(F.col("failing_rows")).alias("status"))
