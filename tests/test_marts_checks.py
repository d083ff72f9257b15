"""Marts, warehouse checks (the gate) and model tests over small hand-made warehouses."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from innflow.plans import marts as M
from innflow.plans.checks import MODEL_TESTS, GateFailed, contract_tests, gate, warehouse_checks


@pytest.fixture()
def warehouse(spark):
    d = dt.date
    ts = dt.datetime(2025, 1, 1, 9, 0)
    w = {
        "properties": spark.createDataFrame(
            [(1, "Alpha", "A-city", "X"), (2, "Beta", None, "Y"), (3, "Empty", "C", "Z")],
            "property_id bigint, property_name string, city string, country string"),
        "rooms": spark.createDataFrame(
            [(10, 1, "Suite", 2), (11, 1, "Deluxe", 3), (20, 2, "Standard", 1)],
            "room_id bigint, property_id bigint, room_type string, capacity smallint"),
        "guests": spark.createDataFrame(
            [(100, "Ada", "L", "a@x", None, "UK"), (101, "Bob", "M", None, None, None)],
            "guest_id bigint, first_name string, last_name string, email string, phone string, country string"),
        "reservations": spark.createDataFrame([
            ("R1", 100, 1, 10, d(2025, 1, 1), d(2025, 1, 4), "checked_out", ts),
            ("R2", 100, 1, 11, d(2025, 2, 1), None, "cancelled", ts),
            ("R3", 100, 2, 20, d(2025, 3, 1), d(2025, 3, 3), "no_show", ts),
            ("R4", 100, 1, 10, d(2025, 4, 1), d(2025, 4, 3), "checked_in", ts),
            ("R5", 100, 1, 10, d(2025, 5, 1), d(2025, 5, 1), "confirmed", ts),
        ], "reservation_id string, guest_id bigint, property_id bigint, room_id bigint, check_in_date date, "
           "check_out_date date, booking_status string, booking_date timestamp_ntz"),
        "payments": spark.createDataFrame([
            ("P1", "R1", ts, "cash", Decimal("100.10"), "paid"),
            ("P2", "R1", None, "cash", Decimal("50.00"), "failed"),
            ("P3", "R1", ts + dt.timedelta(days=1), "card", Decimal("25.05"), "paid"),
            ("P4", "R2", ts, "card", Decimal("70.00"), "failed"),
        ], "payment_id string, reservation_id string, payment_date timestamp_ntz, payment_method string, "
           "amount decimal(10,2), payment_status string"),
    }
    return w


def test_fct_reservations(warehouse):
    rows = {r.reservation_id: r for r in M.fct_reservations(warehouse).collect()}
    assert rows["R1"].amount_paid == Decimal("125.15") and rows["R1"].payment_record_count == 3
    assert rows["R1"].last_payment_date == dt.datetime(2025, 1, 2, 9, 0)
    assert rows["R2"].amount_paid == Decimal("0.00") and rows["R2"].payment_record_count == 1  # only failed
    assert rows["R3"].amount_paid == Decimal("0.00") and rows["R3"].payment_record_count == 0  # no payments
    assert rows["R3"].last_payment_date is None
    assert rows["R1"].nights_booked == 3 and rows["R2"].nights_booked is None and rows["R5"].nights_booked == 0


def test_dim_guests(warehouse):
    rows = {r.guest_id: r for r in M.dim_guests(warehouse).collect()}
    assert (rows[100].total_reservations, rows[100].cancelled_reservations, rows[100].no_show_reservations) == (5, 1, 1)
    assert rows[100].first_check_in_date == dt.date(2025, 1, 1)
    assert rows[100].most_recent_check_in_date == dt.date(2025, 5, 1)
    assert (rows[101].total_reservations, rows[101].first_check_in_date) == (0, None)


def test_agg_property_performance(warehouse):
    rows = {r.property_id: r for r in M.agg_property_performance(warehouse).collect()}
    a = rows[1]
    assert (a.room_count, a.total_reservations, a.completed_stays, a.cancelled_reservations) == (2, 4, 2, 1)
    assert a.total_revenue == Decimal("125.15")
    # nights 3, (open), 2, 0 -> avg of 3 known = 5/3 = 1.666.. -> 1.67
    assert a.avg_nights_booked == Decimal("1.67")
    assert rows[2].avg_nights_booked == Decimal("2.00") and rows[2].no_show_reservations == 1
    e = rows[3]
    assert (e.room_count, e.total_reservations, e.total_revenue, e.avg_nights_booked) == (0, 0, Decimal("0.00"), None)


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 8), (5, 2), (201, 200), (1, 3), (2, 3), (0, 5)], "t bigint, n bigint")
    got = [r[0] for r in df.select(M.half_up_avg("t", "n")).collect()]
    assert got == [Decimal("0.13"), Decimal("2.50"), Decimal("1.01"), Decimal("0.33"), Decimal("0.67"),
                   Decimal("0.00")]


def test_checks_pass_on_clean_warehouse(warehouse):
    res = warehouse_checks(warehouse)
    rows = res.collect()
    assert len(rows) == 17 and all(r.status == "PASS" for r in rows)
    gate(res)


def test_gate_fails_on_spoiled_warehouse(spark, warehouse):
    bad = dict(warehouse)
    bad["payments"] = warehouse["payments"].unionByName(
        warehouse["payments"].where(F.col("payment_id") == "P1")).unionByName(
        spark.createDataFrame([("P9", "R404", None, "x", Decimal("-1.00"), "weird")], warehouse["payments"].schema))
    bad["reservations"] = warehouse["reservations"].unionByName(spark.createDataFrame(
        [("R9", 100, 1, 10, dt.date(2025, 1, 5), dt.date(2025, 1, 1), None, None)], warehouse["reservations"].schema))
    res = {r.check: r.failing_rows for r in warehouse_checks(bad).collect()}
    assert res["V14 payments.payment_id unique"] == 1
    assert res["V15 payments.reservation_id has a reservation"] == 1
    assert res["V16 payments.payment_status known"] == 1
    assert res["V17 payments.amount not negative"] == 1
    assert res["V12 reservations check-out not before check-in"] == 1
    assert res["V13 reservations check-in and booking dates present"] == 1
    assert res["V11 reservations.booking_status known"] == 0      # NULL status is not counted (NOT IN)
    with pytest.raises(GateFailed):
        gate(warehouse_checks(bad))


def test_model_tests(warehouse):
    models = {n: f(warehouse) for n, f in M.STAGING.items()}
    models.update({n: f(warehouse) for n, f in M.MARTS.items()})
    rows = contract_tests(models).collect()
    assert len(rows) == len(MODEL_TESTS) == 40
    assert all(r.status == "PASS" for r in rows)
    counts = {}
    for t in MODEL_TESTS:
        counts[t.test] = counts.get(t.test, 0) + 1
    assert counts == {"unique": 8, "not_null": 24, "accepted_values": 2, "relationships": 6}


def test_every_check_fails_on_spoiled_tables(spark, warehouse):
    from innflow.plans.catalog import KEYS, MODEL_KEYS, model_frames
    from innflow.plans.checks import spoiled

    checks = warehouse_checks({n: spoiled(df, KEYS[n]) for n, df in warehouse.items()})
    assert {r["check"] for r in checks.collect() if r.status == "PASS"} == set() and checks.count() == 17
    with pytest.raises(GateFailed):
        gate(checks)
    tests = contract_tests({n: spoiled(df, MODEL_KEYS[n]) for n, df in model_frames(warehouse).items()})
    assert {(r.model, r.column, r.test) for r in tests.collect() if r.failing_rows == 0} == set()
    assert tests.count() == len(MODEL_TESTS)
