"""Deliveries in sequence against one full run in plain Python; touched months, unchanged files, late rows."""

import datetime as dt
import random
import tempfile

import pytest

from innflow.plans.entities import CLEAN_SCHEMAS
from innflow.plans import incremental
from innflow.plans import marts as M
from innflow.plans.incremental import (
    PAYMENTS,
    RESERVATIONS,
    agg_property_performance,
    dim_guests,
    refresh_marts,
    upsert,
)
from innflow.sources.versions import VersionedStore

@pytest.fixture(autouse=True)
def few_parts(monkeypatch):
    monkeypatch.setattr(incremental, "INDEX_PARTS", 4)


SCHEMA = ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["reservations"]) + ", _seq long"


def booking(rng, key, seq):
    at = dt.datetime(2025, rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23))
    day = dt.date(2026, 1, rng.randint(1, 28))
    return (f"RES-{key}", rng.randint(1, 5), rng.randint(1, 3), rng.randint(1, 9), day, None if key % 7 == 0 else day + dt.timedelta(2),
            rng.choice(["pending", "confirmed", "cancelled"]), at, seq)


def latest(rows, at=7):
    best = {}
    for n, r in enumerate(rows):
        order = (r[at] is not None, r[at] or dt.datetime.min, n)
        if r[0] not in best or order >= best[r[0]][0]:
            best[r[0]] = (order, r[:-1])
    return sorted(map(repr, (r for _, r in best.values())))


def stored(store, table="reservations", version=None):
    return sorted(repr(tuple(r)) for r in store.read(table, version).collect())


def test_deliveries_equal_a_full_run(spark, monkeypatch):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-upsert-"))
    rng = random.Random(1)
    every, reports, versions = [], [], []
    for n in range(4):
        rows = [booking(rng, rng.randint(0, 60), i) for i in range(40)]
        rows += [(*r[:-1], 1000 + i) for i, r in enumerate(every[-10:])]  # re-sent as they were
        every += rows
        draft = store.begin()
        reports.append(upsert(draft, RESERVATIONS, spark.createDataFrame(rows, SCHEMA).repartition(3)))
        versions.append(draft.publish())
        assert stored(store) == latest(every)
        index = {r.reservation_id: r.month for r in store.read("reservations_index").collect()}
        assert index == {r.reservation_id: r.booking_date.strftime("%Y-%m") for r in store.read("reservations").collect()}
    assert reports[0].months_before == [] and all(r.late == 0 for r in reports)
    assert all(r.new + r.changed + r.unchanged + r.outdated > 0 for r in reports) and any(r.unchanged for r in reports[1:])
    assert store.current().state["reservations_watermark"] == max(r[7] for r in every).isoformat(sep=" ")
    assert stored(store, version=versions[0]) == latest(every[:40])
    # the changes are what turns one version into the next
    for k in range(1, 4):
        was, now = set(stored(store, version=versions[k - 1])), set(stored(store, version=versions[k]))
        signed = [(r.sign, repr(tuple(r)[:-1])) for r in reports[k].changes.collect()]
        assert {x for s, x in signed if s > 0} == now - was and {x for s, x in signed if s < 0} == was - now


def test_only_touched_months_are_read_and_written(spark, monkeypatch):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-upsert-"))
    rows = [(f"RES-{i}", 1, 1, 1, dt.date(2026, 1, 1), None, "confirmed", dt.datetime(2025, 1 + i % 12, 3), i) for i in range(120)]
    draft = store.begin()
    upsert(draft, RESERVATIONS, spark.createDataFrame(rows, SCHEMA))
    first = draft.publish()
    assert len(first.tables["reservations"].parts) == 12
    read = []
    plain = VersionedStore.read
    monkeypatch.setattr(VersionedStore, "read", lambda self, table, version=None, parts=None: read.append((table, parts)) or plain(self, table, version, parts))
    # one booking moves from March to May, one is new in May, one of July comes again as it was, one old state of August comes late
    second = [("RES-2", 1, 1, 1, dt.date(2026, 1, 1), None, "cancelled", dt.datetime(2025, 5, 9), 0), ("RES-900", 1, 1, 1, dt.date(2026, 1, 1), None, "pending", dt.datetime(2025, 5, 9), 1),
              rows[6][:-1] + (2,), ("RES-7", 1, 1, 1, dt.date(2026, 1, 1), None, "pending", dt.datetime(2025, 8, 1), 3)]
    draft = store.begin()
    report = upsert(draft, RESERVATIONS, spark.createDataFrame(second, SCHEMA))
    after = draft.publish()
    assert (report.new, report.changed, report.unchanged, report.outdated) == (1, 1, 1, 1)
    assert report.months_written == ["2025-03", "2025-05"]
    assert [sorted(p) for t, p in read if t == "reservations"] == [["2025-03", "2025-05"]]
    same = [m for m, f in after.tables["reservations"].parts.items() if first.tables["reservations"].parts.get(m) == f]
    assert len(same) == 10
    monkeypatch.setattr(VersionedStore, "read", plain)
    monkeypatch.setattr(incremental, "INDEX_PARTS", 7)  # a store keeps the number of parts it began with
    assert stored(store) == latest(rows + second)
    # a month that loses its last row is gone
    draft = store.begin()
    upsert(draft, RESERVATIONS, spark.createDataFrame([(f"RES-{i}", 1, 1, 1, dt.date(2026, 1, 1), None, "pending", dt.datetime(2026, 1, 1), i) for i in range(0, 120, 12)], SCHEMA))
    assert "2025-01" not in draft.publish().tables["reservations"].parts


def test_late_rows_are_kept_apart(spark):
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-upsert-"))
    def made(i, month, day=1):
        return (f"RES-{i}", 1, 1, 1, dt.date(2026, 1, 1), None, "confirmed", dt.datetime(2025, month, day), i)
    draft = store.begin()
    upsert(draft, RESERVATIONS, spark.createDataFrame([made(1, 1), made(2, 6)], SCHEMA), lateness="INTERVAL 30 DAYS")
    draft.publish()
    draft = store.begin()
    report = upsert(draft, RESERVATIONS, spark.createDataFrame([made(3, 4), made(4, 5, 20), made(5, 7)], SCHEMA), lateness="INTERVAL 30 DAYS")
    draft.publish()
    assert (report.late, report.new, report.watermark) == (1, 2, "2025-07-01 00:00:00")
    assert [r.reservation_id for r in store.read("reservations_late").collect()] == ["RES-3"]
    assert sorted(r.reservation_id for r in store.read("reservations").collect()) == ["RES-1", "RES-2", "RES-4", "RES-5"]


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_rows_without_a_time_and_empty_deliveries(spark, order):
    schema = ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["payments"]) + ", _seq long"
    from decimal import Decimal
    dated = ("P-1", "RES-1", dt.datetime(2025, 2, 1), "card", Decimal("1.00"), "paid", 0)
    undated = ("P-1", "RES-1", None, "cash", Decimal("2.00"), "pending", 0)
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-upsert-"))
    for rows in [[(undated, dated)[k]] for k in order] + [[]]:
        draft = store.begin()
        upsert(draft, PAYMENTS, spark.createDataFrame(rows, schema))
        draft.publish()
    assert [tuple(r) for r in store.read("payments").collect()] == [dated[:-1]]
    assert list(store.current().tables["payments"].parts) == ["2025-02"]


def test_marts_follow_the_changes(spark):
    """After every delivery (new, changed, moved and emptied keys) the kept marts equal marts built from the whole tables."""
    from decimal import Decimal

    pay_schema = ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["payments"]) + ", _seq long"
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-marts-"))
    rng = random.Random(9)
    guests = spark.createDataFrame([(g, f"f{g}", "l", None, None, None) for g in range(1, 8)], ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["guests"]))
    properties = spark.createDataFrame([(p, f"p{p}", None, None) for p in range(1, 5)], ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["properties"]))
    rooms = spark.createDataFrame([(r, 1 + r % 2, "single", 2) for r in range(1, 6)], ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["rooms"]))
    versions = []
    for _ in range(2):
        rows = [booking(rng, rng.randint(0, 40), i) for i in range(30)]
        pays = [(f"P-{rng.randint(0, 60)}", f"RES-{rng.randint(0, 45)}", rng.choice([None, dt.datetime(2025, rng.randint(1, 12), 1)]), "card",
                 Decimal(rng.randint(0, 99999)) / 100, rng.choice(["paid", "pending"]), i) for i in range(40)]
        draft = store.begin()
        changed = upsert(draft, RESERVATIONS, spark.createDataFrame(rows, SCHEMA))
        paid = upsert(draft, PAYMENTS, spark.createDataFrame(pays, pay_schema))
        refresh_marts(draft, changed.changes, paid.changes)
        versions.append(draft.publish())
        w = {"guests": guests, "properties": properties, "rooms": rooms, "reservations": store.read("reservations"), "payments": store.read("payments")}
        for kept, whole in ((store.read("fct_reservations"), M.fct_reservations(w)), (dim_guests(store, guests), M.dim_guests(w)),
                            (agg_property_performance(store, properties, rooms), M.agg_property_performance(w))):
            assert kept.columns == whole.columns and dict(kept.dtypes) == dict(whole.dtypes)
            assert sorted(map(repr, kept.collect())) == sorted(map(repr, whole.collect()))
    # one booking changes: one month of the fact, one part of each state
    old = store.read("reservations").orderBy("reservation_id").first()
    draft = store.begin()
    changed = upsert(draft, RESERVATIONS, spark.createDataFrame([(*old[:6], "no_show", old.booking_date, 0)], SCHEMA))
    none = upsert(draft, PAYMENTS, spark.createDataFrame([], pay_schema))
    assert refresh_marts(draft, changed.changes, none.changes) == [old.booking_date.strftime("%Y-%m")]
    after = draft.publish()
    for name in ("guest_state", "property_state"):
        moved = [p for p, f in after.tables[name].parts.items() if versions[-1].tables[name].parts.get(p) != f]
        assert len(moved) <= 1
    assert after.tables["payment_state"].parts == versions[-1].tables["payment_state"].parts


def test_large_deliveries_move_no_stored_row(spark, monkeypatch):
    """With every key set taken as large: the tables of a full run, no second copy of a first delivery, no stored row shuffled or rewritten for a lookup."""
    from innflow.operators import membership

    written, plans, plain = [], [], incremental.stage

    def stage(df, run_dir, name):
        written.append(name)
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return plain(df, run_dir, name)

    monkeypatch.setattr(incremental, "stage", stage)
    monkeypatch.setattr(membership, "stage", stage)
    monkeypatch.setattr(incremental, "BROADCAST_MAX_ROWS", -1, raising=False)
    store = VersionedStore(spark, tempfile.mkdtemp(prefix="innflow-upsert-"))
    rng = random.Random(3)
    none = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in CLEAN_SCHEMAS["payments"]) + ", _seq long")
    every = []
    for n in range(2):
        rows = [booking(rng, rng.randint(0, 60), i) for i in range(60)]
        every += rows
        draft = store.begin()
        booked = upsert(draft, RESERVATIONS, spark.createDataFrame(rows, SCHEMA))
        if n == 0:
            assert written == ["incoming"]
        refresh_marts(draft, booked.changes, upsert(draft, PAYMENTS, none).changes)
        draft.publish()
    assert stored(store) == latest(every)
    assert not [name for name in written if name.startswith("flagged")]
    assert "Join" not in dict(plans)["changes"].replace("Join LeftOuter", "")  # no semi or anti join against the stored rows
    assert {len(r.hash) for r in store.read("reservations_index").collect()} == {24}
    facts = {r.reservation_id: r.booking_status for r in store.read("fct_reservations").collect()}
    assert facts == {r.reservation_id: r.booking_status for r in store.read("reservations").collect()}
    guests = {r.guest_id: (r.total_reservations, r.first_check_in_date) for r in store.read("guest_state").collect()}
    kept = store.read("reservations").collect()
    assert guests == {g: (sum(r.guest_id == g for r in kept), min(r.check_in_date for r in kept if r.guest_id == g)) for g in {r.guest_id for r in kept}}
