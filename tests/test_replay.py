"""Orphans replayed with late parents against one run over all rows."""

from innflow.operators.quarantine import REASON
from innflow.plans.entities import LOAD_ORDER, transform_all
from innflow.plans.replay import ORPHAN_REASONS, replay
from innflow.plans.roles import RAW_COLUMNS

ROWS = {
    "properties": [("1", "Alpha", "A", "X"), ("2", "Beta", "B", "Y"), ("2", "Later name", "B", "Y")],
    "rooms": [("10", "1", "Loft", "2"), ("20", "2", "Twin", "1"), ("30", "9", "Twin", "1"), ("40", "2", "Twin", "0")],
    "guests": [("100", "Ada", "L", "", "", ""), ("101", "Bo", "M", "", "", "")],
    "reservations": [
        ("R1", "100", "1", "10", "2025-01-01", "2025-01-03", "confirmed", "2024-12-01 10:00:00"),
        ("R2", "101", "1", "10", "2025-01-01", "2025-01-03", "confirmed", "2024-12-01 10:00:00"),   # late guest
        ("R3", "100", "2", "20", "2025-02-01", "2025-02-03", "confirmed", "2024-12-02 10:00:00"),   # late property
        ("R3", "100", "1", "10", "2025-02-02", "2025-02-03", "confirmed", "2024-12-02 10:00:00"),   # same key, kept at first
        ("R4", "101", "1", "10", "2025-03-05", "2025-03-01", "confirmed", "2024-12-02 10:00:00"),   # then: dates
        ("R5", "555", "1", "10", "2025-03-05", "2025-03-07", "confirmed", "2024-12-02 10:00:00"),   # never a parent
    ],
    "payments": [("P1", "R1", "2025-01-01", "card", "1.50", "paid"), ("P2", "R2", "2025-01-01", "card", "2", "paid"),
                 ("P3", "R5", "2025-01-01", "card", "3", "paid"), ("P4", "R2", "2025-01-01", "card", "-4", "paid")],
}


def _extracts(rows_df, keep):
    return {t: rows_df([dict(zip(RAW_COLUMNS[t], r, strict=True)) for r in rows], RAW_COLUMNS[t]).where(keep.get(t, "true"))
            for t, rows in ROWS.items()}


def _state(c):
    clean = {t: sorted(map(str, c[t].clean.collect())) for t in LOAD_ORDER}
    copies = {t: sorted((str(r[0]), r[1]) for r in c[t].deduplicated.select(c[t].key, "_copies").collect()) for t in LOAD_ORDER}
    return clean, copies, sorted(map(str, c.rejects.collect()))


def test_late_parents_end_as_one_run(spark, rows_df):
    whole = transform_all(_extracts(rows_df, {}))
    first = transform_all(_extracts(rows_df, {"properties": "property_id = '1'", "guests": "guest_id = '100'"}))
    waiting = {t: first[t].classified.where(f"{REASON} = '{r}'").count() for t, r in ORPHAN_REASONS.items()}
    assert waiting == {"rooms": 2, "reservations": 4, "payments": 3}
    late = _extracts(rows_df, {"properties": "property_id <> '1'", "guests": "guest_id <> '100'"})
    done = replay(first, {t: late[t] for t in ("properties", "guests")})
    assert _state(done) == _state(whole)
    kept = {r.reservation_id: r.property_id for r in done.reservations.clean.collect()}
    assert kept == {"R1": 1, "R2": 1, "R3": 2}
    # in two steps as well, and once more without anything new
    step = replay(first, {"guests": late["guests"]})
    assert step.rooms is first.rooms
    assert _state(replay(step, {"properties": late["properties"]})) == _state(whole)
    again = replay(done)
    assert all(again[t] is done[t] for t in LOAD_ORDER)
