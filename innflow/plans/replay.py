"""Replay of quarantined orphans once their parents have arrived.

A row rejected only because its parent was missing is kept with its whole raw text (``raw_record``).  ``replay`` takes
the results of an earlier run and raw rows that arrived since, goes down the parent order once, and cleans, per table, the late
rows together with the waiting orphans, read back by ``from_json``, by the same rules.  References only point up that order, so after one
pass nothing can change any more.  Rows settled before (accepted, or rejected for another reason) are neither parsed nor joined
again; only keep-first runs over all accepted rows, since a replayed row may have arrived before the one kept.
The outcome is that of one run over all rows, arrival order included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.functions import vocab as V
from innflow.operators.quarantine import REASON, SEQ
from innflow.plans.entities import LOAD_ORDER, RAW_RECORD, TRANSFORMS, Cleaned, EntityResult
from innflow.plans.roles import RAW_COLUMNS
from innflow.sources.staging import new_run_dir

# the parents of a table, in the order its cleaning takes them
PARENTS = {"properties": (), "guests": (), "rooms": ("properties",), "reservations": ("guests", "properties", "rooms"),
           "payments": ("reservations",)}
ORPHAN_REASONS = {"rooms": V.R_ROOM_PROPERTY, "reservations": V.R_RES_REFERENCE, "payments": V.R_PAYMENT_RESERVATION}


def waiting(result: EntityResult) -> DataFrame:
    """Raw rows (text columns and arrival order) of the orphans in quarantine."""
    columns = RAW_COLUMNS[result.name]
    orphans = result.classified.where(F.col(REASON) == ORPHAN_REASONS[result.name])
    schema = ", ".join(f"`{c}` string" for c in columns)
    return orphans.select(F.from_json(RAW_RECORD, schema).alias("r"), SEQ).select("r.*", SEQ)


def replay(before: Cleaned, late: dict[str, DataFrame] | None = None, run_dir: str | None = None) -> Cleaned:
    """The results with ``late`` raw rows (per table: text columns and ``_seq``) and the orphans they release.

    A table without late rows whose parents gained no key keeps its result as it is; with nothing late, so do all.
    Orphans whose parent is still missing stay in quarantine, with the first reason that now holds.
    """
    late = late or {}
    run_dir = run_dir or new_run_dir(before.properties.classified.sparkSession)
    done: dict[str, EntityResult] = {}
    gained: set[str] = set()
    for name in LOAD_ORDER:  # parents first
        old, columns = before[name], [*RAW_COLUMNS[name], SEQ]
        raws = [late[name].select(*columns)] if name in late else []
        if gained.intersection(PARENTS[name]):
            raws.append(waiting(old))
            settled = old.classified.where(F.col(REASON).isNull() | (F.col(REASON) != ORPHAN_REASONS[name]))
        else:
            settled = old.classified
        if not raws:
            done[name] = old
            continue
        raw = raws[0] if len(raws) == 1 else raws[0].unionByName(raws[1])
        again = TRANSFORMS[name](raw, *[done[p] for p in PARENTS[name]], run_dir=f"{run_dir}/replayed")
        done[name] = EntityResult(name, raw, settled.unionByName(again.classified), again.parent_small, run_dir)
        if not again.accepted.isEmpty():
            gained.add(name)
    return Cleaned(**done)
