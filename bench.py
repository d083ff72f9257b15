"""Headline benchmark: clean + quarantine all five entities, then marts, checks and tests.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is forced
through a no-op sink (full computation, nothing collected).  ``clean_all``
is the cleaning job (derive raw extracts, normalise, flag references,
classify, stage the classified tables); later queries read the staged tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from innflow.plans import catalog  # noqa: E402
from innflow.session import local_session  # noqa: E402

HEADLINE = [
    "fct_reservations",
    "dim_guests",
    "agg_property_performance",
    "warehouse_checks",
    "contract_tests",
    "reject_summary",
    "quarantine_records",
    "dedup_keep_first",
    "duplicate_counts",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(4, int(cpus) if cpus.isdigit() else 8))))
    spark = local_session(cpus, shuffle_partitions=shuffle, app="innflow-bench")
    times: dict[str, float] = {}

    t0 = time.time()
    c = catalog.cleaned(spark, sf_dir)
    for e in c.entities():
        _force(e.clean)
    times["clean_all"] = round(time.time() - t0, 3)

    for name in HEADLINE:
        t0 = time.time()
        _force(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)

    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "booking_pipeline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
