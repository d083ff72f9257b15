"""Incremental landing: files arriving over two runs land once each; a re-run adds nothing."""

import os
import tempfile

from innflow.plans.entities import transform_guests
from innflow.streaming.landing import land


def _write(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("guest_id,first_name,last_name,email,phone,country\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_landing_is_incremental_and_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="innflow-landing-")
    landing, bronze, ckpt = f"{base}/landing", f"{base}/bronze", f"{base}/ckpt"
    _write(f"{landing}/guests", "a.csv", [("1", "Ada", "L", "", "", ""), ("2", "", "M", "", "", "")])
    assert land(spark, landing, bronze, ckpt, "guests") == 2
    _write(f"{landing}/guests", "b.csv", [("1", "Ada2", "L", "", "", ""), ("3", "Cy", "N", "", "", "")])
    assert land(spark, landing, bronze, ckpt, "guests") == 4
    assert land(spark, landing, bronze, ckpt, "guests") == 4          # nothing new: nothing added
    b = spark.read.parquet(f"{bronze}/guests")
    assert {"_source_file", "_ingested_at", "_seq", "_batch"} <= set(b.columns)
    g = transform_guests(b.drop("_batch"))
    kept = {r.guest_id: r.first_name for r in g.clean.collect()}
    assert kept == {1: "Ada", 3: "Cy"}                                 # earlier batch wins keep-first
