"""Dimension histories and as-of joins against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from innflow.plans import history as H
from innflow.sources.staging import new_run_dir
from innflow.sources.versions import VersionedStore

MOMENTS = ["2020-01-01 00:00:00", "2021-06-01 00:00:00", "2021-07-01 00:00:00", "2024-01-01 00:00:00"]
SCHEMA = "property_id bigint, property_name string, city string, country string"


def _snapshots(seed):
    rng = random.Random(seed)
    return [{k: (rng.choice(["a", "b", None]), "c", rng.choice(["x", ""])) for k in range(12) if rng.random() < 0.8} for _ in MOMENTS]


def _expected(snapshots, complete=True):
    open_rows, out = {}, []
    for moment, rows in zip(MOMENTS, snapshots, strict=True):
        for k in sorted(set(open_rows) | set(rows)):
            if k not in rows and not complete:
                continue
            if k in open_rows and open_rows[k][0] != rows.get(k):
                out.append((k, *open_rows[k][0], open_rows[k][1], moment))
                del open_rows[k]
            if k in rows and k not in open_rows:
                open_rows[k] = (rows[k], moment)
    return sorted((*map(str, r),) for r in [*out, *((k, *row, since, None) for k, (row, since) in open_rows.items())])


def _store(spark, snapshots, complete=True):
    store, reports = VersionedStore(spark, new_run_dir(spark)), []
    for moment, rows in zip(MOMENTS, snapshots, strict=True):
        draft = store.begin()
        df = spark.createDataFrame([(k, *v) for k, v in rows.items()], SCHEMA)
        reports.append(H.advance(draft, H.PROPERTIES, df, moment, complete))
        draft.publish()
    return store, reports


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("complete", [True, False])
def test_intervals_match_python(spark, complete):
    snapshots = _snapshots(3)
    store, reports = _store(spark, snapshots, complete)
    got = H.history(store, H.PROPERTIES)
    assert got.columns == ["property_id", "property_name", "city", "country", "valid_from", "valid_to"]
    expected = _expected(snapshots, complete)
    assert _rows(got) == expected
    assert reports[0].new == len(snapshots[0]) and reports[0].changed == reports[0].gone == 0
    assert all((r.gone == 0) or complete for r in reports)
    # no two states of a key overlap
    a, b = got.alias("a"), got.alias("b")
    over = a.join(b, (F.col("a.property_id") == F.col("b.property_id")) & (F.col("a.valid_from") < F.col("b.valid_from"))
                  & (F.col("a.valid_to").isNull() | (F.col("b.valid_from") < F.col("a.valid_to"))))
    assert over.count() == 0
    for moment in [*MOMENTS, "2019-01-01 00:00:00", "2021-06-15 12:00:00", "2030-01-01 00:00:00"]:
        then = sorted(r[:4] for r in expected if r[4] <= moment and (r[5] == "None" or r[5] > moment))
        assert _rows(H.valid_at(store, H.PROPERTIES, moment)) == then
    # an earlier version still reads as it was
    assert _rows(H.history(store, H.PROPERTIES, store.version(1))) == sorted(
        tuple(map(str, (k, *v, MOMENTS[0], None))) for k, v in snapshots[0].items())


def test_a_snapshot_without_changes_writes_no_part_and_time_goes_forward(spark):
    same = _snapshots(1)[0]
    store, reports = _store(spark, [same] * 4)
    assert [r.parts_written for r in reports[1:]] == [[], [], []]
    assert [(r.new, r.changed, r.gone, r.unchanged) for r in reports[1:]] == [(0, 0, 0, len(same))] * 3
    with pytest.raises(ValueError, match="not after"):
        H.advance(store.begin(), H.PROPERTIES, spark.createDataFrame([], SCHEMA), MOMENTS[-1])
    draft = store.begin()
    report = H.advance(draft, H.PROPERTIES, spark.createDataFrame([], SCHEMA), "2025-01-01 00:00:00")
    draft.publish()
    assert report.gone == len(same) and H.valid_at(store, H.PROPERTIES, "2026-01-01 00:00:00").count() == 0
    assert H.valid_at(store, H.PROPERTIES, "2024-06-01 00:00:00").count() == len(same)


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0}, {"broadcast_rows": 0, "hot_rows": 3}])
def test_as_of_join_matches_python(spark, limits):
    rng = random.Random(9)
    states = [(k, f"{k}-{i}", f"{2018 + i}-03-01 00:00:00", f"{2019 + i}-03-01 00:00:00" if i < 3 else None) for k in (1, 2) for i in range(4)]
    facts = [(rng.choice([1, 1, 1, 2, 7, None]), rng.choice([None, f"{rng.randrange(2016, 2026)}-{rng.randrange(1, 13):02d}-01 00:00:00"]))
             for _ in range(200)]
    facts += [(1, "2019-03-01 00:00:00")] * 10  # equal rows, on an edge
    s = spark.createDataFrame(states, "k bigint, label string, f string, t string").select(
        "k", "label", F.col("f").cast("timestamp_ntz").alias("valid_from"), F.col("t").cast("timestamp_ntz").alias("valid_to"))
    f = spark.createDataFrame(facts, "k bigint, at string").withColumn("when", F.col("at").cast("timestamp_ntz"))
    out = H.as_of_join(f, s, "k", "when", {"label": "label_then"}, **limits)
    assert out.columns == ["k", "at", "when", "label_then"]

    def label(k, at):
        return next((n for kk, n, a, b in states if kk == k and at and a <= at and (b is None or at < b)), None)

    assert sorted(str((r.k, r.at, r.label_then)) for r in out.collect()) == sorted(str((k, at, label(k, at))) for k, at in facts)
    assert H.as_of_join(f.where("false"), s, "k", "when", {"label": "then"}, **limits).count() == 0
    none = H.as_of_join(f, s.where("false"), "k", "when", {"label": "then"}, **limits)
    assert none.count() == len(facts) and none.where("then is not null").count() == 0
    with pytest.raises(ValueError, match="label"):
        H.as_of_join(f.withColumn("label", F.lit(1)), s, "k", "when", {"label": "label"}, **limits)
