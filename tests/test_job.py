"""End to end on CSV extracts written from the supplied tables (sf0.001)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from innflow.plans import catalog
from innflow.plans.job import run_job
from innflow.plans.roles import write_raw_extracts
from innflow.sources.files import MissingSourceError, read_raw_csv
from innflow.sources.tables import Tables

from conftest import SF_SMALL

TABLES = ("properties", "rooms", "guests", "reservations", "payments")


@pytest.fixture(scope="module")
def extracts(spark):
    base = tempfile.mkdtemp(prefix="innflow-job-")
    counts = write_raw_extracts(Tables(spark, SF_SMALL), f"{base}/raw")
    return base, counts


def test_job_matches_query_path_and_is_idempotent(spark, extracts):
    base, counts = extracts
    rep = run_job(spark, f"{base}/raw", f"{base}/out")
    assert {k: v for k, v in rep.bronze_rows.items() if k != "total"} == counts
    assert all(c["status"] == "PASS" for c in rep.checks) and len(rep.checks) == 17
    assert len(rep.tests) == 40 and all(t["status"] == "PASS" for t in rep.tests)
    c = catalog.cleaned(spark, SF_SMALL)
    for t in TABLES:
        written = spark.read.parquet(f"{base}/out/warehouse/{t}").drop("loaded_at", "_copies")
        assert written.exceptAll(c[t].clean).count() == 0 and c[t].clean.exceptAll(written).count() == 0
    rejects = spark.read.parquet(f"{base}/out/warehouse/rejected_records")
    assert rejects.count() == rep.rejected_rows == c.rejects.count()
    assert rejects.select("id").distinct().count() == rep.rejected_rows
    first = {t: spark.read.parquet(f"{base}/out/warehouse/{t}").drop("loaded_at", "_copies").collect() for t in TABLES}
    rep2 = run_job(spark, f"{base}/raw", f"{base}/out")
    assert rep2.warehouse_rows == rep.warehouse_rows and rep2.mart_rows == rep.mart_rows
    for t in TABLES:
        again = spark.read.parquet(f"{base}/out/warehouse/{t}").drop("loaded_at", "_copies").collect()
        assert sorted(map(tuple, again)) == sorted(map(tuple, first[t]))


def test_lineage_and_arrival_order(spark, extracts):
    base, _ = extracts
    g = read_raw_csv(spark, f"{base}/raw", "guests")
    assert {"_source_file", "_ingested_at", "_seq"} <= set(g.columns)
    assert g.where(F.col("_source_file").isNull()).count() == 0
    assert g.select("_seq").distinct().count() == g.count()


def test_missing_extract_is_an_error(spark):
    with pytest.raises(MissingSourceError):
        read_raw_csv(spark, tempfile.mkdtemp(), "guests")


def test_csv_quoting_roundtrip(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/properties.csv", "w") as f:
        f.write('property_id,property_name,city,country\n1,"Hotel ""Grand""","Multi\nLine",\n2,,NA,nan\n')
    rows = read_raw_csv(spark, d, "properties").orderBy("_seq").collect()
    assert rows[0].property_name == 'Hotel "Grand"' and rows[0].city == "Multi\nLine" and rows[0].country is None
    assert rows[1].property_name is None and rows[1].city == "NA" and rows[1].country == "nan"


def test_part_file_with_another_header_is_an_error(spark):
    import os

    d = tempfile.mkdtemp()
    os.makedirs(f"{d}/guests")
    with open(f"{d}/guests/part-1.csv", "w") as f:
        f.write("guest_id,first_name,last_name,email,phone,country\n1,Una,Berg,,,\n")
    assert read_raw_csv(spark, d, "guests").count() == 1
    with open(f"{d}/guests/part-2.csv", "w") as f:
        f.write("guest_id,last_name,first_name,email,phone,country\n2,Lie,Ola,,,\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_raw_csv(spark, d, "guests").collect()


def test_paths_with_a_scheme(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/properties.csv", "w") as f:
        f.write("property_id,property_name,city,country\n1,Harbour,,\n")
    assert [r.property_name for r in read_raw_csv(spark, f"file://{d}", "properties").collect()] == ["Harbour"]
    with pytest.raises(MissingSourceError, match="guests"):
        read_raw_csv(spark, f"file://{d}", "guests")
    with pytest.raises(Exception, match="(?i)scheme|filesystem|class"):
        read_raw_csv(spark, "nosuch://bucket/raw", "guests")


def test_rows_with_too_many_or_too_few_fields_are_kept_as_text(spark):
    from innflow.functions import vocab as V
    from innflow.plans.entities import transform_properties, transform_rooms

    d = tempfile.mkdtemp()
    with open(f"{d}/properties.csv", "w") as f:
        f.write("property_id,property_name,city,country\n5,Harbour,,\n")
    with open(f"{d}/rooms.csv", "w") as f:
        f.write('room_id,property_id,room_type,capacity\n1,5,Loft, big,3\n2,5,Twin\n3,5,Twin,2\n4,5,"Loft\nor, twin",1\n5,5,"a\nb",1,"x"\n')
    raw = read_raw_csv(spark, d, "rooms")
    assert [r._malformed for r in raw.orderBy("_seq").collect()] == ["1,5,Loft, big,3", "2,5,Twin", None, None, '5,5,"a\nb",1,"x"']
    assert raw.count() == 5
    assert sorted(r.room_id for r in raw.select("room_id", "_malformed").collect() if r._malformed) == ["1", "2", "5"]
    rooms = transform_rooms(raw, transform_properties(read_raw_csv(spark, d, "properties")))
    assert sorted(r.room_id for r in rooms.clean.collect()) == [3, 4]
    rejects = rooms.rejects.collect()
    assert {r.rejection_reason for r in rejects} == {V.R_MALFORMED}
    assert sorted(r.raw_record for r in rejects)[0] == '{"malformed_row":"1,5,Loft, big,3"}'


def test_extracts_are_compressed_and_stand_in_arrival_order(spark):
    """Lines come in any order, with repeated and null keys; the sort moves no text and the part files are gzip."""
    import datetime as dt
    import glob

    from innflow.plans import roles
    from innflow.plans.roles import RAW_COLUMNS

    day = dt.datetime(2024, 3, 1)
    lines = [(k, n, day + dt.timedelta(days=(k or 0) % 5), p, p % 7, 10.0 * (k or 0) + n)
             for k in (None, *range(300, 0, -1)) for n in (2, 1) for p in (9, 4)]
    line = "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz, l_partkey bigint, l_suppkey bigint, l_extendedprice double"

    class Few(dict):
        pass

    few = Few(nation=spark.createDataFrame([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
              region=spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"),
              supplier=spark.createDataFrame([(2, 1)], "s_suppkey bigint, s_nationkey int"),
              customer=spark.createDataFrame([(3, "C#3", 1)], "c_custkey bigint, c_name string, c_nationkey int"),
              orders=spark.createDataFrame([(k, 3, day) for k in range(1, 301)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
              lineitem=spark.createDataFrame(lines, line).repartition(3))
    few.spark = spark
    folder = tempfile.mkdtemp()
    counts = write_raw_extracts(few, folder)
    assert counts["payments"] == len(lines)
    for t in TABLES:
        parts = glob.glob(f"{folder}/{t}/part-*")
        assert parts and all(p.endswith(".csv.gz") for p in parts)

    def texts(name, df):  # the CSV writer strips values, empty ones are read as NULL
        return [tuple((v or "").strip() or None for v in r) for r in df.orderBy("_seq").select(*RAW_COLUMNS[name]).collect()]

    for name, made in (("payments", "PMT-"), ("reservations", "RES-")):
        arrived = texts(name, read_raw_csv(spark, folder, name))
        assert arrived == texts(name, roles.RAW_BUILDERS[name](few)) and len({r[0] for r in arrived}) > 290
        plan = roles._in_arrival_order(few, name, None)._jdf.queryExecution().optimizedPlan().toString()
        assert made in plan and made not in plan[plan.index("Sort ["):]  # what lies below the sort has no text yet
