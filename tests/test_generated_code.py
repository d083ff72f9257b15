"""The generated method of a row stays short enough for the JVM to compile it: a longer one is interpreted, for every row."""

import re

import pytest
from pyspark.sql import functions as F

from innflow.functions import normalize as N
from innflow.functions import vocab as V
from innflow.operators.mess import format_variant
from innflow.plans import entities as E

COMPILED_UP_TO = 8000  # bytes of bytecode (HotSpot's HugeMethodLimit)


@pytest.fixture()
def longest_method(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it runs, without re-planning

    def measure(df):
        debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
        text = debug.codegenString(df._jdf.queryExecution().executedPlan())
        return max((int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0)

    yield measure
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def _parent(spark, name, small, kind="bigint"):
    key = E.KEYS[name]
    result = E.EntityResult(name, None, None)
    result.__dict__.update(keys_small=small, clean=spark.range(3).select(F.col("id").cast(kind).alias(key)))
    return result


@pytest.mark.parametrize("small", [True, False])
def test_methods_of_the_cleaning_are_compiled(spark, rows_df, longest_method, monkeypatch, tmp_path, small):
    """Also with parents that are looked up in bitmaps."""
    monkeypatch.setattr(E, "stage", lambda df, run_dir, name: df)
    raws = {n: rows_df([{}], E.RAW_COLUMNS[n]) for n in ("reservations", "payments", "guests", "rooms")}
    parents = {n: _parent(spark, n, small, "string" if n == "reservations" else "bigint") for n in ("guests", "properties", "rooms", "reservations")}
    frames = {
        "reservations": E.transform_reservations(raws["reservations"], parents["guests"], parents["properties"], parents["rooms"], str(tmp_path)),
        "payments": E.transform_payments(raws["payments"], parents["reservations"], str(tmp_path)),
        "rooms": E.transform_rooms(raws["rooms"], parents["properties"], str(tmp_path)),
        "guests": E.transform_guests(raws["guests"], str(tmp_path)),
    }
    assert {n: longest_method(e.classified) for n, e in frames.items() if longest_method(e.classified) > COMPILED_UP_TO} == {}


def _first_of_each(fmt, text):
    """(Y, M, D, T, A, O) that one pattern alone reads, or None."""
    rx, groups = N._format_regex(fmt)
    found = re.fullmatch(rx, text)
    return found and {g: t for g, t in zip(groups, found.groups(), strict=True)}


@pytest.mark.parametrize("formats", [V.DATE_FORMATS + V.DATE_FALLBACK_FORMATS, V.TIMESTAMP_FORMATS + V.TIMESTAMP_FALLBACK_FORMATS])
def test_first_listed_format_wins_in_the_joint_expression(formats):
    numbers = ("01", "1", "9", "12", "13", "31", "32")
    dates = [f"{a}{s}{b}{s}2025" for a in numbers for b in numbers for s in "/-. "] + [f"2025{s}{a}{s}{b}" for a in numbers for b in numbers for s in "/-."]
    dates += [f"{a}{s}#3{s}2025" for a in numbers for s in "- "] + [f"#3 {a}{s} 2025" for a in numbers for s in ("", ",")] + ["20250131", "20251301"]
    times = ["", " 7:05", "  7:05:09", "t07:05", "t7:05:09z", " 7:05:09.5", " 12:05 am", " 1:05:09 pm", " 13:05 pm", " 7:05+02:00", " 7:05:09-0130", "t7:05:09.25z"]
    rx, rewrite = N.formats_regex(formats)
    joint = re.compile(rx)
    order = {k: [int(n) for n in re.findall(r"\d+", part)] for k, part in zip("YMDTAO", re.split(r"[@|\- ]+", rewrite)[1:], strict=True)}
    matched = 0
    for text in (d + t for d in dates for t in times):
        first = next((g for g in (_first_of_each(f, text) for f in formats) if g), None)
        found = joint.fullmatch(text)
        got = found and {k: v for k, ns in order.items() if (v := "".join(found.group(n) or "" for n in ns))}
        assert got == first, text
        matched += bool(first)
    assert matched > 500


def test_variants_are_rendered_by_their_own_pattern(spark):
    df = spark.sql("select * from values (0L, timestamp_ntz'2025-03-04 15:06:07'), (4L, timestamp_ntz'2025-03-04 15:06:07'), (-1L, null), (null, timestamp_ntz'2025-03-04 15:06:07') as t(i, ts)")
    got = [r[0] for r in df.select(format_variant(F.col("ts"), F.col("i"), ["yyyy-MM-dd", "dd/MM/yyyy HH:mm", "hh a"])).collect()]
    assert got == ["2025-03-04", "04/03/2025 15:06", None, None]
