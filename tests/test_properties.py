"""Property test: Spark normalisation equals a plain-Python statement of the rules on random text."""

import re
from decimal import Context, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from innflow.functions import normalize as N

_NUM = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
_WIDE = Context(prec=60)
_INT = re.compile(r"^[+-]?\d+$")


def py_clean(s):
    if s is None:
        return None
    t = s.strip()
    return None if t in ("", "nan") else t


def py_long(s):
    if s is None:
        return None
    t = s.strip()
    if _INT.match(t):
        v = int(t)
        return v if -(2**63) <= v < 2**63 else None
    if _NUM.match(t):
        d = Decimal(t)
        if abs(d) < Decimal(10) ** 20 and d == d.quantize(Decimal(1), context=_WIDE) and -(2**63) <= d < 2**63:
            return int(d)
    return None


pieces = st.sampled_from(["", " ", "\t", " ", "　", "\n", "7", "42", "-", "+", ".", "0", "e", "E", "3",
                          "x", "nan", "1.0", "1e3", ",", "12.5", "99999999999999999999"])
texts = st.one_of(st.none(), st.lists(pieces, max_size=5).map("".join))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=200, max_size=200))
def test_clean_and_long_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", N.clean_str("v").alias("c"), N.to_long("v").alias("n")).collect()
    for r in rows:
        v = values[r.i]
        assert r.c == py_clean(v), (repr(v), r.c)
        if not re.search(r"[eE][+-]?\d{4}", v or ""):  # exponents of any size are out of the plain statement's own range
            assert r.n == py_long(v), (repr(v), r.n)
