"""Property-based checks: each property draws a whole batch of cases with
hypothesis and evaluates it in one Spark job against a plain-Python model."""

import re
from datetime import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registrum.functions.columns import exact_digits, prefix_in, strip_whitespace
from registrum.operators.merge import keep_last
from registrum.spec import REGION_DEPARTMENTS

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"
TEXT = st.text(alphabet=st.sampled_from(SPACES + "0123456789ax7é"), max_size=8)
SETTINGS = settings(max_examples=15, deadline=None)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_strip_matches_python_strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(strip_whitespace(F.col("s"))).collect()]
    assert got == [v.strip() for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_exact_digits_is_ascii_five_digits(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(exact_digits(F.col("s"), 5)).collect()]
    assert got == [v is not None and re.fullmatch(r"[0-9]{5}", v) is not None for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 x", max_size=5)), min_size=1, max_size=40))
def test_prefix_in_equals_substring_in(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [bool(r[0]) for r in df.select(prefix_in(F.col("s"), REGION_DEPARTMENTS)).collect()]
    assert got == [v is not None and v[:2] in REGION_DEPARTMENTS for v in values]


ROW = st.tuples(
    st.sampled_from(["k1", "k2", "k3", "k4"]),
    st.integers(min_value=1, max_value=4),
    st.integers(min_value=0, max_value=1),
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
)


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=30))
def test_keep_last_is_max_by_order_then_row(spark, rows):
    df = spark.createDataFrame(
        [(k, datetime(2026, 1, d), src, v) for k, d, src, v in rows],
        "k string, ingested_at timestamp_ntz, src int, v string",
    )
    got = {r.k: (r.ingested_at.day, r.src, r.v) for r in keep_last(df, ["k"], ["ingested_at", "src"]).collect()}
    want = {}
    for k, d, src, v in rows:
        cand = (d, src, v)
        cur = want.get(k)
        # NULL orders lowest, as in ORDER BY ... DESC NULLS LAST
        key = lambda t: (t[0], t[1], t[2] is not None, t[2] or "")
        if cur is None or key(cand) > key(cur):
            want[k] = cand
    assert got == want
