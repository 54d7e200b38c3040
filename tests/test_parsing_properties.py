"""Randomised parity of the parsing expressions with small models of the Java rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import parsing as P

MASK = (1 << 64) - 1


def j_split(s, sep):
    """String.split(sep) for a one-char literal separator: trailing empties go."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def j_long(s):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if -(1 << 63) <= v < (1 << 63) else None


def j_ip2long(s):
    acc = 0
    for part in j_split(s, "."):
        x = j_long(part)
        if x is None:
            return None
        shifted = (acc << 8) & MASK
        if shifted >= 1 << 63:
            shifted -= 1 << 64
        acc = x | shifted
    return acc


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v")).alias("r")).collect()]


TOKENS = st.text(alphabet="0123456789|.+- x", max_size=24)
BATCH = st.lists(TOKENS, min_size=60, max_size=60)


@settings(max_examples=8, deadline=None)
@given(BATCH)
def test_split_pipe(spark, values):
    assert run(spark, values, lambda c: P.java_split(c, "|")) == [j_split(v, "|") for v in values]


@settings(max_examples=8, deadline=None)
@given(BATCH)
def test_split_dot_and_space(spark, values):
    assert run(spark, values, lambda c: P.java_split(c, ".")) == [j_split(v, ".") for v in values]
    assert run(spark, values, lambda c: P.java_split(c, " ")) == [j_split(v, " ") for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(TOKENS, st.integers(-(1 << 64), 1 << 64).map(str)), min_size=60,
                max_size=60))
def test_parse_long(spark, values):
    assert run(spark, values, P.parse_long) == [j_long(v) for v in values]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(
    TOKENS,
    st.lists(st.integers(-300, 300), min_size=0, max_size=10).map(
        lambda xs: ".".join(map(str, xs)))), min_size=60, max_size=60))
def test_ip_to_long(spark, values):
    assert run(spark, values, P.ip_to_long) == [j_ip2long(v) for v in values]
