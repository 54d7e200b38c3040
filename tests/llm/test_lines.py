"""Line dedup against a dictionary of lines, on the given texts and on odd rows."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from tessera.llm.line_dedup import MIN_CHARS, MIN_DOCS, ascii_lower, dedup_lines, repeated_lines
from tests.llm.conftest import LONG, odd_documents

pytestmark = pytest.mark.usefixtures("few_partitions")
EDGE = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in EDGE.sub("", line))


def by_hand(rows, min_docs=MIN_DOCS, min_chars=MIN_CHARS):
    """Sorted ``(doc_id, kept text, lines, dropped)`` of ``(doc_id, text)`` rows."""
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(d)
    rank = lambda d: (d is not None, d or 0)
    keeper = {k: max(v, key=rank) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key_of(x), d) == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got_of(df, **limits):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped)
                   for r in dedup_lines(df, **limits).collect()), key=repr)


def test_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = got_of(docs)
    assert got == by_hand(rows) and sum(x[3] for x in got) > 0
    assert got_of(docs, min_docs=2, min_chars=10) == by_hand(rows, 2, 10)


def test_odd_documents(spark):
    shared = "The same line of more than forty code points, ünïcödé 😀 too"
    texts = [f"{shared}\nown {i}\n\n \t{shared.upper() if i % 2 else shared}\x0b\n" for i in range(7)]
    texts += [shared, shared + "\r", "x" * 39 + "\n" + "y" * 40, LONG, "\n" * 5, "É" * 45, "é" * 45]
    odd = odd_documents(spark, texts)
    rows = [(r[0], r[1]) for r in odd.collect()]
    assert got_of(odd) == by_hand(rows)
    assert got_of(odd, min_docs=1, min_chars=1) == by_hand(rows, 1, 1)
    assert dedup_lines(odd.limit(0)).count() == 0
    twice = odd.union(odd)                           # repeated rows are no more documents
    assert got_of(twice) == by_hand(rows + rows)


def test_a_document_without_id_counts_once_and_keeps_last(spark):
    line = "a line that stands in four documents and in one more"
    rows = [(1, line), (2, line + "\nb"), (3, line), (4, line), (None, line), (None, "c\n" + line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_of(df) == by_hand(rows)
    assert got_of(df.where("doc_id > 1 or doc_id is null"), min_docs=4) == by_hand(rows[1:], 4)


def test_hot_line_of_all_documents(spark):
    line = "this very common line stands in every one of the documents"
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(
        "\n", F.lit(line), F.col("id").cast("string"), F.lit(line)).alias("text"))
    out = dedup_lines(df)
    assert out.where("n_dropped = 2").count() == 2999
    assert out.where("n_dropped = 0").first().doc_id == 2999
    assert out.where("doc_id = 7").first().text == "7"
    assert repeated_lines(df).select("keeper", "n_docs").distinct().collect() == [(2999, 3000)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                          st.text(alphabet="aAbBé \t\r\n", max_size=30)), max_size=25))
def test_random_texts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_of(df, min_docs=2, min_chars=2) == by_hand(rows, 2, 2)


def test_ascii_lower(spark):
    df = spark.createDataFrame([("AZaz[@`{",), ("ÀÉİ AZ",), ("",)], "s string")
    assert [r[0] for r in df.select(ascii_lower(F.col("s"))).collect()] == ["azaz[@`{", "ÀÉİ az", ""]
