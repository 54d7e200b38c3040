"""Line dedup: lines that stand in many documents are dropped everywhere but in one.

Lines are exploded and normalised to a key, keys are hashed (128 bits), documents are
counted per hash, and a text is put together again from the positions that stay.

Only hashes and positions are shuffled on the way. Three passes over the texts: the first
counts the lines of each hash (combined map-side, so a line of a third of all documents is
one row per task); the second keeps the positions of those lines that occur at least
``min_docs`` times, a superset of the lines to drop; documents are counted on these only.
The third pass gives every text its list of positions to drop. A list is no longer than its
text has lines. Joins are left to Spark: while the tables of hashes and of lists are small
it broadcasts them, beyond that they are shuffle joins whose hot keys it splits.

Edge cases: a null or empty text is one empty line. Rows of equal ``doc_id`` are one
document where documents are counted, and each gives a row of its own. A null ``doc_id`` is
one document that ranks below all others. The key is the line
without blanks at both ends, A-Z lower-cased. A line that is repeated within a text goes or
stays with all its repeats. An empty table gives an empty result; columns other than
``doc_id`` and ``text`` are ignored. A text is held whole in one row, its lines as one array.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, pick, written

MIN_DOCS = 5                     # a key found in fewer documents keeps all its lines
MIN_CHARS = 40                   # shorter keys (code points) keep all their lines
BLANKS = " \t\n\x0b\f\r"


def ascii_lower(value: Column) -> Column:
    """A-Z lower-cased. ``lower`` does the same, much faster, where all is ASCII."""
    exact = F.translate(value, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(value) == F.octet_length(value), F.lower(value)).otherwise(exact)


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_id(text: Column) -> Column:
    """Tells the texts of one ``doc_id`` apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, of, pos, h``: one row per line whose key is long enough; ``of`` is the
    text's hash, ``pos`` counts from 0."""
    lines = pick(docs, "doc_id", "text").select(
        "doc_id", _text_id(F.col("text")).alias("of"),
        F.posexplode(_split(F.col("text"))).alias("pos", "line"))
    # most short lines go before they are stripped; the generator strips the others once
    stripped = lines.where(F.length("line") >= min_chars).select(
        "doc_id", "of", "pos", F.explode(F.array(F.btrim("line", F.lit(BLANKS)))).alias("cut"))
    return stripped.where(F.length("cut") >= min_chars).select(
        "doc_id", "of", "pos", F.unhex(F.md5(ascii_lower(F.col("cut")).cast("binary"))).alias("h"))


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS,
                   min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, of, pos, h, n_docs, keeper``: every line whose key is found in at least
    ``min_docs`` documents; ``keeper`` is the largest ``doc_id`` that holds it."""
    lines = hashed_lines(docs, min_chars)
    often = written(lines.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
                    .select("h"), "line-often")
    hits = written(lines.join(often, "h"), "line-hits")
    without_id = F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    keys = written(hits.groupBy("h").agg(
        (F.count_distinct("doc_id") + without_id).alias("n_docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("n_docs") >= min_docs), "line-keys")
    return hits.join(keys, "h")


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: each document with the lines that stay, joined
    by a line feed; ``n_lines`` counts before dropping."""
    lost = repeated_lines(docs, min_docs, min_chars).where(
        ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    lists = written(lost.groupBy("doc_id", "of").agg(F.collect_set("pos").alias("gone"))
                    .withColumnsRenamed({"doc_id": "__id", "of": "__of"}), "line-lists")
    texts = pick(docs, "doc_id", "text").withColumn("of", _text_id(F.col("text")))
    joined = texts.join(lists, F.col("doc_id").eqNullSafe(F.col("__id"))
                        & (F.col("of") == F.col("__of")), "left")

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    whole = F.coalesce(F.col("text"), F.lit(""))
    kept = F.when(F.col("gone").isNull(), whole).otherwise(let(_split(F.col("text")), rest))
    return joined.select("doc_id", kept.alias("text"),
                         F.size(_split(F.col("text"))).cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
