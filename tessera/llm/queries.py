"""Registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.chosen_path import jaccard_classes
from tessera.llm.common import let, pick, words, written
from tessera.llm.hilbert import shard_rows
from tessera.llm.hnsw import near_duplicates
from tessera.llm.html_text import extract
from tessera.llm.langid import identify
from tessera.llm.licenses import document_paths, scan
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.mixing import mix
from tessera.llm.pii import pii_digest
from tessera.llm.quality import quality
from tessera.llm.runs import word_runs
from tessera.llm.sentencepiece import encode
from tessera.llm.trie import keyed_turns, trie


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_langid(spark: SparkSession, sf: str) -> DataFrame:
    return identify(_table(spark, sf, "documents"))


def op2_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return scan(document_paths(_table(spark, sf, "documents")))


def op3_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return encode(_table(spark, sf, "documents"))


def op4_hilbert_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = shard_rows(_table(spark, sf, "documents"), shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op5_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "embeddings"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(_table(spark, sf, "documents"), _table(spark, sf, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_chosen_path(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf, "documents"))


def op8_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract(_table(spark, sf, "pages"))


def op9_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target",
                                                      "taken")


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii_digest(_table(spark, sf, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where every document with h % 10 = 0, h = crc32 of its id, becomes
    periodic from word a on: ``g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8)``."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), times))
        return F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), tail), F.lit(1), n), " ")

    changed = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(""))
    return pick(docs, "doc_id", "text").select(
        "doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = word_runs(with_periods(_table(spark, sf, "documents")))
    # the greatest length; of equal ones the smallest start, then the smallest period
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast(
        "string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("top.length * 1000 div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def rebuilt_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` and ``members`` of ``trie``: conversation c takes the first h turns (all, if
    there are fewer) of conversation ``c - c % 5``, h = crc32 of its id % 9, and its own
    turns after its first h."""
    placed = written(keyed_turns(conversations), "rebuilt-turns")
    counts = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    own = counts.select("conv_id", "n", h.alias("h"),
                        (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    taken = F.least(F.col("h"), F.coalesce(F.col("base_n"), F.lit(0)))
    plan = written(own.join(counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")),
                            "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "rebuilt-plan")
    first = placed.where("pos <= 8").withColumnRenamed("conv_id", "base").join(
        plan.select("conv_id", "base", "taken"), "base").where("pos <= taken").select(
        "conv_id", F.col("pos").alias("depth"), "digest", "n_bytes")
    rest = placed.join(plan.select("conv_id", "h", "taken"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes")
    return first.unionByName(rest), plan.select("conv_id", "length")


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return trie(*rebuilt_conversations(_table(spark, sf, "conversations")))


def op13_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_lines(_table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_licenses": op2_licenses,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_hnsw": op5_hnsw,
    "op6_quality": op6_quality,
    "op7_chosen_path": op7_chosen_path,
    "op8_html_text": op8_html_text,
    "op9_mix_sources": op9_mix_sources,
    "op10_pii": op10_pii,
    "op11_word_runs": op11_word_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}
