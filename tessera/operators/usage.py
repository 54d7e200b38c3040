"""Usage-log cleaning and per-(user, app) usage sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import (evaluate_once, field, is_blank, parse_int, parse_long,
                                       split_once)

# Field positions in a usage line (fixed by the log format).
MDN_IDX, TIMES_IDX, APP_IDX = 0, 12, 15
NULL_MDN = "NULL"

POLICIES = ("strict", "lenient")


def parse_usage(lines: DataFrame) -> DataFrame:
    """``DF[value]`` -> ``DF[mdn, app_id, times]`` with NULL where a field is missing
    or unparsable. ``app_id`` is the re-printed int (``"007"`` -> ``"7"``)."""
    parts = F.col("_parts")
    return evaluate_once(
        split_once(lines.select("value"), "|"),
        field(parts, MDN_IDX).alias("mdn"),
        parse_int(field(parts, APP_IDX)).cast("string").alias("app_id"),
        parse_long(field(parts, TIMES_IDX)).alias("times"))


def usage_filter(policy: str = "strict"):
    """Row predicate over parsed usage.

    strict : drop empty or literal ``NULL`` mdn, app id 0, times -1, and any
             missing/unparsable field.
    lenient: drop only unparsable fields and an empty mdn.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    ok = ~is_blank(F.col("mdn")) & F.col("app_id").isNotNull() & F.col("times").isNotNull()
    if policy == "strict":
        ok = ok & (F.col("mdn") != F.lit(NULL_MDN)) & (F.col("app_id") != F.lit("0")) & (
            F.col("times") != F.lit(-1))
    return ok


def clean_usage(lines: DataFrame, policy: str = "strict") -> DataFrame:
    return parse_usage(lines).where(usage_filter(policy))


def usage_by_user_app(usage: DataFrame) -> DataFrame:
    """``sum(times)`` per (mdn, app_id). Spark plans a partial (map-side) aggregate
    before the shuffle, so a user with a huge share of the log lines still sends
    at most one row per (task, app) across the network."""
    return usage.groupBy("mdn", "app_id").agg(F.sum("times").alias("times"))


def distinct_users(usage: DataFrame) -> DataFrame:
    """Number of distinct users (two-phase distinct aggregate, no driver collect)."""
    return usage.agg(F.countDistinct("mdn").alias("users"))


def record_counts(usage: DataFrame, store: DataFrame) -> DataFrame:
    """Row counts as ``(metric, n)``: cleaned log rows, usage sums, stored
    profiles and their union (the merged input of the profile job).

    The log is read once (rows are counted inside the per-(user, app)
    aggregate); the result is a single action over two one-row aggregates."""
    u = (usage.groupBy("mdn", "app_id").agg(F.count(F.lit(1)).alias("c"))
         .agg(F.sum("c").alias("usage_rows"), F.count(F.lit(1)).alias("usage_sums"))
         .withColumn("stored_profiles", F.lit(0).cast("bigint")))
    s = store.agg(F.count(F.lit(1)).alias("stored_profiles")).select(
        F.lit(0).cast("bigint").alias("usage_rows"), F.lit(0).cast("bigint").alias("usage_sums"),
        "stored_profiles")
    t = u.unionByName(s).agg(*[F.sum(c).cast("bigint").alias(c)
                               for c in ("usage_rows", "usage_sums", "stored_profiles")])
    return t.select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("n"))
          for c in ("usage_rows", "usage_sums", "stored_profiles")],
        F.struct(F.lit("merged_rows").alias("metric"),
                 (F.col("usage_sums") + F.col("stored_profiles")).alias("n")))))
