"""Joins without a broadcast side whose hot keys are spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SUPPORT = 1e-4               # least share of the rows that the frequency sketch can ask for


def hot_keys(df: DataFrame, key: str, partitions: int) -> list[tuple[int, list]]:
    """``(salts, keys)`` tiers of the keys that hold more than a partition's share of rows.

    A frequency sketch (``freqItems``, one pass, at most ``1 / support`` entries) proposes
    every key above its support, and maybe others; only these are counted. A key of n rows
    gets the power of two of salts from ``n * partitions / rows`` on, so all hot keys
    together have at most ``2 * (partitions + hot keys)`` salts.
    """
    support = max(MIN_SUPPORT, min(1.0, 1.0 / partitions))
    proposed = [k for k in df.stat.freqItems([key], support).first()[0] or [] if k is not None]
    counted = df.groupBy(F.when(F.col(key).isin(proposed), F.col(key)).alias("k")).count().collect()
    total = sum(r["count"] for r in counted)
    tiers: dict[int, list] = {}
    for r in counted:
        if r.k is not None and r["count"] * partitions > total:
            salts = 1 << (-(-r["count"] * partitions // total) - 1).bit_length()
            tiers.setdefault(salts, []).append(r.k)
    return sorted((s, sorted(keys)) for s, keys in tiers.items())


def salts_of(key: Column, tiers: list[tuple[int, list]]) -> Column:
    """The number of salts of a key; 1 if it is not hot."""
    out = F.lit(1)
    for salts, keys in tiers:
        out = F.when(key.isin(keys), F.lit(salts)).otherwise(out)
    return out


def salted(df: DataFrame, key: str, tiers: list[tuple[int, list]], spread: Column,
           name: str = "_salt") -> DataFrame:
    """The probe side: each row gets one of its key's salts, by the hash of ``spread``."""
    return df.withColumn(name, F.pmod(F.xxhash64(spread), salts_of(F.col(key), tiers)).cast("int"))


def replicated(df: DataFrame, key: str, tiers: list[tuple[int, list]],
               name: str = "_salt") -> DataFrame:
    """The other side: each row once per salt of its key."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), salts_of(F.col(key), tiers) - 1)))


def salted_left_join(probe: DataFrame, side: DataFrame, key: str, spread: Column,
                     partitions: int) -> DataFrame:
    """``probe`` left join ``side`` on ``key`` by a sort-merge join on (key, salt).

    Rows of ``probe`` are read three times: let it be a table. Equal ``spread`` values of a
    hot key stay together.
    """
    tiers = hot_keys(probe, key, partitions)
    right = replicated(side, key, tiers).withColumnRenamed(key, "_key").withColumnRenamed(
        "_salt", "_side_salt")
    left = salted(probe, key, tiers, spread)
    joined = left.join(right.hint("merge"), (F.col(key) == F.col("_key"))
                       & (F.col("_salt") == F.col("_side_salt")), "left")
    return joined.drop("_key", "_salt", "_side_salt")
