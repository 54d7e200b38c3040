"""Hash partitioning by user and per-partition statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_by_user(df: DataFrame, num_partitions: int, key: str = "mdn") -> DataFrame:
    """Hash-partition (Murmur3) so all rows of a user land in one partition."""
    return df.repartition(num_partitions, key)


def user_partition(num_partitions: int, key: str = "mdn") -> Column:
    """The partition of a user by a hash of our own: the first 32 bits of the MD5 of the
    key modulo ``num_partitions``. Unlike Murmur3 any SQL engine has it, so what stands in
    each partition can be said, and checked, outside of Spark."""
    head = F.conv(F.substring(F.md5(F.coalesce(F.col(key), F.lit("")).cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(num_partitions)).cast("int")


def partition_by_user_md5(df: DataFrame, num_partitions: int, key: str = "mdn") -> DataFrame:
    """Deal the rows to the partitions that ``user_partition`` names."""
    return df.repartitionById(num_partitions, user_partition(num_partitions, key))


def partition_report(df: DataFrame, key: str = "mdn") -> DataFrame:
    """Rows and distinct users per physical partition of ``df`` (no collect)."""
    return (df.select(F.spark_partition_id().alias("partition"), F.col(key))
            .groupBy("partition")
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("users")))


def placement(df: DataFrame, key: str = "mdn") -> DataFrame:
    """What hash partitioning promises, whatever the number of partitions: all rows and
    users are there, and no user is in more than one partition."""
    per_user = df.select(F.spark_partition_id().alias("p"), F.col(key)).groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("p").alias("p"))
    return per_user.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        F.count(F.lit(1)).alias("users"),
                        F.max("p").alias("partitions_per_user"))
