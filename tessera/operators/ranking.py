"""Exact ranks under a total order, without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import scratch_path

_ROW_BITS = 33      # monotonically_increasing_id: partition number above, row number below


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the 1-based place of each row in the global order.

    The rows are range-partitioned and sorted once and written under the shared checkpoint
    folder, each with its place in its partition. A partition starts behind the rows of all
    partitions before it; these starts are one row per partition, so their broadcast is
    bounded by ``spark.sql.shuffle.partitions``. Sampled range bounds may differ between
    attempts, hence the written table. Rows that tie in ``order`` get their ranks in any
    order.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranked")
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return rows.join(F.broadcast(starts), "_part").select(*df.columns, place.alias(name))
