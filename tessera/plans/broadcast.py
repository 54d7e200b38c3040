"""Broadcast a join side only after its size has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.session import scratch_path

# Bounds of a broadcast dimension, in rows and in bytes of their values. An app tag
# library or an exploded IP-rule table is far below both; a side above either is joined
# by shuffle.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(schema) -> Column:
    """Size of a row's values: UTF-8 bytes of strings, 8 of a long or double, 4 of an int or
    float; a null has none. The size in memory, not that of compressed files."""
    fixed = {"bigint": 8, "double": 8, "float": 4, "int": 4}
    size = F.lit(0).cast("long")
    for f in schema.fields:
        kind = f.dataType.simpleString()
        one = F.octet_length(F.col(f.name)) if kind == "string" else F.when(
            F.col(f.name).isNotNull(), fixed[kind])
        size = size + F.coalesce(one, F.lit(0)).cast("long")
    return size


def measured_write(df: DataFrame, path: str) -> tuple[int, int]:
    """Write ``df`` and return its rows and the bytes of their values, counted by the write
    itself: no second job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(
        F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes")).write.mode("overwrite").parquet(path)
    got = seen.get
    return got["rows"], got["bytes"]


def materialize(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Write ``df`` once under the shared ``spark.checkpoint.dir`` and return the table,
    its rows and the bytes of their values. The write is as parallel as ``df``; a lost
    executor costs no recomputation afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, "side")
    rows, size = measured_write(df, path)
    return spark.read.schema(df.schema).parquet(path), rows, size


def measured_side(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, int, bool]:
    """``(table, rows, small)``: ``df`` computed once, and whether it is within both bounds
    and may be broadcast; if not, the caller's join is a shuffle join (AQE splits hot keys)."""
    table, rows, size = materialize(df)
    return table, rows, rows <= max_rows and size <= max_bytes
