"""App tag library: parse, deduplicate (last line wins), join to usage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import field, parse_double, required, split_once
from tessera.operators.skew import salted_left_join
from tessera.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS, materialize, measured_side

TAG_VALUES = ("male", "female", "age1", "age2", "age3", "age4", "age5")
TAG_COLUMNS = ("app_id", "name") + TAG_VALUES


def parse_tags(lines: DataFrame, order_col: str | None = "line_no") -> DataFrame:
    """``app_id|name|male|female|age1..age5`` -> typed columns.

    The seven values must parse as Java doubles: a malformed tag line fails the
    job, as in the reference, instead of silently skewing every profile.
    ``app_id`` stays the raw string (``"007"`` is not ``"7"``).
    """
    parts = F.col("_parts")
    cols = [field(parts, 0).alias("app_id"), field(parts, 1).alias("name")]
    cols += [required(parse_double(field(parts, i + 2)), f"tag {v}", "double").alias(v)
             for i, v in enumerate(TAG_VALUES)]
    if order_col is not None:
        cols.append(F.col(order_col))
    return split_once(lines, "|").select(*cols)


def dedupe_last_wins(tags: DataFrame, order_col: str = "line_no") -> DataFrame:
    """Keep, per app id, the row with the greatest ``order_col`` (a map ``put``
    per line keeps the last one). ``max_by`` is a partial aggregate, so even an
    app id repeated on a third of all lines is combined map-side first."""
    payload = F.struct(*[F.col(c) for c in TAG_COLUMNS[1:]])
    return (tags.groupBy("app_id")
            .agg(F.max_by(payload, F.col(order_col)).alias("t"))
            .select("app_id", *[F.col("t." + c).alias(c) for c in TAG_COLUMNS[1:]]))


def tag_library(lines: DataFrame, order_col: str = "line_no") -> DataFrame:
    return dedupe_last_wins(parse_tags(lines, order_col), order_col)


def join_tags(usage_sums: DataFrame, tags: DataFrame,
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
              max_library_rows: int | None = None) -> DataFrame:
    """Left join of (mdn, app_id, times) to the tag values; a miss keeps the row
    with NULL tag values. The library is broadcast only after its size has been
    measured. A user has at most as many tagged apps as the library has rows; callers
    that build an array per user give the bound that they rely on as ``max_library_rows``."""
    side, rows, small = measured_side(tags.select("app_id", *TAG_VALUES), max_broadcast_rows)
    if max_library_rows is not None and rows > max_library_rows:
        raise ValueError(f"the tag library has {rows} rows, above the {max_library_rows} that an "
                         "array per user may hold; fold with fold_mode='sorted'")
    side = F.broadcast(side) if small else side
    return usage_sums.join(side, "app_id", "left").select("mdn", "app_id", "times", *TAG_VALUES)


def join_tags_salted(usage_sums: DataFrame, tags: DataFrame, partitions: int | None = None) -> DataFrame:
    """``join_tags`` for a library that may not be broadcast: apps that hold more than a
    partition's share of the rows are spread over salts, their tag rows repeated."""
    spark = usage_sums.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    probe, _, _ = materialize(usage_sums.select("mdn", "app_id", "times"))
    side = tags.select("app_id", *TAG_VALUES)
    return salted_left_join(probe, side, "app_id", F.col("mdn"), n).select(
        "mdn", "app_id", "times", *TAG_VALUES)
