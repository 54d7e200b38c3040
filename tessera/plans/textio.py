"""``|``-separated text forms of the profile and of the usage sums.

These are the hand-off formats between the reference's chained jobs; here they
are a ``concat_ws`` on the way out and a split + parse on the way back. Doubles
are written with Spark's shortest round-trip text, so a round trip is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import (evaluate_once, field, parse_double, parse_long, required,
                                       split_once)
from tessera.operators.profile import PROFILE_VALUES, tagged_union


def profile_to_text(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.concat_ws("|", F.col("mdn"), *[F.col(n).cast("string")
                                                           for n in PROFILE_VALUES]).alias("value"))


def profile_from_text(lines: DataFrame) -> DataFrame:
    """The first 8 fields of each line; a missing field or a value that is not a Java
    double (NaN is one) fails the job, so no stored profile is lost silently."""
    parts = F.col("_parts")
    vals = [required(parse_double(field(parts, i + 1)), f"stored {n}", "double").alias(n)
            for i, n in enumerate(PROFILE_VALUES)]
    return evaluate_once(split_once(lines.select("value"), "|"),
                         required(field(parts, 0), "stored mdn", "string").alias("mdn"), *vals)


def usage_sums_to_text(sums: DataFrame) -> DataFrame:
    return sums.select(F.concat_ws("|", "mdn", "app_id", F.col("times").cast("string")).alias("value"))


def usage_sums_from_text(lines: DataFrame) -> DataFrame:
    """Only lines with exactly three fields are usage sums; the app id is kept as
    written and a time that is not a Java long fails the job."""
    parts = F.col("_parts")
    times = parse_long(field(parts, 2))
    return split_once(lines.select("value"), "|").where(F.size(parts) == 3).select(
        field(parts, 0).alias("mdn"), field(parts, 1).alias("app_id"),
        F.coalesce(times, F.raise_error(F.lit("usage sum time is not a long")).cast("bigint"))
        .alias("times"))


def write_text(df: DataFrame, path: str) -> str:
    df.select("value").write.mode("overwrite").text(path)
    return path


def tagged_from_text(lines: DataFrame) -> DataFrame:
    """One read over stored-profile text and usage-sum text (``source`` column
    from the path, see ``sources.text.read_tagged_paths``) -> the typed tagged
    relation of ``operators.profile.tagged_union``."""
    store = profile_from_text(lines.where(F.col("source") == "store").select("value"))
    sums = usage_sums_from_text(lines.where(F.col("source") == "log").select("value"))
    return tagged_union(store, sums)
