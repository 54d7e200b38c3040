"""Which files hold an hour of the archive: what compaction has replaced, and by what.

Each compacted hour has a commit log of generations under ``<archive>/_compaction/<hour>``.
The latest record names the hour's compacted files and all archive files that they replace,
so every reader sees each row once, whether or not the replaced files are still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.commitlog import CommitLog

FOLDER = "_compaction"
RECORD = "gen bigint, rows bigint, outputs array<string>, replaced array<string>"
NOTHING = {"gen": -1, "rows": 0, "outputs": [], "replaced": [], "retired": []}


def hour_log(spark: SparkSession, archive_root: str, hour: str) -> CommitLog:
    """``hour`` is ``yyyy-MM-dd-HH``."""
    return CommitLog(spark, f"{archive_root.rstrip('/')}/{FOLDER}/{hour}")


def hour_state(spark: SparkSession, archive_root: str, hour: str) -> dict:
    return hour_log(spark, archive_root, hour).last() or NOTHING


def has_manifest(spark: SparkSession, archive_root: str) -> bool:
    log = CommitLog(spark, f"{archive_root.rstrip('/')}/{FOLDER}")
    return log._fs().exists(log._path(log.root))


def latest_records(spark: SparkSession, archive_root: str) -> DataFrame:
    """``hour, gen, rows, outputs, replaced`` of every compacted hour, by one Spark read of
    all records."""
    root = f"{archive_root.rstrip('/')}/{FOLDER}"
    records = CommitLog(spark, root).all().select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3).alias("hour"),
        F.from_json("value", RECORD).alias("r"))
    return records.groupBy("hour").agg(F.max_by("r", "r.gen").alias("r")).select("hour", "r.*")
