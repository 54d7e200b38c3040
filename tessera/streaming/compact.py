"""Merge the small files of archived hours into few large ones, again and again.

A run rewrites, for every hour that has new files, these and the hour's earlier compacted
files as ``ceil(rows / rows_per_file)`` files, all hours in one job. Each hour is then
published by one commit record (``manifest``) that names the new files and everything they
replace. Before the record readers see the old files, after it the new ones; replaced files
of the archive are deleted only when asked, replaced compacted files always, and both only
after their record. So a crash between any two steps loses and repeats nothing: files without
a record are deleted by the next run, and deletions that were cut short are made up by it.
Rows that the archive stream commits to an hour later, or meanwhile, stay in its own files
until the next run.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.orders import ORDER_COLUMNS
from tessera.plans.commitlog import delete_paths, list_files, move_path
from tessera.streaming.manifest import hour_log, hour_state, latest_records
from tessera.streaming.orders import (HOUR_BUCKET, HOUR_PARTITIONS, partition_names, read_archive,
                                      read_compacted_files, read_sink, sink_files)

DEFAULT_ROWS_PER_FILE = 5_000_000
ARCHIVE_MARK = "_ARCHIVE"        # file in the output folder that names its archive


def hour_path(root: str, year: str, month: str, day: str, hour: str) -> str:
    return f"{root.rstrip('/')}/{year}/{month}/{day}/{hour}"


def archived_hours(spark: SparkSession, archive_root: str, layout: str = "ymdh") -> DataFrame:
    """Distinct hour buckets present in the archive (one row per hour)."""
    return read_archive(spark, archive_root, layout).select(*partition_names(layout)).distinct()


def _hour(layout: str) -> Column:
    return F.col(HOUR_BUCKET) if layout == "hourly" else F.concat_ws("-", *HOUR_PARTITIONS)


def _hour_of_file(name: str) -> str:
    """``yyyy-MM-dd-HH`` of a file of the sink, from its partition folders."""
    values = dict(p.split("=", 1) for p in name.split("/") if "=" in p)
    return values.get(HOUR_BUCKET) or "-".join(values[c] for c in HOUR_PARTITIONS)


def _rewrite(spark: SparkSession, archive_root: str, staging: str, inputs: dict[str, list[str]],
             outputs: dict[str, list[str]], rows_per_file: int, layout: str) -> dict[str, int]:
    """Write all hours' rows to ``staging/hour=.../``; returns the rows of each hour.

    Every output file is one task, whatever the number of hours or the size of one: rows
    are dealt to an hour's files by their place in their input file, evenly and the same
    way in every attempt."""
    deal = F.xxhash64(F.col("_metadata.file_path")) + F.col("_metadata.row_index")
    fresh = spark.read.schema(read_sink(spark, archive_root, layout).schema).option(
        "basePath", archive_root).parquet(*[f for x in inputs.values() for f in x])
    rows = fresh.select(*ORDER_COLUMNS, _hour(layout).alias("hour"), deal.alias("deal"))
    earlier = [f for x in outputs.values() for f in x]
    if earlier:
        old = spark.read.schema(fresh.select(*ORDER_COLUMNS).schema).parquet(*earlier)
        at = F.split(F.col("_metadata.file_path"), "/")
        rows = rows.unionByName(old.select("*", F.concat_ws(
            "-", *[F.element_at(at, i) for i in (-5, -4, -3, -2)]).alias("hour"), deal.alias("deal")))
    counts = {r.hour: r["count"] for r in rows.groupBy("hour").count().collect()}   # a row per hour
    plan, first = [], 0
    for hour, n in sorted(counts.items()):
        files = max(1, math.ceil(n / rows_per_file))
        plan.append((hour, first, files))
        first += files
    if not plan:
        return counts
    table = F.broadcast(spark.createDataFrame(plan, "hour string, first int, files int"))
    dealt = rows.join(table, "hour").withColumn(
        "file", F.col("first") + F.pmod(F.col("deal"), F.col("files")).cast("int"))
    (dealt.repartitionById(first, F.col("file")).drop("first", "files", "file", "deal")
     .write.mode("overwrite").partitionBy("hour").parquet(staging))
    return counts


def _mark(spark: SparkSession, out_root: str, archive_root: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(out_root, ARCHIVE_MARK)
    out = path.getFileSystem(conf).create(path, True)
    out.write(bytearray(archive_root.encode("utf-8")))
    out.close()


def _marked_archive(spark: SparkSession, out_root: str) -> str | None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(out_root, ARCHIVE_MARK)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def compact_hours(spark: SparkSession, archive_root: str, out_root: str,
                  hours: list[str] | None = None, rows_per_file: int = DEFAULT_ROWS_PER_FILE,
                  delete_inputs: bool = False, layout: str = "ymdh") -> dict[str, str]:
    """Compact ``hours`` (``yyyy-MM-dd-HH``; all by default) and return, for each hour that
    is compacted then, the folder of its files. Hours without new files stay as they are."""
    committed: dict[str, list[str]] = {}
    for name in sink_files(read_sink(spark, archive_root, layout)):
        committed.setdefault(_hour_of_file(name), []).append(name)
    chosen = sorted(committed) if hours is None else hours
    missing = [h for h in chosen if h not in committed]
    if missing:
        raise ValueError(f"the archive holds no committed file of {', '.join(missing)}")
    state = {h: hour_state(spark, archive_root, h) for h in chosen}
    fresh = {h: sorted(set(committed[h]) - set(state[h]["replaced"])) for h in chosen}
    todo = [h for h in chosen if fresh[h]]
    if todo:
        _mark(spark, out_root, archive_root)
        staging = f"{out_root.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
        rows = _rewrite(spark, archive_root, staging, {h: fresh[h] for h in todo},
                        {h: state[h]["outputs"] for h in todo}, rows_per_file, layout)
        for h in todo:
            gen, outputs = state[h]["gen"] + 1, []
            folder = hour_path(out_root, *h.split("-"))
            # what no record names is left from a run that ended before its record
            delete_paths(spark, sorted(set(list_files(spark, folder)) - set(state[h]["outputs"])))
            if rows.get(h):                      # an hour of empty files has nothing to move
                for i, f in enumerate(list_files(spark, f"{staging}/hour={h}")):
                    name = f"{folder}/gen-{gen:06d}-{i:05d}.parquet"
                    move_path(spark, f, name)
                outputs = [f for f in list_files(spark, folder) if f"/gen-{gen:06d}-" in f]
            record = {"gen": gen, "rows": rows.get(h, 0), "outputs": outputs,
                      "replaced": sorted({*state[h]["replaced"], *fresh[h]}),
                      "retired": state[h]["outputs"]}
            if not hour_log(spark, archive_root, h).commit(gen, record):
                raise RuntimeError(f"hour {h} is being compacted by another run")
            state[h] = record
        delete_paths(spark, [staging])
    delete_paths(spark, [f for s in state.values() for f in s["retired"]])
    if delete_inputs:
        delete_paths(spark, [f for s in state.values() for f in s["replaced"]])
    return {h: hour_path(out_root, *h.split("-")) for h, s in state.items() if s["outputs"]}


def compact_hour(spark: SparkSession, archive_root: str, out_root: str, year: str, month: str,
                 day: str, hour: str, rows_per_file: int = DEFAULT_ROWS_PER_FILE,
                 delete_inputs: bool = False, layout: str = "ymdh") -> str:
    """Compact one hour to ``out_root/yyyy/MM/dd/HH`` and return that folder."""
    compact_hours(spark, archive_root, out_root, [f"{year}-{month}-{day}-{hour}"], rows_per_file,
                  delete_inputs, layout)
    return hour_path(out_root, year, month, day, hour)


def compact_all(spark: SparkSession, archive_root: str, out_root: str,
                rows_per_file: int = DEFAULT_ROWS_PER_FILE, layout: str = "ymdh",
                delete_inputs: bool = False) -> list[str]:
    """Compact every archived hour, in one job."""
    done = compact_hours(spark, archive_root, out_root, None, rows_per_file, delete_inputs, layout)
    return [done[h] for h in sorted(done)]


def read_compacted(spark: SparkSession, out_root: str, layout: str = "ymdh") -> DataFrame:
    """The rows of the latest compacted files of every hour."""
    archive_root = _marked_archive(spark, out_root)
    if archive_root is None:
        raise FileNotFoundError(f"nothing was compacted to {out_root}")
    files = [r[0] for r in latest_records(spark, archive_root).select(
        F.explode("outputs")).toLocalIterator()]
    if not files:
        return spark.createDataFrame([], read_sink(spark, archive_root, layout).schema)
    return read_compacted_files(spark, files, layout)
