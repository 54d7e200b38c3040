"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query derives its text inputs from the driver tables (``sources.derived``)
and runs the library's operators over all of them. Floating sums are rounded at
the query boundary (money to 2 digits) because their value depends on the
summation order; the profile fold is computed in a fixed order and not rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import orders as ord_ops
from tessera.operators import profile as prof
from tessera.operators import usage as use
from tessera.operators.appstats import clean_appstats
from tessera.operators.ipgeo import attach_province_sweep, parse_ip_rules
from tessera.operators.partitions import (partition_by_user, partition_by_user_md5,
                                          partition_report, placement)
from tessera.operators.tags import join_tags, join_tags_salted, tag_library
from tessera.plans import jobs
from tessera.plans.commitlog import move_path
from tessera.plans.ledger import DayLedger
from tessera.plans.snapshot import SnapshotStore
from tessera.plans.textio import (profile_from_text, profile_to_text, tagged_from_text,
                                  usage_sums_from_text, usage_sums_to_text, write_text)
from tessera.session import scratch_path
from tessera.sources import derived as d
from tessera.sources.text import (read_lines, read_tagged_paths, stream_folders,
                                  stream_text_dir)
from tessera.streaming import compact as cmp
from tessera.streaming import orders as so
from tessera.streaming.kpi_delta import KpiDeltas, start_kpi_delta_query
from tessera.streaming.rolled import RolledArchive, start_rolled_query


def _money(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(F.col(col), 2))


# --- usage ---------------------------------------------------------------------------

def q_usage_clean(spark: SparkSession, sf: str) -> DataFrame:
    return use.clean_usage(d.usage_lines(spark, sf), "strict")


def q_usage_clean_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return use.clean_usage(d.usage_lines(spark, sf), "lenient")


def q_usage_by_user_app(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.usage_sums(d.usage_lines(spark, sf))


def q_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    return use.distinct_users(use.clean_usage(d.usage_lines(spark, sf)))


def q_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    return use.record_counts(use.clean_usage(d.usage_lines(spark, sf)), d.stored_profiles(spark, sf))


# --- tags and profiles -----------------------------------------------------------------

def q_tag_library(spark: SparkSession, sf: str) -> DataFrame:
    return tag_library(d.tag_lines(spark, sf))


def q_usage_tag_join(spark: SparkSession, sf: str) -> DataFrame:
    return join_tags(jobs.usage_sums(d.usage_lines(spark, sf)), tag_library(d.tag_lines(spark, sf)))


def q_usage_tag_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same join without a broadcast: hot apps are salted."""
    return join_tags_salted(jobs.usage_sums(d.usage_lines(spark, sf)),
                            tag_library(d.tag_lines(spark, sf)))


def q_profile_build(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.profiles_from_logs(d.usage_lines(spark, sf), d.tag_lines(spark, sf))


def q_profile_build_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """The same profile job under the lenient cleaning policy of the other two
    runtimes (keeps app id 0, negative times and a literal NULL mdn)."""
    return jobs.profiles_from_logs(d.usage_lines(spark, sf), d.tag_lines(spark, sf), "lenient")


def q_profile_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot v0 = stored profiles; the day's update writes v1, read back.

    The store is bucketed by mdn into the session's shuffle partition count, so
    the merge reads v0 without an exchange on the snapshot side."""
    root = scratch_path(spark, "profiles")
    store = SnapshotStore(spark, root, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
                          table_prefix="tessera_profiles_" + root.rsplit("-", 1)[-1])
    store.write(d.stored_profiles(spark, sf), 0)
    v = jobs.run_daily_update(store, 0, d.usage_lines(spark, sf), d.tag_lines(spark, sf))
    return store.read(v)


def q_profile_merge_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """The daily merge by secondary sort (``fold_mode='sorted'``): the exact path
    used when the tag library is too large for a proven per-user bound. Same
    result as ``profile_merge``; here on plain Parquet snapshots."""
    store = SnapshotStore(spark, scratch_path(spark, "profiles-sorted"))
    store.write(d.stored_profiles(spark, sf), 0)
    v = jobs.run_daily_update(store, 0, d.usage_lines(spark, sf), d.tag_lines(spark, sf),
                              fold_mode="sorted")
    return store.read(v)


def q_profile_two_days(spark: SparkSession, sf: str) -> DataFrame:
    """Two days' logs (by order key) applied to the stored profiles through the day ledger;
    then both days are run again, the earlier one first, which changes nothing."""
    root = scratch_path(spark, "two-days")
    lines = d.usage_lines(spark, sf, "l_orderkey")
    lines.select("value", (F.col("l_orderkey") % 2).alias("day")).write.partitionBy("day").text(
        f"{root}/logs")
    tags = d.tag_lines(spark, sf)
    ledger = DayLedger(SnapshotStore(spark, f"{root}/store"), lambda base, logs: jobs.profiles_with_store(
        base, read_lines(spark, logs), tags))
    ledger.seed(d.stored_profiles(spark, sf))
    for day in (0, 1, 0, 1):
        ledger.apply(f"day-{day}", [f"{root}/logs/day={day}"])
    return ledger.read()


def q_tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    return prof.tagged_union(d.stored_profiles(spark, sf), jobs.usage_sums(d.usage_lines(spark, sf)))


def q_tagged_union_files(spark: SparkSession, sf: str) -> DataFrame:
    """The multi-input form: stored profiles and usage sums land as ``|`` text in
    two folders and come back through ONE read whose ``source`` is taken from
    the file path (the folder holding the store export is marked)."""
    root = scratch_path(spark, "tagged-files")
    write_text(profile_to_text(d.stored_profiles(spark, sf)), f"{root}/fromstore")
    write_text(usage_sums_to_text(jobs.usage_sums(d.usage_lines(spark, sf))), f"{root}/fromlog")
    lines = read_tagged_paths(spark, [f"{root}/fromstore", f"{root}/fromlog"], "fromstore",
                              "store", "log")
    return tagged_from_text(lines)


def q_update_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return prof.update_sequence(q_tagged_union(spark, sf))


def q_merged_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return prof.merged_sorted(q_tagged_union(spark, sf))


def q_merged_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The global order with every row's rank."""
    return prof.merged_ranked(q_tagged_union(spark, sf))


def q_profile_text(spark: SparkSession, sf: str) -> DataFrame:
    """The chained-job form: usage sums and profiles hop through ``|`` text, among lines of
    two and of four fields, which are no usage sums."""
    root = scratch_path(spark, "profile-text")
    lines = usage_sums_to_text(jobs.usage_sums(d.usage_lines(spark, sf)))
    write_text(lines.select(F.explode(d.with_wrong_widths(F.col("value"))).alias("value")),
               f"{root}/sums")
    sums = usage_sums_from_text(read_lines(spark, f"{root}/sums"))
    profiles = prof.build_profiles(join_tags(sums, tag_library(d.tag_lines(spark, sf))))
    write_text(profile_to_text(profiles), f"{root}/profiles")
    return profile_from_text(read_lines(spark, f"{root}/profiles"))


# --- orders ----------------------------------------------------------------------------

def q_order_etl(spark: SparkSession, sf: str) -> DataFrame:
    return ord_ops.parse_orders(d.order_lines(spark, sf), "strict")


def q_order_etl_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return ord_ops.parse_orders(d.order_lines(spark, sf), "lenient")


def _orders_with_province(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.orders_with_province(d.order_lines(spark, sf), d.ip_rule_lines(spark, sf))


def q_ip_province(spark: SparkSession, sf: str) -> DataFrame:
    return _orders_with_province(spark, sf)


def q_ip_province_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The same lookup without a broadcast: rules and orders are swept in address order."""
    return attach_province_sweep(q_order_etl(spark, sf), parse_ip_rules(d.ip_rule_lines(spark, sf)))


def q_order_total(spark: SparkSession, sf: str) -> DataFrame:
    return _money(ord_ops.order_total(q_order_etl(spark, sf)))


def q_order_by_province(spark: SparkSession, sf: str) -> DataFrame:
    return _money(ord_ops.order_by_province(_orders_with_province(spark, sf)))


def q_order_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return _money(ord_ops.order_by_category(q_order_etl(spark, sf)))


def q_order_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return _money(ord_ops.order_kpis(_orders_with_province(spark, sf)))


def _order_source_dir(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Land the derived order lines as text files: the stream's input folder.

    One file per partition of the derived lines (line items are hash-partitioned
    by order key into ``spark.sql.shuffle.partitions``), so the landing write
    is as parallel as the session. Returns the folder and the file count."""
    src = scratch_path(spark, "order-src")
    lines = d.order_lines(spark, sf)
    lines.write.text(src)
    return src, len(spark.read.text(src).inputFiles())


def _two_batches(n_files: int) -> int:
    """Files per trigger so the stream runs in (about) two micro-batches: the
    second batch updates state written by the first."""
    return max(1, -(-n_files // 2))


def q_order_kpi_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming KPIs over the landed lines in two micro-batches."""
    root = scratch_path(spark, "order-kpi")
    src, n_files = _order_source_dir(spark, sf)
    lines = stream_text_dir(spark, src, max_files_per_trigger=_two_batches(n_files))
    q = so.start_kpi_query(lines, d.ip_rule_lines(spark, sf), f"{root}/kpi", f"{root}/ckpt",
                           trigger="availableNow")
    q.awaitTermination()
    return _money(so.read_kpis(spark, f"{root}/kpi"))


def q_order_kpi_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The stream is stopped after a part of the lines and started again on the same
    checkpoint for the rest: nothing is lost or counted twice."""
    root = scratch_path(spark, "order-restart")
    for _, src in _landings(spark, sf, F.col("l_orderkey") % 2, 2):
        q = so.start_kpi_query(stream_folders(spark, src), d.ip_rule_lines(spark, sf),
                               f"{root}/kpi", f"{root}/ckpt", trigger="availableNow")
        q.awaitTermination()
    return _money(so.read_kpis(spark, f"{root}/kpi"))


def q_order_kpi_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Running KPIs kept as deltas of changed keys, one batch per landing group, merged into
    a base every third batch."""
    root = scratch_path(spark, "kpi-delta")
    store = KpiDeltas(spark, f"{root}/kpi", merge_every=3)
    rules = d.ip_rule_lines(spark, sf)
    for _, src in _landings(spark, sf, _landing_group(), d.LANDING_GROUPS + 1):
        start_kpi_delta_query(stream_folders(spark, src), rules, store, f"{root}/ckpt",
                              trigger="availableNow").awaitTermination()
    return _money(store.read().select("metric", "key", "value"))


def _archive(spark: SparkSession, sf: str) -> str:
    root = scratch_path(spark, "order-archive")
    src, n_files = _order_source_dir(spark, sf)
    lines = stream_text_dir(spark, src, max_files_per_trigger=_two_batches(n_files))
    q = so.start_archive_query(lines, f"{root}/data", f"{root}/ckpt", trigger="availableNow")
    q.awaitTermination()
    return f"{root}/data"


def q_order_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Archived orders (hour partition values are wall-clock, so not returned)."""
    return so.read_archive(spark, _archive(spark, sf)).select(*ord_ops.ORDER_COLUMNS)


def _landing_group() -> Column:
    """The micro-batch of an order line, see ``derived.LANDING_GROUPS``."""
    k = F.col("l_orderkey")
    return F.when(k % d.ORDER_SPOIL_DROP_FIELD == 0, d.LANDING_GROUPS).otherwise(k % d.LANDING_GROUPS)


def _landings(spark: SparkSession, sf: str, groups: Column, n: int) -> Iterator[tuple[int, str]]:
    """Write the order lines once, dealt to ``n`` folders, and move these one by one into
    the stream's input folder; yields each group that has lines and that folder."""
    root = scratch_path(spark, "landing")
    lines = d.order_lines(spark, sf, "l_orderkey").select("value", groups.cast("int").alias("g"))
    lines.write.partitionBy("g").text(f"{root}/staged")
    for g in range(n):
        if move_path(spark, f"{root}/staged/g={g}", f"{root}/src/g={g}"):
            yield g, f"{root}/src"


def _rolled(spark: SparkSession, sf: str, **options) -> RolledArchive:
    """A rolled archive of all groups, one batch each, with an injected clock."""
    root = scratch_path(spark, "rolled")
    now = {"t": float(d.ROLL_START)}
    archive = RolledArchive(spark, f"{root}/archive", clock=lambda: now["t"], **options)
    for g, src in _landings(spark, sf, _landing_group(), d.LANDING_GROUPS + 1):
        now["t"] = float(d.ROLL_START + g * d.ROLL_STEP)
        start_rolled_query(stream_folders(spark, src), archive, f"{root}/ckpt",
                           trigger="availableNow").awaitTermination()
    now["t"] = float(d.ROLL_START + (d.LANDING_GROUPS + 1) * d.ROLL_STEP)
    archive.close_open()
    return archive


def q_order_archive_rolled(spark: SparkSession, sf: str) -> DataFrame:
    """All archived orders with their hour, and for the part that holds them its files and
    the seconds (of the injected clock) when it was opened and closed."""
    archive = _rolled(spark, sf, roll_bytes=d.ROLL_BYTES, roll_seconds=d.ROLL_SECONDS)
    parts = archive.parts().select(F.col("bucket").alias("dt_hour"), "part", "files",
                                   F.col("opened").cast("bigint").alias("opened"),
                                   F.col("closed").cast("bigint").alias("closed"))
    return archive.read().join(parts, ["dt_hour", "part"]).drop("part")


def q_order_archive_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest of an archive with one file per batch, also for the batch whose rows
    were all rejected; ``stored`` are the rows that the files named in it hold."""
    archive = _rolled(spark, sf, roll_bytes=0)
    held = archive.read().groupBy("part").agg(F.count("*").alias("stored"))
    return archive.batches().select("batch", F.size("files").cast("bigint").alias("files"), "rows",
                                    F.col("published")[0]["part"].alias("part")).join(
        held, "part", "left").select("batch", "files", "rows", F.coalesce("stored", F.lit(0)).alias(
            "stored"))


def q_order_compact_late(spark: SparkSession, sf: str) -> DataFrame:
    """The archive is compacted, with its inputs deleted, after each of two loads: rows
    that arrive late, in hours that are compacted already, are merged in."""
    root = scratch_path(spark, "compact-late")
    half = F.pmod(F.col("l_orderkey"), F.lit(2))
    for _, src in _landings(spark, sf, half, 2):
        so.start_archive_query(stream_folders(spark, src), f"{root}/data", f"{root}/ckpt",
                               trigger="availableNow").awaitTermination()
        cmp.compact_all(spark, f"{root}/data", f"{root}/compacted", delete_inputs=True)
    return so.read_archive(spark, f"{root}/data").select(*ord_ops.ORDER_COLUMNS)


def q_order_compact(spark: SparkSession, sf: str) -> DataFrame:
    archive = _archive(spark, sf)
    out = archive.rsplit("/", 1)[0] + "/compacted"
    cmp.compact_all(spark, archive, out)
    return cmp.read_compacted(spark, out).select(*ord_ops.ORDER_COLUMNS)


# --- app statistics, partitions ----------------------------------------------------------

def q_appstats_etl(spark: SparkSession, sf: str) -> DataFrame:
    return clean_appstats(d.appstat_lines(spark, sf))


def q_appstats_etl_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Same validation with a real calendar check on the timestamp (month 13 fails)."""
    return clean_appstats(d.appstat_lines(spark, sf), "strict")


def _through_text(spark: SparkSession, lines: DataFrame, purpose: str, **options) -> DataFrame:
    path = f"{scratch_path(spark, purpose)}/lines"
    write_text(lines, path)
    return read_lines(spark, path, **options)


def q_usage_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """The usage log read from text files."""
    return use.clean_usage(_through_text(spark, d.usage_lines(spark, sf), "usage-text"))


def q_tag_library_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """The tag library read from text files: the last line by file position wins."""
    lines = d.tag_lines(spark, sf)
    lines = lines.repartitionByRange("line_no").sortWithinPartitions("line_no")
    return tag_library(_through_text(spark, lines, "tag-text", with_order=True), "line_order")


def q_ip_province_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and IP rules read from text files."""
    return jobs.orders_with_province(
        _through_text(spark, d.order_lines(spark, sf), "order-text"),
        _through_text(spark, d.ip_rule_lines(spark, sf), "rule-text"))


def q_appstats_text(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics lines from text, cleaned, written as text and read back."""
    clean = clean_appstats(_through_text(spark, d.appstat_lines(spark, sf), "stat-text"))
    return _through_text(spark, clean, "stat-clean")


def q_event_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hour buckets of the archive, in both layouts and a zone, at given times."""
    e = d.table(spark, sf, "events")
    now = F.col("ts").cast("timestamp")
    return e.select("event_id", *so.hour_columns("Asia/Shanghai", now=now),
                    *so.hour_columns("Asia/Shanghai", "hourly", now=now))


def q_partition_placement(spark: SparkSession, sf: str) -> DataFrame:
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placement(partition_by_user(jobs.usage_sums(d.usage_lines(spark, sf)), n))


def q_partition_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and users of the usage sums in each partition, dealt by the MD5 of the user."""
    sums = jobs.usage_sums(d.usage_lines(spark, sf))
    return partition_report(partition_by_user_md5(sums, d.REPORT_PARTITIONS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "usage_clean": q_usage_clean,
    "usage_clean_lenient": q_usage_clean_lenient,
    "usage_by_user_app": q_usage_by_user_app,
    "distinct_users": q_distinct_users,
    "record_counts": q_record_counts,
    "tag_library": q_tag_library,
    "usage_tag_join": q_usage_tag_join,
    "profile_build": q_profile_build,
    "profile_build_lenient": q_profile_build_lenient,
    "profile_merge": q_profile_merge,
    "profile_merge_sorted": q_profile_merge_sorted,
    "tagged_union": q_tagged_union,
    "tagged_union_files": q_tagged_union_files,
    "update_sequence": q_update_sequence,
    "merged_sorted": q_merged_sorted,
    "profile_text": q_profile_text,
    "order_etl": q_order_etl,
    "order_etl_lenient": q_order_etl_lenient,
    "ip_province": q_ip_province,
    "order_total": q_order_total,
    "order_by_province": q_order_by_province,
    "order_by_category": q_order_by_category,
    "order_kpi": q_order_kpi,
    "order_kpi_stream": q_order_kpi_stream,
    "order_archive": q_order_archive,
    "order_compact": q_order_compact,
    "appstats_etl": q_appstats_etl,
    "appstats_etl_strict": q_appstats_etl_strict,
    "partition_report": q_partition_report,
    "partition_placement": q_partition_placement,
    "order_kpi_restart": q_order_kpi_restart,
    "usage_from_text": q_usage_from_text,
    "tag_library_from_text": q_tag_library_from_text,
    "ip_province_from_text": q_ip_province_from_text,
    "appstats_text": q_appstats_text,
    "event_hours": q_event_hours,
    "order_archive_rolled": q_order_archive_rolled,
    "order_compact_late": q_order_compact_late,
    "order_archive_batches": q_order_archive_batches,
    "order_kpi_delta": q_order_kpi_delta,
    "profile_two_days": q_profile_two_days,
    "merged_ranked": q_merged_ranked,
    "usage_tag_join_salted": q_usage_tag_join_salted,
    "ip_province_sweep": q_ip_province_sweep,
}

