"""Command-line jobs (``spark-submit tessera/cli.py <job> ...`` or ``python -m tessera.cli``).

Jobs
----
profile-update   fold a day's usage logs into the profile snapshot (version n -> n+1)
profiles         profiles from logs alone (prior start), written as Parquet or text
order-stream     order KPIs + hourly archive from Kafka (or a text directory)
order-kpis       the three order KPIs over order files (batch)
kpi-dump         print every KPI counter and value
appstats-etl     keep the valid app-statistics lines (text in, text out)
compact-hour     merge one archived hour into a few files

The session comes from spark-submit, with ``spark.checkpoint.dir`` set to a folder that
all executors share.
"""

from __future__ import annotations

import argparse
import datetime
import sys

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.appstats import clean_appstats
from tessera.plans import jobs
from tessera.plans.ledger import DayLedger
from tessera.plans.snapshot import SnapshotStore
from tessera.plans.textio import profile_to_text, write_text
from tessera.sources.text import read_lines, stream_kafka, stream_text_dir
from tessera.streaming import compact, orders


def _spark() -> SparkSession:
    return SparkSession.builder.appName("tessera").getOrCreate()


def cmd_profile_update(a) -> None:
    spark = _spark()
    store = SnapshotStore(spark, a.store, buckets=a.buckets, table_prefix=a.table_prefix)
    tags = read_lines(spark, a.tags, with_order=True)

    def fold(base: DataFrame, logs: list[str]) -> DataFrame:
        usage = read_lines(spark, logs, rebalance=a.rebalance_input)
        return jobs.profiles_with_store(base, usage, tags, a.policy, order_col="line_order")

    ledger = DayLedger(store, fold, placed=True)
    if a.init_from:
        ledger.seed(spark.read.parquet(a.init_from))
    if ledger.head() is None:
        raise SystemExit(f"no snapshot under {a.store}; seed one with --init-from")
    day = a.day or datetime.date.today().isoformat()
    v = ledger.rebuild(day, a.logs) if a.rebuild else ledger.apply(day, a.logs)
    print(f"{day} is in {store.path(v)}")


def cmd_profiles(a) -> None:
    spark = _spark()
    prof = jobs.profiles_from_logs(read_lines(spark, a.logs, rebalance=a.rebalance_input),
                                   read_lines(spark, a.tags, with_order=True), a.policy,
                                   order_col="line_order")
    if a.format == "text":
        write_text(profile_to_text(prof), a.out)
    else:
        prof.write.mode("overwrite").parquet(a.out)


def cmd_order_stream(a) -> None:
    spark = _spark()
    if a.brokers:
        src = stream_kafka(spark, a.brokers, a.topics, starting_offsets=a.starting_offsets,
                           group_id=a.group, max_offsets_per_trigger=a.max_offsets_per_trigger,
                           min_partitions=a.min_partitions)
    else:
        src = stream_text_dir(spark, a.input_dir)
    ckpt = a.checkpoint.rstrip("/")
    rules = read_lines(spark, a.rules)
    kq = orders.start_kpi_query(src, rules, a.kpi, f"{ckpt}/kpi", a.policy, a.trigger,
                                query_name="order_kpis")
    aq = orders.start_archive_query(src, a.archive, f"{ckpt}/archive", a.policy, a.zone,
                                    trigger=a.trigger, layout=a.layout,
                                    max_records_per_file=a.max_records_per_file)
    if a.trigger == "availableNow":
        for q in (kq, aq):          # each drains the input, then stops by itself
            q.awaitTermination()
        return
    try:
        spark.streams.awaitAnyTermination()   # runs until one fails or is stopped
    finally:
        for q in (kq, aq):
            q.stop()


def cmd_order_kpis(a) -> None:
    spark = _spark()
    kpis = jobs.batch_order_kpis(read_lines(spark, a.orders, rebalance=a.rebalance_input),
                                 read_lines(spark, a.rules), a.policy)
    kpis.write.mode("overwrite").parquet(a.out)


def cmd_kpi_dump(a) -> None:
    spark = _spark()
    for r in orders.read_kpis(spark, a.kpi).orderBy("metric", "key").toLocalIterator():
        print(f"{r.metric}\t{r.key}\t{r.value}")


def cmd_appstats_etl(a) -> None:
    spark = _spark()
    write_text(clean_appstats(read_lines(spark, a.input, rebalance=a.rebalance_input),
                              a.date_policy), a.out)


def cmd_compact_hour(a) -> None:
    spark = _spark()
    out = compact.compact_hour(spark, a.archive, a.out, a.year, a.month, a.day, a.hour,
                               rows_per_file=a.rows_per_file, delete_inputs=a.delete_inputs,
                               layout=a.layout)
    print(f"wrote {out}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("profile-update")
    s.add_argument("--rebalance-input", action="store_true",
                   help="spread non-splittable (e.g. gzip) input before parsing")
    s.add_argument("--logs", nargs="+", required=True)
    s.add_argument("--tags", nargs="+", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--day", help="label of the logs (default: today); a day that the store holds "
                                 "already is not applied again")
    s.add_argument("--rebuild", action="store_true",
                   help="replace a day's logs and apply the days after it again")
    s.add_argument("--init-from", help="Parquet profiles that become version 0 of an empty store")
    s.add_argument("--buckets", type=int, help="bucket the snapshots by mdn (needs --table-prefix)")
    s.add_argument("--table-prefix", help="catalog table name prefix of bucketed snapshots")
    s.add_argument("--policy", choices=("strict", "lenient"), default="strict")
    s.set_defaults(fn=cmd_profile_update)

    s = sub.add_parser("profiles")
    s.add_argument("--rebalance-input", action="store_true",
                   help="spread non-splittable (e.g. gzip) input before parsing")
    s.add_argument("--logs", nargs="+", required=True)
    s.add_argument("--tags", nargs="+", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--format", choices=("parquet", "text"), default="parquet")
    s.add_argument("--policy", choices=("strict", "lenient"), default="strict")
    s.set_defaults(fn=cmd_profiles)

    s = sub.add_parser("order-stream")
    s.add_argument("--brokers")
    s.add_argument("--topics", default="")
    s.add_argument("--group")
    s.add_argument("--starting-offsets", default="earliest")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--min-partitions", type=int, help="split large Kafka partitions over tasks")
    s.add_argument("--input-dir", help="text directory instead of Kafka")
    s.add_argument("--rules", nargs="+", required=True)
    s.add_argument("--kpi", required=True)
    s.add_argument("--archive", required=True)
    s.add_argument("--checkpoint", required=True,
                   help="folder of this stream's progress; keep it with --kpi and --archive")
    s.add_argument("--trigger", default=orders.BATCH_INTERVAL)
    s.add_argument("--zone", default="Asia/Shanghai")
    s.add_argument("--layout", choices=("ymdh", "hourly"), default="ymdh")
    s.add_argument("--max-records-per-file", type=int)
    s.add_argument("--policy", choices=("strict", "lenient"), default="strict")
    s.set_defaults(fn=cmd_order_stream)

    s = sub.add_parser("order-kpis")
    s.add_argument("--rebalance-input", action="store_true",
                   help="spread non-splittable (e.g. gzip) input before parsing")
    s.add_argument("--orders", nargs="+", required=True)
    s.add_argument("--rules", nargs="+", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--policy", choices=("strict", "lenient"), default="strict")
    s.set_defaults(fn=cmd_order_kpis)

    s = sub.add_parser("kpi-dump")
    s.add_argument("--kpi", required=True)
    s.set_defaults(fn=cmd_kpi_dump)

    s = sub.add_parser("appstats-etl")
    s.add_argument("--rebalance-input", action="store_true",
                   help="spread non-splittable (e.g. gzip) input before parsing")
    s.add_argument("--input", nargs="+", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--date-policy", choices=("lenient", "strict"), default="lenient")
    s.set_defaults(fn=cmd_appstats_etl)

    s = sub.add_parser("compact-hour")
    s.add_argument("--archive", required=True)
    s.add_argument("--out", required=True)
    for f in ("year", "month", "day", "hour"):
        s.add_argument(f"--{f}", required=True)
    s.add_argument("--rows-per-file", type=int, default=compact.DEFAULT_ROWS_PER_FILE)
    s.add_argument("--delete-inputs", action="store_true")
    s.add_argument("--layout", choices=("ymdh", "hourly"), default="ymdh")
    s.set_defaults(fn=cmd_compact_hour)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main(sys.argv[1:])
