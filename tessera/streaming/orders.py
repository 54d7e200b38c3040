"""Order stream: running KPIs (total / province / category) and an hourly archive.

Both are Structured Streaming queries over the same line source (Kafka on a
cluster, a text directory in tests):

* KPIs: parse -> stream-static broadcast range join (IP -> province) -> one
  ``groupBy(metric, key).sum`` whose running totals live in the state store.
  The counter set is small and bounded (one row per province and per category,
  plus the total), so the query runs in complete mode: every batch hands
  ``foreachBatch`` the whole counter table, written once as version
  ``batch_id``. The values are *assigned*, never incremented: a replayed batch
  rebuilds the same version, so a restart neither loses nor double-counts, and
  readers open only the latest committed version.
* Archive: cleaned orders written by the exactly-once file sink, partitioned by
  the processing-time hour (``current_timestamp`` is fixed per micro-batch and
  recorded in the offset log, so a replay lands in the same hour).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.ipgeo import attach_province, parse_ip_rules, prepare_rules
from tessera.operators.orders import ORDER_COLUMNS, order_kpis, parse_orders
from tessera.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from tessera.plans.snapshot import SnapshotStore
from tessera.streaming import manifest

# --- fixed values -----------------------------------------------------------------
BATCH_INTERVAL = "20 seconds"           # micro-batch interval of the order job
HOUR_PARTITIONS = ("year", "month", "day", "hour")   # layout "ymdh": yyyy / MM / dd / HH
HOUR_BUCKET = "dt_hour"                              # layout "hourly": yyyy-MM-dd-HH
HOUR_BUCKET_FORMAT = "yyyy-MM-dd-HH"
# -----------------------------------------------------------------------------------


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def kpi_stream(lines: DataFrame, rule_lines: DataFrame, policy: str = "strict",
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Streaming ``(metric, key, value)`` running totals (needs update mode)."""
    prepared = prepare_rules(parse_ip_rules(rule_lines), max_broadcast_rows)
    enriched = attach_province(parse_orders(lines, policy), None, prepared=prepared)
    return order_kpis(enriched)


def _kpi_writer(kpi_root: str, retain: int):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        store = SnapshotStore(batch.sparkSession, kpi_root)
        # batch ids only mean something within one query: a new checkpoint on an old
        # root would start again at 0 below the versions already there
        store.claim(batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
        # repartition (not coalesce) keeps the stateful stage parallel upstream
        store.write(batch.select("metric", "key", "value").repartition(1), batch_id,
                    sort_key=None)
        if retain:
            store.drop_versions_below(batch_id - retain + 1)
    return write_batch


def start_kpi_query(lines: DataFrame, rule_lines: DataFrame, kpi_root: str, checkpoint: str,
                    policy: str = "strict", trigger: str | None = BATCH_INTERVAL,
                    query_name: str | None = None, retain_versions: int = 0) -> StreamingQuery:
    """Start the KPI query. Every batch's counter table is kept; ``retain_versions``
    keeps that many of the latest only. A root that another query (another
    checkpoint) has written is refused."""
    w = (kpi_stream(lines, rule_lines, policy).writeStream.outputMode("complete")
         .foreachBatch(_kpi_writer(kpi_root, retain_versions))
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def read_kpis(spark: SparkSession, kpi_root: str) -> DataFrame:
    """Every counter with its current value (the latest committed version)."""
    return SnapshotStore(spark, kpi_root).read().select("metric", "key", "value")


def hour_columns(zone: str = "UTC", layout: str = "ymdh", now: Column | None = None) -> list:
    """Bucket columns of ``now`` (a timestamp; the processing time, constant per
    micro-batch, unless given) in ``zone``: zero-padded ``year, month, day, hour`` (layout ``ymdh``) or one
    ``dt_hour = yyyy-MM-dd-HH`` column (layout ``hourly``)."""
    local = F.convert_timezone(None, F.lit(zone), 
                               (F.current_timestamp() if now is None else now).cast("timestamp_ntz"))
    if layout == "hourly":
        return [F.date_format(local, HOUR_BUCKET_FORMAT).alias(HOUR_BUCKET)]
    if layout != "ymdh":
        raise ValueError("layout must be 'ymdh' or 'hourly'")
    return [F.date_format(local, fmt).alias(name)
            for name, fmt in zip(HOUR_PARTITIONS, ("yyyy", "MM", "dd", "HH"))]


def partition_names(layout: str = "ymdh") -> tuple[str, ...]:
    return HOUR_PARTITIONS if layout == "ymdh" else (HOUR_BUCKET,)


def archive_stream(lines: DataFrame, policy: str = "strict", zone: str = "UTC",
                   layout: str = "ymdh") -> DataFrame:
    return parse_orders(lines, policy).select(*ORDER_COLUMNS, *hour_columns(zone, layout))


def start_archive_query(lines: DataFrame, archive_root: str, checkpoint: str,
                        policy: str = "strict", zone: str = "UTC", fmt: str = "parquet",
                        trigger: str | None = BATCH_INTERVAL,
                        max_records_per_file: int | None = None, layout: str = "ymdh",
                        files_per_batch: int | None = None) -> StreamingQuery:
    """File sink, one directory per processing hour. ``max_records_per_file``
    bounds file size (the rolling size limit); small files of an hour are merged
    later by ``compact_hour``. By default parallelism is left to the source
    partitions, so a large batch is still written in parallel;
    ``files_per_batch=1`` reproduces "one file per batch" (a ``coalesce`` on the
    stream, narrow, applied per micro-batch) for small streams. The sink's commit
    log lists every file, so readers see all that was ever archived."""
    df = archive_stream(lines, policy, zone, layout)
    if files_per_batch:
        df = df.coalesce(files_per_batch)
    w = (df.writeStream.format(fmt).outputMode("append")
         .partitionBy(*partition_names(layout)).option("checkpointLocation", checkpoint)
         .option("path", archive_root))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    return _trigger(w, trigger).start()


ORDER_SCHEMA = ("user string, ip bigint, category string, item string, price double, "
                "amount float, total double")


def archive_schema(layout: str = "ymdh") -> str:
    return ORDER_SCHEMA + "".join(f", {c} string" for c in partition_names(layout))


def read_sink(spark: SparkSession, archive_root: str, layout: str = "ymdh") -> DataFrame:
    """Everything the archive stream has ever committed, through the sink's commit log,
    with string partition values (``month=03`` stays ``"03"``)."""
    return spark.read.schema(archive_schema(layout)).parquet(archive_root)


def sink_files(sink: DataFrame) -> list[str]:
    """The committed files of ``read_sink`` as the file system names them."""
    return [unquote(f) for f in sink.inputFiles()]


def read_archive(spark: SparkSession, archive_root: str, layout: str = "ymdh") -> DataFrame:
    """The archive's rows, each once: files that the sink has committed, and for compacted
    hours the compacted files in place of those they replace."""
    sink = read_sink(spark, archive_root, layout)
    if not manifest.has_manifest(spark, archive_root):
        return sink
    records = manifest.latest_records(spark, archive_root)
    # lists of files, as a reader's file index holds them on the driver
    replaced = {r[0] for r in records.select(F.explode("replaced")).toLocalIterator()}
    outputs = [r[0] for r in records.select(F.explode("outputs")).toLocalIterator()]
    live = [f for f in sink_files(sink) if f not in replaced]
    out = (spark.read.schema(sink.schema).option("basePath", archive_root).parquet(*live) if live
           else spark.createDataFrame([], sink.schema))
    if outputs:
        out = out.unionByName(read_compacted_files(spark, outputs, layout))
    return out


def read_compacted_files(spark: SparkSession, files: list[str], layout: str = "ymdh") -> DataFrame:
    """Compacted files ``.../yyyy/MM/dd/HH/<file>`` with their hour columns."""
    at = F.split(F.col("_metadata.file_path"), "/")
    parts = [F.element_at(at, i) for i in (-5, -4, -3, -2)]
    hour = ([F.concat_ws("-", *parts).alias(HOUR_BUCKET)] if layout == "hourly"
            else [p.alias(n) for p, n in zip(parts, HOUR_PARTITIONS)])
    return spark.read.schema(ORDER_SCHEMA).parquet(*files).select("*", *hour)
