"""Line-oriented inputs: text files, text directories as streams, Kafka topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], *, with_order: bool = False,
               source: str | None = None, rebalance: bool = False) -> DataFrame:
    """``spark.read.text`` over one or more paths -> ``DF[value]``.

    ``with_order`` adds ``line_order``, a sortable struct that follows file order
    (file path, split start, position inside the split), for "last line wins"
    inputs. ``source`` adds a literal ``source`` column (the origin tag that the
    reference derived from the input path).

    ``rebalance`` spreads the lines over AQE-sized partitions (Spark's
    ``REBALANCE`` hint: one round-robin shuffle). Use it when the input is not
    splittable, e.g. a few large gzip files, so one file holding a third of the
    lines does not leave the CPU-bound parsing to one task. Splittable text is
    already spread by the scan, so it is off by default.
    """
    if isinstance(paths, str):
        paths = [paths]
    df = spark.read.text(list(paths))
    if with_order:
        df = df.withColumn("line_order", F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos")))
    if source is not None:
        df = df.withColumn("source", F.lit(source))
    if rebalance:
        df = df.hint("rebalance")
    return df


def read_tagged_paths(spark: SparkSession, paths: Sequence[str], marker: str,
                      if_marked: str, otherwise: str) -> DataFrame:
    """One read over several inputs; the origin comes from the file path.

    ``source = if_marked`` when the path contains ``marker``. Two separate reads
    with a literal source are usually clearer; this keeps the single-read form.
    """
    df = spark.read.text(list(paths))
    return df.withColumn("source", F.when(F.col("_metadata.file_path").contains(marker),
                                          F.lit(if_marked)).otherwise(F.lit(otherwise)))


def stream_text_dir(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                    ) -> DataFrame:
    """A directory of text files as a stream of ``value`` lines."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_folders(spark: SparkSession, path: str) -> DataFrame:
    """The text files of all folders below ``path`` as a stream of ``value`` lines."""
    return spark.readStream.format("text").option("recursiveFileLookup", "true").load(path)


def stream_kafka(spark: SparkSession, brokers: str, topics: str, *,
                 starting_offsets: str = "earliest", group_id: str | None = None,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None,
                 fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka topics (comma-separated list) as a stream of ``value`` strings.

    Needs the spark-sql-kafka package on the cluster's classpath. Offsets are
    tracked by the query checkpoint, so no consumer commit is needed.
    ``min_partitions`` lets Spark split a large topic partition over several
    tasks, so one partition holding a third of the orders is not one task;
    ``max_offsets_per_trigger`` bounds a batch after downtime. By default the
    query fails when offsets it has not read were deleted by retention, rather
    than silently leaving those orders out of the totals.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topics)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    try:
        df = r.load()
    except Exception as e:  # the connector is a separate package
        if "kafka" in str(e).lower() and ("find" in str(e).lower() or "not" in str(e).lower()):
            raise RuntimeError(
                "Kafka source unavailable: add org.apache.spark:spark-sql-kafka-0-10_2.13 "
                "(same version as Spark) to spark.jars.packages") from e
        raise
    return df.select(F.col("value").cast("string").alias("value"))
