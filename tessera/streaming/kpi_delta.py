"""KPI counters as keyed deltas: a batch writes the keys that it has changed, nothing else.

The stream runs in update mode, so ``foreachBatch`` gets the new totals of the keys that the
batch touched. They are written as the batch's delta, at most a file for each state partition
that changed. A counter is the value of its latest delta (``max_by`` over the batch id); the
values are assigned, never added up, so a batch that is replayed rewrites the same numbers.
Every ``merge_every`` batches the deltas are merged into a base.

One commit record a batch (``CommitLog``, numbered by the batch id) names the base and the
deltas after it, so a reader opens the latest record and at most ``merge_every`` folders,
whatever the stream's age. Folders without a record are overwritten by the replay. Merged
folders are deleted after the record that replaces them, unless ``keep_merged``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.commitlog import CommitLog, delete_paths
from tessera.streaming.orders import BATCH_INTERVAL, _trigger, kpi_stream

MERGE_EVERY = 50
KPI_SCHEMA = "metric string, key string, value double, batch bigint"


class KpiDeltas:
    def __init__(self, spark: SparkSession, root: str, merge_every: int = MERGE_EVERY,
                 keep_merged: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.merge_every = merge_every
        self.keep_merged = keep_merged
        self.log = CommitLog(spark, f"{self.root}/_log")

    def write_batch(self, changed: DataFrame, batch_id: int, owner: str | None = None) -> bool:
        """Add the changed keys' totals; False if the batch is recorded already (a replay)."""
        last = self.log.last() or {"batch": -1, "owner": owner, "base": None, "deltas": [],
                                   "merged": []}
        if last["owner"] != owner:
            # batch ids only mean something within one query
            raise ValueError(f"{self.root} holds batches of another stream ({last['owner']})")
        self._clean(last)
        if batch_id <= last["batch"]:
            return False
        folder, seen = f"{self.root}/delta/{batch_id:012d}", Observation()
        (changed.select("metric", "key", "value", F.lit(batch_id).cast("bigint").alias("batch"))
         .observe(seen, F.count(F.lit(1)).alias("keys")).write.mode("overwrite").parquet(folder))
        keys = seen.get["keys"]
        record = {"batch": batch_id, "owner": owner, "keys": keys, "base": last["base"],
                  "deltas": [*last["deltas"], *([folder] if keys else [])], "merged": []}
        if len(record["deltas"]) >= self.merge_every:
            merged = [*record["deltas"], *([record["base"]] if record["base"] else [])]
            base = f"{self.root}/base/{batch_id:012d}"
            self._latest(merged).write.mode("overwrite").parquet(base)
            record |= {"base": base, "deltas": [], "merged": merged}
        done = self.log.commit(batch_id, record)
        if done:
            self._clean(record)
        return done

    def _clean(self, record: dict) -> None:
        if not self.keep_merged:
            delete_paths(self.spark, record["merged"])

    def _latest(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.schema(KPI_SCHEMA).parquet(*folders)
        return rows.groupBy("metric", "key").agg(
            F.max_by("value", "batch").alias("value"), F.max("batch").alias("batch"))

    def read(self) -> DataFrame:
        """``metric, key, value, batch``: every counter and the batch that last changed it."""
        last = self.log.last()
        folders = [] if last is None else [*([last["base"]] if last["base"] else []), *last["deltas"]]
        return self._latest(folders) if folders else self.spark.createDataFrame([], KPI_SCHEMA)

    def batches(self) -> DataFrame:
        """``batch, keys``: how many counters each batch changed."""
        return self.log.all().select(F.from_json(
            "value", "batch bigint, keys bigint").alias("r")).select("r.*")


def start_kpi_delta_query(lines: DataFrame, rule_lines: DataFrame, store: KpiDeltas, checkpoint: str,
                          policy: str = "strict",
                          trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Running KPIs of a stream of order lines, kept as deltas in ``store``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, batch_id,
                          batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))

    return _trigger(kpi_stream(lines, rule_lines, policy).writeStream.outputMode("update")
                    .foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()
