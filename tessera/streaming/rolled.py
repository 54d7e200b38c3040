"""Order archive whose files are rolled by size and age across micro-batches.

Each hour bucket has at most one open part. A batch's rows are written to a pending folder
of their own and added to the open part of the batch's hour; the part is closed once it
holds ``roll_bytes`` or was opened ``roll_seconds`` ago, and its pending rows are then
rewritten as ``ceil(bytes / roll_bytes)`` files. With ``roll_bytes=0`` every batch is a part
of ``files_per_batch`` files, also when all of its rows were rejected.

What a batch has done stands in one commit record (``CommitLog``): the batch and its rows,
the ledger of open parts after it, and the parts it has closed with their files. So a batch
is there wholly or not at all, and the record is also the batch's manifest: a killed batch
leaves folders that no record names and that its replay overwrites; a replay of a recorded
batch does nothing. Pending folders are deleted after the record that closes their part;
should that fail, the next batch deletes them.

The clock gives the processing time in seconds and can be injected. The size of a row is
that of its values (``plans.broadcast.row_bytes``).
"""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.orders import ORDER_COLUMNS, parse_orders
from tessera.plans.broadcast import measured_write
from tessera.plans.commitlog import CommitLog, delete_paths, list_files
from tessera.streaming.orders import BATCH_INTERVAL, HOUR_BUCKET, ORDER_SCHEMA, _trigger

# --- fixed values -----------------------------------------------------------------
ROLL_BYTES = 400 * 1024 * 1024          # a part is closed at 400 MB
ROLL_SECONDS = 60 * 60                  # or 60 minutes after it was opened
ZONE = "Asia/Shanghai"
# -----------------------------------------------------------------------------------

PARTS = ("struct<seq: bigint, batch: bigint, time: double, rows: bigint, files: array<string>, "
         "published: array<struct<bucket: string, part: bigint, folder: string, "
         "files: array<string>, rows: bigint, bytes: bigint, opened: double, closed: double>>>")


class RolledArchive:
    """Writer and reader of one rolled archive; one writer (stream) at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: str = ORDER_SCHEMA, zone: str = ZONE,
                 roll_bytes: int = ROLL_BYTES, roll_seconds: float = ROLL_SECONDS,
                 files_per_batch: int = 1, clock: Callable[[], float] = time.time):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.zone = zone
        self.roll_bytes = roll_bytes
        self.roll_seconds = roll_seconds
        self.files_per_batch = files_per_batch
        self.clock = clock
        self.log = CommitLog(spark, f"{self.root}/_log")

    def bucket(self, now: float) -> str:
        return datetime.datetime.fromtimestamp(now, ZoneInfo(self.zone)).strftime("%Y-%m-%d-%H")

    # --- writing ---------------------------------------------------------------------

    def _state(self) -> dict:
        return self.log.last() or {"seq": -1, "batch": -1, "owner": None, "open": {}, "published": []}

    def _folder(self, bucket: str, part: int) -> str:
        return f"{self.root}/data/{HOUR_BUCKET}={bucket}/part={part}"

    def _closed(self, number: int, bucket: str, part: dict, now: float) -> dict:
        """Rewrite an open part's pending rows as the files of part ``number``."""
        folder = self._folder(bucket, number)
        files = max(1, -(-part["bytes"] // self.roll_bytes))
        self.spark.read.schema(self.schema).parquet(*part["pending"]).repartition(
            files).write.mode("overwrite").parquet(folder)
        return part | {"bucket": bucket, "part": number, "folder": folder, "closed": now,
                       "files": list_files(self.spark, folder)}

    def _write(self, df: DataFrame, folder: str) -> tuple[int, int]:
        """Rows and bytes of ``df``."""
        return measured_write(df, folder)

    def write_batch(self, batch: DataFrame, batch_id: int, owner: str | None = None) -> bool:
        """Add a batch; False if its record is there already (a replay)."""
        state = self._state()
        if state["owner"] not in (None, owner):
            raise ValueError(f"{self.root} holds batches of another stream ({state['owner']})")
        self._clean(state)
        if batch_id <= state["batch"]:
            return False
        now, seq = self.clock(), state["seq"] + 1
        bucket = self.bucket(now)
        record = {"seq": seq, "batch": batch_id, "owner": owner, "time": now, "published": [],
                  "open": dict(state["open"]), "files": []}
        # a record may close two parts of an hour: one for its age, then one for its size
        aged, full = 2 * seq, 2 * seq + 1
        if not self.roll_bytes:
            folder = self._folder(bucket, full)
            rows, size = self._write(batch.repartition(self.files_per_batch), folder)
            files = list_files(self.spark, folder)
            record["published"] = [{"bucket": bucket, "part": full, "folder": folder, "files": files,
                                    "rows": rows, "bytes": size, "opened": now, "closed": now,
                                    "pending": []}]
            return self.log.commit(seq, record | {"rows": rows, "files": files})
        for b, part in state["open"].items():
            if now - part["opened"] >= self.roll_seconds:
                record["published"].append(self._closed(aged, b, record["open"].pop(b), now))
        pending = f"{self.root}/pending/{seq:012d}"
        rows, size = self._write(batch, pending)
        if rows:
            part = record["open"].pop(bucket, {"opened": now, "rows": 0, "bytes": 0, "pending": []})
            part = {"opened": part["opened"], "rows": part["rows"] + rows,
                    "bytes": part["bytes"] + size, "pending": [*part["pending"], pending]}
            if part["bytes"] >= self.roll_bytes:
                record["published"].append(self._closed(full, bucket, part, now))
            else:
                record["open"][bucket] = part
        record |= {"rows": rows, "files": list_files(self.spark, pending) if rows else [],
                   "unused": [] if rows else [pending]}
        done = self.log.commit(seq, record)
        if done:
            self._clean(record)
        return done

    def close_open(self) -> int:
        """Close every open part, as at the end of a stream; returns how many."""
        state = self._state()
        if not state["open"]:
            return 0
        now, seq = self.clock(), state["seq"] + 1
        record = {**state, "seq": seq, "time": now, "rows": 0, "files": [], "unused": [],
                  "open": {}, "published": [
            self._closed(2 * seq, b, p, now) for b, p in sorted(state["open"].items())]}
        self.log.commit(seq, record)
        self._clean(record)
        return len(record["published"])

    def _clean(self, record: dict) -> None:
        delete_paths(self.spark, [*record.get("unused", []),
                                  *(p for x in record["published"] for p in x["pending"])])

    # --- reading ---------------------------------------------------------------------

    def batches(self) -> DataFrame:
        """``seq, batch, time, rows, files, published``: the manifest, one row per record."""
        return self.log.all().select(F.from_json("value", PARTS).alias("r")).select("r.*")

    def parts(self) -> DataFrame:
        """``bucket, part, files, rows, bytes, opened, closed`` of every closed part."""
        return self.batches().select(F.explode("published").alias("p")).select(
            "p.bucket", "p.part", F.size("p.files").cast("long").alias("files"), "p.rows", "p.bytes",
            "p.opened", "p.closed")

    def read(self, include_open: bool = False, bucket: str | None = None) -> DataFrame:
        """The rows of all closed parts, with ``dt_hour`` and ``part`` (of that hour); with
        ``include_open`` also those that wait in open parts (``part`` null)."""
        files = self.batches().select(F.explode("published").alias("p"))
        if bucket:
            files = files.where(F.col("p.bucket") == bucket)
        # the list of files is what a reader's file index holds on the driver anyway
        names = [r[0] for r in files.select(F.explode("p.files")).toLocalIterator()]
        schema = f"{self.schema}, {HOUR_BUCKET} string, part bigint"
        out = (self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*names)
               if names else self.spark.createDataFrame([], schema))
        if include_open:
            for b, p in self._state()["open"].items():
                if bucket in (None, b):
                    rows = self.spark.read.schema(self.schema).parquet(*p["pending"])
                    out = out.unionByName(rows.select("*", F.lit(b).alias(HOUR_BUCKET),
                                                      F.lit(None).cast("bigint").alias("part")))
        return out


def start_rolled_query(lines: DataFrame, archive: RolledArchive, checkpoint: str,
                       policy: str = "strict", trigger: str | None = BATCH_INTERVAL) -> StreamingQuery:
    """Archive the valid orders of a stream of lines."""
    def write(batch: DataFrame, batch_id: int) -> None:
        owner = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        archive.write_batch(batch, batch_id, owner)

    orders = parse_orders(lines, policy).select(*ORDER_COLUMNS)
    return _trigger(orders.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint),
                    trigger).start()
