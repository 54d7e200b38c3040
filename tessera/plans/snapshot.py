"""Versioned Parquet snapshots of the profile table (the upsert target).

Version ``n+1`` is always written next to version ``n`` and never over the path
being read, so a failed or repeated day leaves the previous snapshot intact and
re-running a day from the same base version rewrites the same result
(idempotent). Readers pick the highest version that has a ``_SUCCESS`` marker.

With ``buckets`` and ``table_prefix`` every version is also registered in the
session catalog as a table bucketed (and sorted) by the key, and a
``_BUCKETS-<key>-<n>`` marker is written next to the data (a leading ``_``
without ``=`` keeps it hidden from Parquet readers). The next day's merge reads
the bucketed table and its join on the key needs no exchange on the snapshot
side: only the day's usage is shuffled. A new application whose catalog does
not know the table (no persistent metastore) re-registers it from the marker;
a version without the marker is read as plain Parquet (same rows, one more
shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.commitlog import CommitLog

_PREFIX = "version="
LEDGER = "_ledger"               # commit records of the versions, see ``plans.ledger``


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, key: str = "mdn",
                 buckets: int | None = None, table_prefix: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self.buckets = buckets if table_prefix else None
        self.table_prefix = table_prefix

    def path(self, version: int) -> str:
        return f"{self.root}/{_PREFIX}{version:08d}"

    def table(self, version: int) -> str | None:
        return f"{self.table_prefix}_v{version:08d}" if self.buckets else None

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.root)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions (directories holding ``_SUCCESS``), ascending."""
        p, fs = self._fs()
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(_PREFIX):
                if fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                        st.getPath(), "_SUCCESS")):
                    out.append(int(name[len(_PREFIX):]))
        return sorted(out)

    def latest(self) -> int | None:
        """The latest version: that of the ledger if there is one, whatever data stands
        beside it without a record."""
        published = CommitLog(self.spark, f"{self.root}/{LEDGER}").latest()
        if published is not None:
            return published
        v = self.versions()
        return v[-1] if v else None

    # --- marks: empty files whose name is the message ----------------------------

    def _marks(self, folder: str, prefix: str) -> list[str]:
        _, fs = self._fs()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if not fs.exists(path):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(path)]
        return [n[len(prefix):] for n in names if n.startswith(prefix)]

    def _mark(self, folder: str, name: str) -> None:
        _, fs = self._fs()
        fs.create(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name), True).close()

    def day_of(self, version: int) -> str | None:
        """The day whose logs made a version, if it was recorded."""
        days = self._marks(self.path(version), "_DAY-")
        return days[0] if days else None

    def base_of_day(self, day: str) -> int | None:
        """The version that a day's logs are folded into: the latest, or the one
        before it when the latest is that day's own (a repeated run)."""
        latest = self.latest()
        return latest - 1 if latest and self.day_of(latest) == day else latest

    def claim(self, owner: str) -> None:
        """Make ``owner`` the only writer of this root; another one is refused."""
        owners = self._marks(self.root, "_OWNER-")
        if not owners and not self.versions():
            self._mark(self.root, f"_OWNER-{owner}")
        elif owners != [owner]:
            raise ValueError(f"{self.root} holds versions of another writer ({owners or 'unnamed'})")

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no committed snapshot under {self.root}")
        name = self.table(version)
        if name and (self.spark.catalog.tableExists(name) or self._register(version)):
            return self.spark.table(name)
        return self.spark.read.parquet(self.path(version))

    # --- bucket spec kept with the data ----------------------------------------

    def _marker_path(self, version: int):
        """``_BUCKETS-<key>-<n>``: the spec is the file name, so checking it is one
        ``exists`` call (files starting with ``_`` are invisible to Spark readers)."""
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path(self.path(version),
                                             f"_BUCKETS-{self.key}-{self.buckets}")

    def _write_marker(self, version: int) -> None:
        _, fs = self._fs()
        fs.create(self._marker_path(version), True).close()

    def _register(self, version: int) -> bool:
        """Re-register a bucketed version in this application's catalog from the
        marker written with it (metadata only), so a new application without a
        persistent metastore still reads it bucketed. Versions without a
        matching marker stay plain Parquet."""
        _, fs = self._fs()
        if not fs.exists(self._marker_path(version)):
            return False
        schema = self.spark.read.parquet(self.path(version)).schema   # from the footers
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table(version)} ({cols}) USING parquet "
            f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path(version)}'")
        return True

    def drop_versions_below(self, version: int) -> None:
        """Delete committed versions older than ``version`` (retention)."""
        jvm = self.spark.sparkContext._jvm
        _, fs = self._fs()
        for v in self.versions():
            if v < version:
                fs.delete(jvm.org.apache.hadoop.fs.Path(self.path(v)), True)

    def write(self, df: DataFrame, version: int, sort_key: str | None = "mdn",
              day: str | None = None, placed: bool = False) -> str:
        """Write ``df`` as ``version`` (overwrite: a retried day replaces its own
        output only) and record ``day``. Rows are sorted inside each file by the key,
        which keeps Parquet min/max statistics tight for point lookups by mdn. A
        bucketed store first deals the rows to one task per bucket, so it writes
        ``buckets`` files at most, unless they are already ``placed`` so (the merge's
        output, as long as the session shuffles into as many partitions)."""
        shuffled = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = placed and shuffled == self.buckets
        path = self._write(df, version, sort_key, placed)
        if day:
            self._mark(path, f"_DAY-{day}")
        return path

    def _write(self, df: DataFrame, version: int, sort_key: str | None, placed: bool) -> str:
        name = self.table(version)
        if name:
            if not placed:
                df = df.repartition(self.buckets, self.key)
            (df.write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key)
             .option("path", self.path(version)).saveAsTable(name))
            self._write_marker(version)
            return self.path(version)
        out = df.sortWithinPartitions(sort_key) if sort_key else df
        out.write.mode("overwrite").parquet(self.path(version))
        return self.path(version)
