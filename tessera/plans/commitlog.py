"""Numbered commit records: what they name is there, all else is not.

A record is one small JSON file. It is written beside its place and moved there in one
step that fails if the place is taken, so a record exists wholly or not at all and a
number is given out once. Data is written first, in folders that nothing names yet; the
record that names them makes them visible. A writer that dies in between leaves folders
that no reader opens.

Records stand in folders of 1000, so finding the latest lists two short folders however
many there are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

PER_FOLDER = 1000


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def folder(self, number: int) -> str:
        return f"{self.root}/{number // PER_FOLDER:09d}"

    def path(self, number: int) -> str:
        return f"{self.folder(number)}/{number:012d}.json"

    def _numbers(self, folder: str, suffix: str = "") -> list[int]:
        fs, path = self._fs(), self._path(folder)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:len(n) - len(suffix)]) for n in names
                      if n.endswith(suffix) and n[:len(n) - len(suffix)].isdigit())

    def latest(self) -> int | None:
        """The highest record number."""
        for folder in reversed(self._numbers(self.root)):
            numbers = self._numbers(self.folder(folder * PER_FOLDER), ".json")
            if numbers:
                return numbers[-1]
        return None

    def has(self, number: int) -> bool:
        return self._fs().exists(self._path(self.path(number)))

    def read(self, number: int) -> dict:
        stream = self._fs().open(self._path(self.path(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def last(self) -> dict | None:
        """The latest record."""
        number = self.latest()
        return None if number is None else self.read(number)

    def commit(self, number: int, record: dict) -> bool:
        """Publish ``record`` as ``number``; False, and no change, if there is one already."""
        jvm, fs = self._jvm, self._fs()
        if self.has(number):
            return False
        beside = self._path(f"{self.folder(number)}/.{number:012d}-{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, False)
        try:
            out.write(bytearray(json.dumps(record, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), self._conf)
        no_overwrite = self.spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(beside), fs.makeQualified(self._path(self.path(number))),
                           no_overwrite)
        except Exception as e:
            if "FileAlreadyExists" not in str(e) and "exists" not in str(e):
                raise
            fs.delete(beside, False)
            return False
        return True

    def all(self):
        """Every record as a DataFrame with the one column ``value`` (its JSON), for
        readers that need the whole history; read by tasks, not by the driver."""
        return self.spark.read.option("wholetext", "true").option(
            "recursiveFileLookup", "true").option("pathGlobFilter", "[0-9]*.json").text(self.root)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders that a committed record has replaced; missing ones are fine."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder to a free place; False if there is nothing to move."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = dst.getFileSystem(conf)
    if not fs.exists(src):
        return False
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")
    return True


def list_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """The data files directly in a folder, in order of name; none if it is not there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(p.toString() for p in found
                  if p.getName().endswith(suffix) and p.getName()[0] not in "_.")
