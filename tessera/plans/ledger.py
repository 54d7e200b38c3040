"""Ledger of the days whose logs a profile store holds.

Every version of the store is published by one commit record that names its base, its day,
the day's input files, and all days so far with the versions and inputs they went into. Data
is written before its record, so a crash in between leaves a folder that no reader opens and
that the next run overwrites. A day that is in the ledger is not folded in again, whichever
day it is; ``rebuild`` replaces a day's logs and folds the days after it in again from the
inputs that the ledger names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tessera.plans.commitlog import CommitLog
from tessera.plans.snapshot import LEDGER, SnapshotStore


class DayLedger:
    """``fold(base, inputs)`` gives the profiles after a day whose logs are ``inputs``."""

    def __init__(self, store: SnapshotStore, fold: Callable[[DataFrame, list[str]], DataFrame],
                 placed: bool = False):
        self.store = store
        self.fold = fold
        self.placed = placed           # the fold's output is dealt to the store's buckets
        self.log = CommitLog(store.spark, f"{store.root}/{LEDGER}")

    def head(self) -> dict | None:
        """The latest record. A store from before the ledger starts with its latest version."""
        record = self.log.last()
        latest = self.store.latest() if record is None else None
        if latest is None:
            return record
        day = self.store.day_of(latest)
        days = {day: {"version": latest, "base": latest - 1, "inputs": None}} if day else {}
        return {"version": latest, "base": None, "day": day, "inputs": None, "days": days}

    def seed(self, profiles: DataFrame) -> int:
        """Version 0, of no day; a store that has a version keeps it."""
        head = self.head()
        if head is not None:
            return head["version"]
        self.store.write(profiles, 0)
        self._commit({"version": 0, "base": None, "day": None, "inputs": [], "days": {}})
        return 0

    def read(self) -> DataFrame:
        return self.store.read(self._head()["version"])

    def apply(self, day: str, inputs: list[str]) -> int:
        """Fold a day's logs into the latest version; returns the version that holds them.

        A day that is in the ledger with the same inputs is left as it is, and refused with
        other inputs (see ``rebuild``)."""
        head = self._head()
        known = head["days"].get(day)
        if known:
            if known["inputs"] not in (None, sorted(inputs)):
                raise ValueError(f"{day} was applied with other inputs: {known['inputs']}")
            return known["version"]
        return self._chain(head, head["version"], [(day, sorted(inputs))])

    def rebuild(self, day: str, inputs: list[str]) -> int:
        """Replace a day's logs: the day, and all days after it, are folded again from the
        version before it. All of it is published by one record at the end."""
        head = self._head()
        if day not in head["days"]:
            raise ValueError(f"{day} was never applied")
        known = head["days"][day]
        later = sorted((d for d, x in head["days"].items() if x["version"] > known["version"]),
                       key=lambda d: head["days"][d]["version"])
        lost = [d for d in later if head["days"][d]["inputs"] is None]
        if lost:
            raise ValueError(f"the ledger does not know the inputs of {', '.join(lost)}")
        return self._chain(head, known["base"], [(day, sorted(inputs)), *(
            (d, head["days"][d]["inputs"]) for d in later)])

    def days(self) -> DataFrame:
        """``day, version, base, inputs``, from the latest record (a row per day)."""
        rows = [(d, x["version"], x["base"], x["inputs"]) for d, x in self._head()["days"].items()]
        return self.store.spark.createDataFrame(
            rows, "day string, version bigint, base bigint, inputs array<string>")

    def _head(self) -> dict:
        head = self.head()
        if head is None:
            raise FileNotFoundError(f"no committed snapshot under {self.store.root}; seed it first")
        return head

    def _chain(self, head: dict, base: int, steps: list[tuple[str, list[str]]]) -> int:
        days, version = dict(head["days"]), head["version"]
        for day, inputs in steps:
            version += 1
            self.store.write(self.fold(self.store.read(base), inputs), version, placed=self.placed)
            days[day] = {"version": version, "base": base, "inputs": inputs}
            base = version
        day, inputs = steps[-1]
        self._commit({"version": version, "base": days[day]["base"], "day": day, "inputs": inputs,
                      "days": days})
        return version

    def _commit(self, record: dict) -> None:
        if not self.log.commit(record["version"], record):
            raise RuntimeError(f"another run has published version {record['version']}")
