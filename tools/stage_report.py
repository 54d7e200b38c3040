"""Per-stage task counts and durations from a Spark event log directory.

    python tools/stage_report.py <eventlog dir or file>

Reads plain or zstd-compressed rolling event logs (``spark.eventLog.dir``).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            data = zstandard.ZstdDecompressor().stream_reader(f).read()
        yield from io.StringIO(data.decode("utf-8"))
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def stages(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) \
        if os.path.isdir(path) else [path]
    out = {}
    for fn in files:
        for line in _lines(fn):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"],
                                       si["Completion Time"] - si["Submission Time"])
    return out


if __name__ == "__main__":
    for sid, (name, n, ms) in sorted(stages(sys.argv[1]).items()):
        print(f"{sid:4d} {n:5d} tasks {ms:7d} ms  {name}")
