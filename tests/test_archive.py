"""Commit log, rolled archive, repeatable compaction: whole results, and crashes between
any two steps."""

import os

import pytest

from tessera.operators import orders as O
from tessera.plans import commitlog
from tessera.plans.commitlog import CommitLog
from tessera.session import local_path, scratch_path
from tessera.sources.text import stream_folders, stream_text_dir
from tessera.streaming import compact as C
from tessera.streaming import orders as S
from tessera.streaming.rolled import ROLL_BYTES, ROLL_SECONDS, RolledArchive, start_rolled_query
from tests.conftest import lines_df
from tests.test_orders import SAMPLE
from tests.test_streaming import write_lines

pytestmark = pytest.mark.usefixtures("few_partitions")

START = 1704039000.0                       # 2024-01-01 00:10 in Asia/Shanghai


class Killed(Exception):
    """Stands for the end of the process."""


def valid(spark, lines):
    return sorted(tuple(x) for x in O.parse_orders(lines_df(spark, lines)).collect())


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*O.ORDER_COLUMNS).collect())


# --- commit log -------------------------------------------------------------------------

def test_a_number_is_given_out_once(spark):
    log = CommitLog(spark, scratch_path(spark, "t-log"))
    assert log.latest() is None and log.last() is None
    assert log.commit(0, {"a": "é"}) and not log.commit(0, {"a": "other"})
    assert log.commit(2500, {"b": 1}) and log.latest() == 2500
    assert log.read(0) == {"a": "é"} and log.last() == {"b": 1}
    log.has = lambda number: False              # two writers that both saw a free place
    assert not log.commit(0, {"a": "third"}) and log.read(0) == {"a": "é"}
    assert sorted(r[0] for r in log.all().collect()) == ['{"a": "\\u00e9"}', '{"b": 1}']
    assert not [f for _, _, names in os.walk(local_path(log.root)) for f in names
                if f.endswith(".tmp")]


# --- rolled archive ---------------------------------------------------------------------

def orders_of(spark, n, mark):
    line = f"user{mark} 61.135.7.9 cat item 1.5 2"
    return O.parse_orders(lines_df(spark, [line] * n)).select(*O.ORDER_COLUMNS)


def archive_at(spark, now, **options):
    return RolledArchive(spark, scratch_path(spark, "t-rolled"), clock=lambda: now["t"], **options)


ROW = 28 + len("user0") + len("cat") + len("item")     # bytes of a row of orders_of


def test_parts_are_closed_by_size_and_by_age(spark):
    now = {"t": START}
    a = archive_at(spark, now, roll_bytes=10 * ROW, roll_seconds=3600)
    steps = [(0, 4), (60, 4), (120, 4),       # 12 rows: full, two files
             (180, 3), (3000, 25),            # 00:10 -> 01:00: another hour, full at once, 3 files
             (3780, 2),                       # 01:13: the part of 00:13 is an hour old
             (3790, 0), (3900, 1)]
    for i, (t, n) in enumerate(steps):
        now["t"] = START + t
        assert a.write_batch(orders_of(spark, n, i), i)
    parts = {(r.bucket, r.opened - START, r.closed - START): (r.files, r.rows, r.bytes)
             for r in a.parts().collect()}
    assert parts == {("2024-01-01-00", 0, 120): (2, 12, 12 * ROW),
                     ("2024-01-01-01", 3000, 3000): (3, 25, 25 * ROW),
                     ("2024-01-01-00", 180, 3780): (1, 3, 3 * ROW)}
    assert a.read().count() == 40 and a.read(include_open=True).count() == 43
    assert a.read(bucket="2024-01-01-00").count() == 15
    now["t"] = START + 4000
    assert a.close_open() == 1 and a.close_open() == 0
    assert a.read().count() == 43
    for r in a.batches().collect():                         # a file is there, and named once
        for p in r.published or []:
            assert len(p.files) == len(set(p.files)) and all(os.path.exists(local_path(f))
                                                             for f in p.files)
    assert not os.listdir(local_path(f"{a.root}/pending"))  # all consumed
    assert [r.rows for r in a.batches().orderBy("seq").collect()] == [4, 4, 4, 3, 25, 2, 0, 1, 0]


def test_an_hour_may_close_two_parts_in_one_batch(spark):
    now = {"t": START}
    a = archive_at(spark, now, roll_bytes=10 * ROW, roll_seconds=600)
    for t, n in ((0, 3), (700, 11)):
        now["t"] = START + t
        a.write_batch(orders_of(spark, n, 0), t)
    assert sorted((r.rows, r.files) for r in a.parts().collect()) == [(3, 1), (11, 2)]
    assert a.read().count() == 14


def test_replayed_batches_change_nothing(spark):
    now = {"t": START}
    a = archive_at(spark, now, roll_bytes=100 * ROW)
    assert a.write_batch(orders_of(spark, 5, 0), 0) and not a.write_batch(orders_of(spark, 5, 0), 0)
    assert a.write_batch(orders_of(spark, 2, 1), 1) and not a.write_batch(orders_of(spark, 2, 1), 1)
    assert a.read(include_open=True).count() == 7


@pytest.mark.parametrize("step", range(1, 6))
def test_a_killed_batch_leaves_no_half_part(spark, monkeypatch, step):
    """The process ends at the ``step``-th of: write of the aged part, of the batch, of the
    full part, the record, the clean-up. The batch is then replayed by a new process."""
    now = {"t": START}
    a = archive_at(spark, now, roll_bytes=10 * ROW, roll_seconds=600)
    a.write_batch(orders_of(spark, 4, 0), 0)
    now["t"] = START + 700
    seen = {"n": 0}

    def killing(real, after=False):
        def run(*args, **kw):
            seen["n"] += 1
            if seen["n"] == step and not after:
                raise Killed
            return real(*args, **kw)
        return run

    from tessera.streaming import rolled
    monkeypatch.setattr(rolled.RolledArchive, "_closed", killing(rolled.RolledArchive._closed))
    monkeypatch.setattr(rolled.RolledArchive, "_write", killing(rolled.RolledArchive._write))
    monkeypatch.setattr(CommitLog, "commit", killing(CommitLog.commit))
    real_clean, cleans = rolled.RolledArchive._clean, {"n": 0}

    def clean(self, record):
        cleans["n"] += 1
        if step == 5 and cleans["n"] == 2:
            raise Killed
        real_clean(self, record)

    monkeypatch.setattr(rolled.RolledArchive, "_clean", clean)
    with pytest.raises(Killed):
        a.write_batch(orders_of(spark, 12, 1), 1)
    monkeypatch.undo()
    assert a.read(include_open=True).count() == (16 if step == 5 else 4)
    now["t"] = START + 4000                       # the replay comes in the next hour
    again = RolledArchive(spark, a.root, clock=lambda: now["t"], roll_bytes=10 * ROW,
                          roll_seconds=600)
    assert again.write_batch(orders_of(spark, 12, 1), 1) is (step != 5)
    assert again.read(include_open=True).count() == 16
    again.close_open()
    assert again.read().count() == 16
    assert not os.listdir(local_path(f"{a.root}/pending"))


def test_another_stream_is_refused(spark):
    a = archive_at(spark, {"t": START})
    a.write_batch(orders_of(spark, 1, 0), 0, "one")
    with pytest.raises(ValueError, match="another stream"):
        a.write_batch(orders_of(spark, 1, 0), 0, "two")


def test_default_bounds_are_those_of_the_reference():
    assert (ROLL_BYTES, ROLL_SECONDS, S.BATCH_INTERVAL) == (419430400, 3600, "20 seconds")


def test_stream_with_one_file_a_batch_also_for_rejected_rows(spark):
    root = local_path(scratch_path(spark, "t-batches"))
    now = {"t": START}
    a = RolledArchive(spark, f"{root}/archive", clock=lambda: now["t"], roll_bytes=0)
    loads = [SAMPLE[:3], ["only four fields here", "x"], SAMPLE[3:]]
    for i, lines in enumerate(loads):
        write_lines(f"{root}/src/g={i}", "a.txt", lines)
        for _ in range(2):                       # the second run finds nothing new: no batch
            start_rolled_query(stream_folders(spark, f"{root}/src"), a, f"{root}/ckpt",
                               trigger="availableNow").awaitTermination()
    got = [(r.batch, len(r.files), r.rows) for r in a.batches().orderBy("batch").collect()]
    assert got == [(i, 1, len(valid(spark, x))) for i, x in enumerate(loads)]
    assert rows_of(a.read()) == valid(spark, SAMPLE)


# --- compaction -------------------------------------------------------------------------

def load(spark, root, name, lines, layout="ymdh"):
    write_lines(f"{root}/src", name, lines)
    S.start_archive_query(stream_text_dir(spark, f"{root}/src"), f"{root}/data", f"{root}/ckpt",
                          trigger="availableNow", layout=layout).awaitTermination()


@pytest.mark.parametrize("layout", ["ymdh", "hourly"])
def test_an_hour_is_compacted_again_after_late_rows(spark, layout):
    root = local_path(scratch_path(spark, "t-again"))
    done = []
    for i in range(3):
        load(spark, root, f"{i}.txt", SAMPLE[i * 3:i * 3 + 3], layout)
        done += SAMPLE[i * 3:i * 3 + 3]
        assert rows_of(S.read_archive(spark, f"{root}/data", layout)) == valid(spark, done)
        outs = C.compact_all(spark, f"{root}/data", f"{root}/out", rows_per_file=2, layout=layout,
                             delete_inputs=True)
        assert rows_of(S.read_archive(spark, f"{root}/data", layout)) == valid(spark, done)
        assert rows_of(C.read_compacted(spark, f"{root}/out", layout)) == valid(spark, done)
        again = C.compact_all(spark, f"{root}/data", f"{root}/out", layout=layout)
        assert again == outs                       # nothing new: nothing written
    left = [f for _, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")]
    assert left == []                              # all inputs are gone, all rows are there
    hours = {tuple(r[c] for c in S.partition_names(layout)) for r in
             S.read_archive(spark, f"{root}/data", layout).collect()}
    sink = {tuple(r) for r in C.archived_hours(spark, f"{root}/data", layout).collect()}
    assert hours == sink


@pytest.mark.parametrize("where", ["_rewrite", "move_path", "commit", "delete_paths"])
@pytest.mark.parametrize("after", [False, True])
def test_a_crash_between_any_two_steps_loses_and_repeats_nothing(spark, monkeypatch, where, after):
    root = local_path(scratch_path(spark, "t-crash"))
    load(spark, root, "a.txt", SAMPLE[:3])
    C.compact_all(spark, f"{root}/data", f"{root}/out", delete_inputs=True)
    load(spark, root, "b.txt", SAMPLE[3:])
    want = valid(spark, SAMPLE)
    target = CommitLog if where == "commit" else C
    real = getattr(target, where)

    def run(*args, **kw):
        if after:
            real(*args, **kw)
        raise Killed

    monkeypatch.setattr(target, where, run)
    with pytest.raises(Killed):
        C.compact_all(spark, f"{root}/data", f"{root}/out", delete_inputs=True)
    monkeypatch.undo()
    assert rows_of(S.read_archive(spark, f"{root}/data")) == want
    C.compact_all(spark, f"{root}/data", f"{root}/out", delete_inputs=True)
    assert rows_of(S.read_archive(spark, f"{root}/data")) == want
    assert rows_of(C.read_compacted(spark, f"{root}/out")) == want
    left = [f for _, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")]
    assert left == []


def test_files_of_an_hour_are_even(spark):
    root = local_path(scratch_path(spark, "t-even"))
    load(spark, root, "a.txt", [f"u{i % 2} 61.135.7.9 c i 1 2" for i in range(1000)])
    out = C.compact_all(spark, f"{root}/data", f"{root}/out", rows_per_file=100)
    sizes = [spark.read.parquet(f).count() for o in out for f in commitlog.list_files(spark, o)]
    assert sum(sizes) == 1000 and len(sizes) >= 10 and max(sizes) <= 130


def test_missing_hours_and_folders(spark):
    root = local_path(scratch_path(spark, "t-missing"))
    load(spark, root, "a.txt", SAMPLE[:3])
    with pytest.raises(ValueError, match="no committed file"):
        C.compact_hour(spark, f"{root}/data", f"{root}/out", "1999", "01", "01", "00")
    with pytest.raises(FileNotFoundError):
        C.read_compacted(spark, f"{root}/out")
