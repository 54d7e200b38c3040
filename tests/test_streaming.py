"""Streaming KPIs equal the batch result, in one or many batches, and survive restarts."""

import os

from tessera.operators import orders as O
from tessera.plans import jobs
from tessera.session import local_path, scratch_path
from tessera.sources.text import stream_text_dir
from tessera.streaming import compact as C
from tessera.streaming import orders as S
from tests.conftest import lines_df
from tests.test_orders import NORTH, SAMPLE

RULE_LINES = [NORTH, "a|b|167772160|184549375|x|y|south|z"]


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def kpis_as_dict(df):
    return {(r.metric, r.key): round(r.value, 2) for r in df.collect()}


def run_kpi(spark, src, root, files_per_trigger):
    q = S.start_kpi_query(stream_text_dir(spark, src, files_per_trigger), lines_df(spark, RULE_LINES),
                          f"{root}/kpi", f"{root}/ckpt", trigger="availableNow")
    q.awaitTermination()
    return kpis_as_dict(S.read_kpis(spark, f"{root}/kpi"))


def test_stream_equals_batch_one_and_many_batches(spark):
    root = local_path(scratch_path(spark, "t-stream"))
    src = f"{root}/src"
    for i in range(0, len(SAMPLE), 3):
        write_lines(src, f"part-{i:03d}.txt", SAMPLE[i:i + 3])
    batch = kpis_as_dict(jobs.batch_order_kpis(lines_df(spark, SAMPLE), lines_df(spark, RULE_LINES)))
    assert batch[("total", "all")] == 684.0
    assert run_kpi(spark, src, f"{root}/one", None) == batch
    assert run_kpi(spark, src, f"{root}/many", 1) == batch


def test_restart_does_not_double_count(spark):
    root = local_path(scratch_path(spark, "t-restart"))
    src = f"{root}/src"
    write_lines(src, "a.txt", SAMPLE[:3])
    first = run_kpi(spark, src, root, 1)
    assert first[("total", "all")] == 183.0       # 120 + 51 + 12
    again = run_kpi(spark, src, root, 1)            # restart, no new input: unchanged
    assert again == first
    write_lines(src, "b.txt", ["zoe 61.135.7.9 garden x 1.5 2"])
    third = run_kpi(spark, src, root, 1)            # one more order: +3
    assert third[("total", "all")] == 186.0
    assert third[("category", "garden")] == first[("category", "garden")] + 3.0


def test_archive_and_compaction(spark):
    root = local_path(scratch_path(spark, "t-archive"))
    src = f"{root}/src"
    for i in range(0, len(SAMPLE), 2):
        write_lines(src, f"p{i:03d}.txt", SAMPLE[i:i + 2])
    q = S.start_archive_query(stream_text_dir(spark, src, 2), f"{root}/data", f"{root}/ckpt",
                              trigger="availableNow", zone="Asia/Shanghai")
    q.awaitTermination()
    arch = S.read_archive(spark, f"{root}/data")
    rows = arch.collect()
    assert len(rows) == 6
    r = rows[0]
    assert len(r.year) == 4 and len(r.month) == 2 and len(r.day) == 2 and len(r.hour) == 2
    expected = sorted(tuple(x) for x in O.parse_orders(lines_df(spark, SAMPLE)).collect())
    assert sorted(tuple(x)[:7] for x in rows) == expected
    outs = C.compact_all(spark, f"{root}/data", f"{root}/compacted", rows_per_file=4)
    assert len(outs) >= 1
    comp = C.read_compacted(spark, f"{root}/compacted").select(*O.ORDER_COLUMNS)
    assert sorted(tuple(x) for x in comp.collect()) == expected
    files = [f for o in outs for f in os.listdir(local_path(o)) if f.endswith(".parquet")]
    assert len(files) == sum(1 for _ in outs) * 2 or len(files) >= 2   # 6 rows / 4 per file


def test_kpi_versions_are_pruned(spark):
    from tessera.plans.snapshot import SnapshotStore
    root = local_path(scratch_path(spark, "t-retain"))
    src = f"{root}/src"
    for i in range(0, len(SAMPLE), 2):
        write_lines(src, f"p{i:03d}.txt", SAMPLE[i:i + 2])
    q = S.start_kpi_query(stream_text_dir(spark, src, 1), lines_df(spark, RULE_LINES),
                          f"{root}/kpi", f"{root}/ckpt", trigger="availableNow", retain_versions=2)
    q.awaitTermination()
    store = SnapshotStore(spark, f"{root}/kpi")
    assert store.versions() == [5, 6]     # 7 batches (one file each), the last 2 kept
    assert kpis_as_dict(S.read_kpis(spark, f"{root}/kpi"))[("total", "all")] == 684.0


def test_hourly_layout_archive_and_compaction(spark):
    root = local_path(scratch_path(spark, "t-hourly"))
    src = f"{root}/src"
    write_lines(src, "a.txt", SAMPLE)
    q = S.start_archive_query(stream_text_dir(spark, src), f"{root}/data", f"{root}/ckpt",
                              trigger="availableNow", zone="Asia/Shanghai", layout="hourly",
                              files_per_batch=1)
    q.awaitTermination()
    arch = S.read_archive(spark, f"{root}/data", "hourly").collect()
    assert len(arch) == 6 and len(arch[0].dt_hour) == len("2024-01-02-03")
    outs = C.compact_all(spark, f"{root}/data", f"{root}/compacted", layout="hourly")
    comp = C.read_compacted(spark, f"{root}/compacted").select(*O.ORDER_COLUMNS)
    expected = sorted(tuple(x) for x in O.parse_orders(lines_df(spark, SAMPLE)).collect())
    assert sorted(tuple(x) for x in comp.collect()) == expected and len(outs) >= 1


def test_archive_restart_is_exactly_once(spark):
    root = local_path(scratch_path(spark, "t-arch-restart"))
    src = f"{root}/src"
    write_lines(src, "a.txt", SAMPLE[:4])

    def run():
        q = S.start_archive_query(stream_text_dir(spark, src, 1), f"{root}/data", f"{root}/ckpt",
                                  trigger="availableNow")
        q.awaitTermination()
        return S.read_archive(spark, f"{root}/data").count()

    assert run() == 4
    assert run() == 4                       # restart without new input: nothing rewritten
    write_lines(src, "b.txt", SAMPLE[4:6])
    assert run() == 6                       # only the new file is appended


def test_foreign_kpi_root_is_refused(spark):
    import pytest
    root = local_path(scratch_path(spark, "t-foreign"))
    write_lines(f"{root}/src", "a.txt", SAMPLE)
    run_kpi(spark, f"{root}/src", root, None)
    with pytest.raises(Exception, match="another writer"):
        q = S.start_kpi_query(stream_text_dir(spark, f"{root}/src"), lines_df(spark, RULE_LINES),
                              f"{root}/kpi", f"{root}/other", trigger="availableNow")
        q.awaitTermination()


def test_compaction_keeps_what_commits_meanwhile(spark, monkeypatch):
    root = local_path(scratch_path(spark, "t-meanwhile"))

    def archive(name, lines):
        write_lines(f"{root}/src", name, lines)
        S.start_archive_query(stream_text_dir(spark, f"{root}/src"), f"{root}/data", f"{root}/ckpt",
                              trigger="availableNow").awaitTermination()

    archive("a.txt", SAMPLE[:3])
    hour = S.read_archive(spark, f"{root}/data").select("year", "month", "day", "hour").first()
    real = C.math.ceil

    def late(x):                        # between the count and the write
        archive("b.txt", SAMPLE[3:6])
        return real(x)

    monkeypatch.setattr(C.math, "ceil", late)
    C.compact_hour(spark, f"{root}/data", f"{root}/out", *hour, delete_inputs=True)
    monkeypatch.undo()
    assert C.read_compacted(spark, f"{root}/out").count() == 3
    assert S.read_archive(spark, f"{root}/data").count() == 6    # compacted and late rows
