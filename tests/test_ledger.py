"""Day ledger and KPI deltas: whole results after crashes, replays and repeated days."""

import os

import pytest

from tessera.operators import orders as O
from tessera.plans import jobs
from tessera.plans.commitlog import CommitLog
from tessera.plans.ledger import DayLedger
from tessera.plans.snapshot import SnapshotStore
from tessera.session import local_path, scratch_path
from tessera.sources.text import read_lines, stream_text_dir
from tessera.streaming.kpi_delta import KpiDeltas, start_kpi_delta_query
from tests.conftest import lines_df
from tests.test_jobs import tag_line, usage_line, write
from tests.test_orders import SAMPLE
from tests.test_streaming import RULE_LINES, kpis_as_dict, write_lines

pytestmark = pytest.mark.usefixtures("few_partitions")


class Killed(Exception):
    pass


PROFILE = "mdn string, male double, female double, " + ", ".join(f"age{i} double" for i in range(1, 6))


def days_root(spark):
    root = local_path(scratch_path(spark, "t-ledger"))
    for day in (1, 2, 3):
        write(f"{root}/d{day}/a.txt", [usage_line(f"u{i}", day + i % 2, 10 * day + i) for i in range(6)])
    write(f"{root}/d2-again/a.txt", [usage_line(f"u{i}", 1, 7) for i in range(3)])
    write(f"{root}/tags/t.txt", [tag_line(1, 0.7, 0.3), tag_line(2, 0.1, 0.9), tag_line(3, 0.4, 0.6)])
    seed = spark.createDataFrame([("u0", 0.5, 0.5, *[0.2] * 5), ("old", 0.9, 0.1, *[0.2] * 5)], PROFILE)
    return root, seed


def ledger_of(spark, root, name="store"):
    tags = read_lines(spark, f"{root}/tags", with_order=True)
    return DayLedger(SnapshotStore(spark, f"{root}/{name}"), lambda base, logs: jobs.profiles_with_store(
        base, read_lines(spark, logs), tags, order_col="line_order"))


def profiles(df):
    return sorted(map(tuple, df.collect()))


def by_hand(spark, root, seed, days):
    tags = read_lines(spark, f"{root}/tags", with_order=True)
    out = seed
    for d in days:
        out = jobs.profiles_with_store(out, read_lines(spark, f"{root}/{d}"), tags,
                                       order_col="line_order")
    return profiles(out)


def test_no_day_is_applied_twice(spark):
    root, seed = days_root(spark)
    ledger = ledger_of(spark, root)
    with pytest.raises(FileNotFoundError):
        ledger.apply("d1", [f"{root}/d1"])
    assert ledger.seed(seed) == 0 and ledger.seed(seed) == 0
    assert [ledger.apply(f"d{d}", [f"{root}/d{d}"]) for d in (1, 2, 1, 2, 3, 1)] == [1, 2, 1, 2, 3, 1]
    want = by_hand(spark, root, seed, ["d1", "d2", "d3"])
    assert profiles(ledger.read()) == want == profiles(ledger.store.read())
    assert sorted((r.day, r.version, r.base) for r in ledger.days().collect()) == [
        ("d1", 1, 0), ("d2", 2, 1), ("d3", 3, 2)]
    with pytest.raises(ValueError, match="other inputs"):
        ledger.apply("d2", [f"{root}/d2-again"])
    with pytest.raises(ValueError, match="never applied"):
        ledger.rebuild("d9", [f"{root}/d1"])
    ledger.rebuild("d2", [f"{root}/d2-again"])
    assert profiles(ledger.read()) == by_hand(spark, root, seed, ["d1", "d2-again", "d3"])
    assert sorted((r.day, r.version, r.base) for r in ledger.days().collect()) == [
        ("d1", 1, 0), ("d2", 4, 1), ("d3", 5, 4)]


@pytest.mark.parametrize("rebuild", [False, True])
def test_a_crash_between_data_and_record(spark, monkeypatch, rebuild):
    root, seed = days_root(spark)
    ledger = ledger_of(spark, root)
    ledger.seed(seed)
    ledger.apply("d1", [f"{root}/d1"])
    before = profiles(ledger.read())

    def die(self, number, record):
        raise Killed

    monkeypatch.setattr(CommitLog, "commit", die)
    with pytest.raises(Killed):
        if rebuild:
            ledger.rebuild("d1", [f"{root}/d2-again"])
        else:
            ledger.apply("d2", [f"{root}/d2"])
    monkeypatch.undo()
    again = ledger_of(spark, root)                      # a new process
    assert profiles(again.read()) == before == profiles(again.store.read())
    again.apply("d2", [f"{root}/d2"])
    again.apply("d1", [f"{root}/d1"])
    assert profiles(again.read()) == by_hand(spark, root, seed, ["d1", "d2"])


def test_two_writers_publish_one_version(spark):
    root, seed = days_root(spark)
    one = ledger_of(spark, root)
    one.seed(seed)
    head = one.head()
    one.apply("d1", [f"{root}/d1"])
    two = ledger_of(spark, root)
    two.head = lambda: head                             # has not seen the other's day
    with pytest.raises(RuntimeError, match="another run"):
        two.apply("d2", [f"{root}/d2"])


def test_a_store_from_before_the_ledger(spark):
    root, seed = days_root(spark)
    store = SnapshotStore(spark, f"{root}/store")
    store.write(seed, 0)
    jobs.run_daily_update(store, 0, read_lines(spark, f"{root}/d1"),
                          read_lines(spark, f"{root}/tags", with_order=True), order_col="line_order",
                          day="d1")
    ledger = ledger_of(spark, root)
    assert ledger.apply("d1", [f"{root}/d1"]) == 1      # known from the version's mark
    assert ledger.apply("d2", [f"{root}/d2"]) == 2
    assert profiles(ledger.read()) == by_hand(spark, root, seed, ["d1", "d2"])


# --- KPI deltas -------------------------------------------------------------------------

def changes(spark, rows):
    return spark.createDataFrame(rows, "metric string, key string, value double")


def test_deltas_hold_changed_keys_only_and_merge(spark):
    root = scratch_path(spark, "t-delta")
    store = KpiDeltas(spark, root, merge_every=3)
    assert store.read().count() == 0
    loads = [[("total", "all", 1.0), ("category", "a", 1.0)], [("total", "all", 3.0)], [],
             [("category", "b", 5.0)], [("total", "all", 9.0), ("category", "a", 2.0)]]
    want = {}
    for i, rows in enumerate(loads):
        assert store.write_batch(changes(spark, rows), i, "q")
        assert not store.write_batch(changes(spark, [("total", "all", -1.0)]), i, "q")   # a replay
        want |= {(m, k): v for m, k, v in rows}
        assert kpis_as_dict(store.read()) == want
    assert sorted(tuple(r) for r in store.batches().collect()) == [
        (i, len(rows)) for i, rows in enumerate(loads)]
    last = store.log.last()
    assert last["base"].endswith("000000000003") and len(last["deltas"]) == 1
    assert sorted(os.listdir(local_path(f"{root}/delta"))) == ["000000000002", "000000000004"]
    assert {(r.key, r.batch) for r in store.read().collect()} == {("all", 4), ("a", 4), ("b", 3)}
    with pytest.raises(ValueError, match="another stream"):
        store.write_batch(changes(spark, []), 9, "other")


@pytest.mark.parametrize("where", ["_latest", "commit", "_clean"])
def test_a_killed_batch_is_replayed(spark, monkeypatch, where):
    store = KpiDeltas(spark, scratch_path(spark, "t-kill"), merge_every=2)
    store.write_batch(changes(spark, [("total", "all", 1.0)]), 0, "q")
    target = CommitLog if where == "commit" else KpiDeltas
    real = getattr(target, where)
    calls = {"n": 0}

    def die(self, *a):
        calls["n"] += 1
        if where == "_clean" and calls["n"] == 1:
            return real(self, *a)
        raise Killed

    monkeypatch.setattr(target, where, die)
    with pytest.raises(Killed):
        store.write_batch(changes(spark, [("total", "all", 4.0), ("category", "a", 3.0)]), 1, "q")
    monkeypatch.undo()
    again = KpiDeltas(spark, store.root, merge_every=2)
    again.write_batch(changes(spark, [("total", "all", 4.0), ("category", "a", 3.0)]), 1, "q")
    assert kpis_as_dict(again.read()) == {("total", "all"): 4.0, ("category", "a"): 3.0}
    again.write_batch(changes(spark, [("category", "a", 8.0)]), 2, "q")
    assert kpis_as_dict(again.read()) == {("total", "all"): 4.0, ("category", "a"): 8.0}


def test_delta_stream_equals_batch_and_survives_a_restart(spark):
    root = local_path(scratch_path(spark, "t-delta-stream"))
    store = KpiDeltas(spark, f"{root}/kpi", merge_every=2)
    done = []
    for i in range(0, len(SAMPLE), 5):
        write_lines(f"{root}/src", f"p{i:03d}.txt", SAMPLE[i:i + 5])
        done += SAMPLE[i:i + 5]
        start_kpi_delta_query(stream_text_dir(spark, f"{root}/src"), lines_df(spark, RULE_LINES), store,
                              f"{root}/ckpt", trigger="availableNow").awaitTermination()
        want = kpis_as_dict(jobs.batch_order_kpis(lines_df(spark, done), lines_df(spark, RULE_LINES)))
        assert kpis_as_dict(store.read()) == {k: v for k, v in want.items()}
    rows = O.parse_orders(lines_df(spark, SAMPLE[-5:])).count()
    last = store.batches().orderBy("batch").collect()[-1]
    assert last["keys"] <= 1 + 2 * rows                 # a batch writes what it has changed
