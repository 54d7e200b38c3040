"""Physical plans of the registered queries: the shapes we rely on at scale."""

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()
NAMES = sorted(set(QUERIES) - set(E.LLM_QUERIES))
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")
# the sorted fold is the one operator in Python
WITH_PYTHON = {"profile_merge_sorted": {"MapInArrow"}}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """The plans of all tables that are written while a query is built (snapshots, landings,
    join sides, the batches of its streams)."""
    plans = []

    def seen(real):
        def run(self, *args, **kw):
            plans.append(physical(self._df))
            return real(self, *args, **kw)
        return run

    for name in ("parquet", "text", "saveAsTable", "save"):
        monkeypatch.setattr(DataFrameWriter, name, seen(getattr(DataFrameWriter, name)))
    return plans


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_cartesian_or_python(spark, name, written):
    plans = [physical(QUERIES[name](spark, SF_SMALL)), *written]
    for plan in plans:
        for bad in ("NestedLoopJoin", "CartesianProduct"):
            assert bad not in plan, f"{name}: {bad} in plan"
    found = {p for p in PYTHON for plan in plans if p in plan}
    assert found == WITH_PYTHON.get(name, set())


def test_sorted_fold_plan(spark):
    """The one Python operator: a per-partition fold over rows hash-partitioned
    by mdn and sorted within partitions (no grouping operator, no collect)."""
    from tessera.plans import jobs
    from tessera.sources import derived as d
    df = jobs.profiles_from_logs(d.usage_lines(spark, SF_SMALL), d.tag_lines(spark, SF_SMALL),
                                 fold_mode="sorted")
    plan = physical(df)
    assert "MapInArrow" in plan and "collect_list" not in plan
    assert "hashpartitioning(mdn" in plan and "Sort [mdn" in plan


@pytest.mark.parametrize("name", ["usage_tag_join", "profile_build", "ip_province", "order_kpi"])
def test_dimension_joins_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in physical(QUERIES[name](spark, SF_SMALL))


def test_scans_read_only_needed_columns(spark):
    plan = physical(QUERIES["order_etl"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = physical(QUERIES["usage_by_user_app"](spark, SF_SMALL))
    assert "partial_sum" in plan
    kpi = physical(QUERIES["order_kpi"](spark, SF_SMALL))
    assert "partial_sum" in kpi


def test_bucketed_snapshot_merge_skips_the_store_exchange(spark):
    from tessera.plans import jobs
    from tessera.plans.snapshot import SnapshotStore
    from tessera.session import scratch_path
    from tessera.sources import derived as d
    root = scratch_path(spark, "t-bucket")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = SnapshotStore(spark, root, buckets=n, table_prefix="t_bucket_" + root.rsplit("-", 1)[-1])
    store.write(d.stored_profiles(spark, SF_SMALL), 0)
    spark.sql(f"DROP TABLE {store.table(0)}")   # a new application: re-registered from the marker
    merged = jobs.profiles_with_store(store.read(0), d.usage_lines(spark, SF_SMALL),
                                      d.tag_lines(spark, SF_SMALL))
    lines = physical(merged).splitlines()
    scan = next(i for i, ln in enumerate(lines) if "t_bucket_" in ln and "FileScan" in ln)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    # walk up from the snapshot scan to the join: no Exchange on the way
    for ln in reversed(lines[:scan]):
        d_ = len(ln) - len(ln.lstrip(" :+-"))
        if d_ < depth:
            assert "Exchange" not in ln, ln
            depth = d_
            if "SortMergeJoin" in ln:
                break
    v = jobs.run_daily_update(store, 0, d.usage_lines(spark, SF_SMALL), d.tag_lines(spark, SF_SMALL))
    assert store.read(v).count() == merged.count()
