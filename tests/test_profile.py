"""The ordered profile fold: golden values, properties, merge with the store."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as PR
from tessera.operators.tags import TAG_VALUES
from tessera.plans import jobs
from tessera.plans.snapshot import SnapshotStore
from tessera.session import scratch_path

STEP_SCHEMA = "mdn string, app_id string, times bigint, " + ", ".join(
    f"{v} double" for v in TAG_VALUES)


def py_fold(state, steps):
    """Reference arithmetic, written out in plain Python for the tests."""
    s = dict(state)
    for st in steps:
        t = st["times"]
        for group in (PR.GENDER, PR.AGES):
            acc = s[group[0]]
            for n in group[1:]:
                acc = acc + s[n]
            tag = st[group[0]]
            for n in group[1:]:
                tag = tag + st[n]
            d = acc + tag * t
            if d != 0:
                for n in group:
                    s[n] = (s[n] + st[n] * t) / d
    return s


def tagged(spark, rows):
    return spark.createDataFrame(rows, STEP_SCHEMA)


def step(mdn, app, t, male, female, ages=(0.2, 0.2, 0.2, 0.2, 0.2)):
    return (mdn, app, t, male, female, *ages)


def test_golden_gender_fold(spark):
    rows = [step("u", "10", 100, 0.7, 0.3), step("u", "2", 50, 0.2, 0.8),
            step("u", "300", 0, 0.5, 0.5)]
    out = PR.build_profiles(tagged(spark, rows)).collect()[0]
    assert out.male == 0.20976509415647449
    assert out.female == 0.7902349058435256


def test_order_is_by_string_app_id(spark):
    # "10" < "2" < "300"; applying 300, 2, 10 instead gives a different result
    rev = py_fold(PR.PRIOR, [dict(zip(("times",) + TAG_VALUES, (t, m, f, .2, .2, .2, .2, .2)))
                             for t, m, f in ((0, .5, .5), (50, .2, .8), (100, .7, .3))])
    assert abs(rev["male"] - 0.6951077460687245) < 1e-15


def test_zero_tag_leaves_prior(spark):
    rows = [step("u", "1", 10, 0.0, 0.0, (0.0,) * 5)]
    out = PR.build_profiles(tagged(spark, rows)).collect()[0]
    assert (out.male, out.female, out.age1) == (0.5, 0.5, 0.2)


def test_untagged_user_is_kept_with_prior(spark):
    rows = [("u", "1", 10) + (None,) * 7, step("v", "1", 10, 0.9, 0.1)]
    out = {r.mdn: r for r in PR.build_profiles(tagged(spark, rows)).collect()}
    assert out["u"].male == 0.5 and out["u"].age5 == 0.2
    assert out["v"].male != 0.5


def random_steps(rng, n_users=40, max_apps=12):
    rows = []
    for u in range(n_users):
        apps = rng.sample(range(1, 300), rng.randint(1, max_apps))
        for a in apps:
            vals = [rng.random() for _ in range(7)]
            rows.append((f"u{u}", str(a), rng.randint(0, 500), *vals))
    return rows


def test_fold_matches_python_and_sums_to_one(spark):
    rng = random.Random(7)
    rows = random_steps(rng)
    got = {r.mdn: r for r in PR.build_profiles(tagged(spark, rows)).collect()}
    by_user = {}
    for r in rows:
        by_user.setdefault(r[0], []).append(dict(zip(("app_id", "times") + TAG_VALUES, r[1:])))
    for mdn, steps in by_user.items():
        exp = py_fold(PR.PRIOR, sorted(steps, key=lambda s: s["app_id"]))
        for n in PR.PROFILE_VALUES:
            assert got[mdn][n] == exp[n]
        if any(s["times"] > 0 for s in steps):
            assert math.isclose(got[mdn].male + got[mdn].female, 1.0, abs_tol=1e-12)
            assert math.isclose(sum(got[mdn][a] for a in PR.AGES), 1.0, abs_tol=1e-12)


def test_fold_of_concatenation(spark):
    """fold(fold(p, a), b) == fold(p, a ++ b) for the list as is (no re-sorting)."""
    rng = random.Random(3)
    a = [(rng.randint(1, 50), *[rng.random() for _ in range(7)]) for _ in range(5)]
    b = [(rng.randint(1, 50), *[rng.random() for _ in range(7)]) for _ in range(4)]
    st = "array<struct<app_id:string,times:bigint," + ",".join(f"{v}:double" for v in TAG_VALUES) + ">>"
    df = spark.createDataFrame([([("x", *r) for r in a], [("x", *r) for r in b])], f"a {st}, b {st}")
    def steps(c):
        return F.transform(c, lambda x: PR.step_struct(x["times"], {n: x[n] for n in TAG_VALUES},
                                                       x["app_id"]))
    one = F.aggregate(F.concat(steps("a"), steps("b")), PR.prior_state(), PR.fold_step)
    two = F.aggregate(steps("b"), F.aggregate(steps("a"), PR.prior_state(), PR.fold_step),
                      PR.fold_step)
    r = df.select(one.alias("one"), two.alias("two")).collect()[0]
    assert r.one == r.two


def test_repartitioning_does_not_change_result(spark):
    rows = random_steps(random.Random(11))
    base = sorted(tuple(r) for r in PR.build_profiles(tagged(spark, rows)).collect())
    other = sorted(tuple(r) for r in PR.build_profiles(
        tagged(spark, rows).repartition(7, "app_id")).collect())
    assert base == other


def test_merge_with_store(spark):
    store = spark.createDataFrame(
        [("a", 0.9, 0.1, 0.1, 0.2, 0.3, 0.2, 0.2), ("gone", 0.3, 0.7, 0.2, 0.2, 0.2, 0.2, 0.2),
         ("", 0.5, 0.5, 0.2, 0.2, 0.2, 0.2, 0.2)],
        "mdn string, " + ", ".join(f"{v} double" for v in PR.PROFILE_VALUES))
    steps = tagged(spark, [step("a", "5", 10, 0.2, 0.8), step("new", "5", 10, 0.2, 0.8)])
    out = {r.mdn: r for r in PR.merge_profiles(store, steps).collect()}
    assert set(out) == {"a", "gone", "new"}
    assert tuple(out["gone"])[1:] == (0.3, 0.7, 0.2, 0.2, 0.2, 0.2, 0.2)
    exp_a = py_fold(dict(zip(PR.PROFILE_VALUES, (0.9, 0.1, 0.1, 0.2, 0.3, 0.2, 0.2))),
                    [dict(times=10, male=0.2, female=0.8, age1=.2, age2=.2, age3=.2, age4=.2,
                          age5=.2)])
    assert out["a"].male == exp_a["male"] and out["a"].age3 == exp_a["age3"]
    exp_new = py_fold(PR.PRIOR, [dict(times=10, male=0.2, female=0.8, age1=.2, age2=.2, age3=.2,
                                      age4=.2, age5=.2)])
    assert out["new"].male == exp_new["male"]


def test_null_in_store_fails(spark):
    store = spark.createDataFrame([("a", None, 0.1, 0.1, 0.2, 0.3, 0.2, 0.2)],
                                  "mdn string, " + ", ".join(f"{v} double" for v in PR.PROFILE_VALUES))
    with pytest.raises(Exception):
        PR.merge_profiles(store, tagged(spark, [step("a", "5", 10, 0.2, 0.8)])).collect()


def test_daily_update_is_idempotent(spark):
    from tessera.sources import derived as d
    sf = "/root/testdata/sf0.001"
    store = SnapshotStore(spark, scratch_path(spark, "test-store"))
    store.write(d.stored_profiles(spark, sf), 0)
    usage, tags = d.usage_lines(spark, sf), d.tag_lines(spark, sf)
    v1 = jobs.run_daily_update(store, 0, usage, tags)
    first = sorted(tuple(r) for r in store.read(v1).collect())
    v1b = jobs.run_daily_update(store, 0, usage, tags)   # the same day again
    assert v1b == v1 and store.latest() == 1 and store.versions() == [0, 1]
    assert sorted(tuple(r) for r in store.read(v1).collect()) == first
    v2 = jobs.run_daily_update(store, 1, usage, tags)    # the next day folds again
    assert v2 == 2 and sorted(tuple(r) for r in store.read(2).collect()) != first


def test_update_sequence_and_secondary_sort(spark):
    store = spark.createDataFrame([("a", 0.9, 0.1, 0.1, 0.2, 0.3, 0.2, 0.2)],
                                  "mdn string, " + ", ".join(f"{v} double" for v in PR.PROFILE_VALUES))
    sums = spark.createDataFrame([("a", "2", 1), ("a", "10", 1), ("b", "3", 4)],
                                 "mdn string, app_id string, times bigint")
    t = PR.tagged_union(store, sums)
    seq = {(r.mdn, r.app_id): r.seq for r in PR.update_sequence(t).collect()}
    assert seq == {("a", None): 1, ("a", "10"): 2, ("a", "2"): 3, ("b", "3"): 1}
    parts = PR.secondary_sort(t, 3).rdd.glom().collect()
    for p in parts:
        keys = [(r.mdn, 0 if r.source == "store" else 1, r.app_id or "") for r in p]
        assert keys == sorted(keys)


def test_closed_form_equals_fold(spark):
    """m_n = (m_0 + sum_k x_k prod_{j<k} d_j) / prod_j d_j with x_k = v_k t_k,
    d_1 = S_0 + s_1, d_k = 1 + s_k (no zero denominators)."""
    rng = random.Random(21)
    rows = random_steps(rng, n_users=20, max_apps=8)
    got = {r.mdn: r for r in PR.build_profiles(tagged(spark, rows)).collect()}
    by_user = {}
    for r in rows:
        by_user.setdefault(r[0], []).append(dict(zip(("app_id", "times") + TAG_VALUES, r[1:])))
    for mdn, steps in by_user.items():
        steps = sorted(steps, key=lambda s: s["app_id"])
        for group in (PR.GENDER, PR.AGES):
            s0 = sum(PR.PRIOR[n] for n in group)
            ds = [(s0 if k == 0 else 1.0) + sum(st[n] for n in group) * st["times"]
                  for k, st in enumerate(steps)]
            if any(x == 0 for x in ds):
                continue
            total = math.prod(ds)
            for n in group:
                num = PR.PRIOR[n] + sum(st[n] * st["times"] * math.prod(ds[:k])
                                        for k, st in enumerate(steps))
                assert math.isclose(got[mdn][n], num / total, rel_tol=1e-9, abs_tol=1e-12)


def test_sorted_fold_equals_array_fold(spark):
    """The secondary-sort fold (no per-user array) gives bit-identical results,
    including stored-only users, untagged-only users and the stored start row."""
    rng = random.Random(5)
    rows = random_steps(rng, n_users=30, max_apps=15)
    rows += [("untagged", "7", 10) + (None,) * 7]
    steps = tagged(spark, rows).repartition(5)
    store = spark.createDataFrame(
        [(f"u{i}", rng.random(), rng.random(), *[rng.random() for _ in range(5)]) for i in range(0, 30, 3)]
        + [("only_store", 0.3, 0.7, 0.2, 0.2, 0.2, 0.2, 0.2)],
        "mdn string, " + ", ".join(f"{v} double" for v in PR.PROFILE_VALUES))
    a = sorted(tuple(r) for r in PR.build_profiles(steps).collect())
    b = sorted(tuple(r) for r in PR.build_profiles_sorted(steps).collect())
    assert a == b
    a = sorted(tuple(r) for r in PR.merge_profiles(store, steps).collect())
    b = sorted(tuple(r) for r in PR.merge_profiles_sorted(store, steps).collect())
    assert a == b and len(a) == 32


def test_fold_mode_is_the_callers_choice(spark):
    from tessera.sources import derived as d
    sf = "/root/testdata/sf0.001"
    usage, tags = d.usage_lines(spark, sf), d.tag_lines(spark, sf)
    folds = []
    for rows in (2_000_000, 10):                             # tags broadcast, tags shuffled
        for mode in ("array", "sorted"):
            df = jobs.profiles_from_logs(usage, tags, fold_mode=mode, max_broadcast_rows=rows)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert ("MapInArrow" in plan) == (mode == "sorted")
            folds.append(sorted(tuple(r) for r in df.collect()))
    assert all(f == folds[0] for f in folds)


def test_bucketed_store_survives_a_new_catalog(spark):
    from tessera.sources import derived as d
    root = scratch_path(spark, "t-bk-fallback")
    store = SnapshotStore(spark, root, buckets=4, table_prefix="t_fb_" + root.rsplit("-", 1)[-1])
    store.write(d.stored_profiles(spark, "/root/testdata/sf0.001"), 0)
    via_table = sorted(tuple(r) for r in store.read(0).collect())
    spark.sql(f"DROP TABLE {store.table(0)}")          # as in a new app without a metastore
    assert not spark.catalog.tableExists(store.table(0))
    again = store.read(0)                              # re-registered from the _BUCKETS marker
    assert spark.catalog.tableExists(store.table(0))
    spec = {r.col_name: r.data_type for r in spark.sql(
        f"DESCRIBE TABLE EXTENDED {store.table(0)}").collect()}
    assert spec.get("Num Buckets") == "4" and "mdn" in spec.get("Bucket Columns", "")
    assert sorted(tuple(r) for r in again.collect()) == via_table and len(via_table) > 0
    other = SnapshotStore(spark, root, buckets=8, table_prefix="t_fb2_" + root.rsplit("-", 1)[-1])
    plain = other.read(0)                              # spec mismatch: plain Parquet
    assert not spark.catalog.tableExists(other.table(0))
    assert sorted(tuple(r) for r in plain.collect()) == via_table


def test_nan_tag_value_same_in_both_folds(spark):
    rows = [step("u", "1", 10, float("nan"), 0.5), step("u", "2", 5, 0.3, 0.7),
            ("v", "1", 3) + (None,) * 7, step("v", "2", 4, 0.6, 0.4)]
    steps = tagged(spark, rows)
    a = {r.mdn: tuple(r) for r in PR.build_profiles(steps).collect()}
    b = {r.mdn: tuple(r) for r in PR.build_profiles_sorted(steps).collect()}
    assert repr(sorted(a.items())) == repr(sorted(b.items()))   # NaN-aware via repr
    assert a["u"][1] != a["u"][1]        # the NaN tag was applied, not skipped


def test_a_library_above_the_array_bound_is_refused(spark, monkeypatch):
    from tests.conftest import lines_df
    usage = lines_df(spark, ["u|" + "|" * 11 + "5|a|b|1"])
    tags = lines_df(spark, [f"{i}|n|0.5|0.5|0.2|0.2|0.2|0.2|0.2" for i in range(4)],
                    line_no=list(range(4)))
    monkeypatch.setattr(jobs, "MAX_ARRAY_STEPS", 3)
    with pytest.raises(ValueError, match="fold_mode='sorted'"):
        jobs.profiles_from_logs(usage, tags)
    assert jobs.profiles_from_logs(usage, tags, fold_mode="sorted").count() >= 0
