"""Partition report, exact ranks, salted and swept joins, vectorised fold."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ipgeo, partitions, profile
from tessera.operators.ranking import ranked
from tessera.operators.skew import hot_keys, salted_left_join
from tessera.operators.tags import TAG_VALUES, join_tags, join_tags_salted


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_hold_what_the_md5_says(spark):
    users = [f"u{i % 40}" for i in range(500)] + [""]
    df = partitions.partition_by_user_md5(spark.createDataFrame([(u,) for u in users], "mdn string"), 16)
    want = {}
    for u in users:
        p = int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 16
        n, who = want.setdefault(p, [0, set()])
        want[p] = [n + 1, who | {u}]
    got = {r.partition: (r.rows, r.users) for r in partitions.partition_report(df).collect()}
    assert got == {p: (n, len(who)) for p, (n, who) in want.items()}


def test_ranks_are_the_sorted_places(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 50), i) for i in range(2000)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = ranked(df, [F.col("a").asc_nulls_last(), F.col("b")]).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, len(rows) + 1))
    assert ranked(df.limit(0), [F.col("a")]).count() == 0


def test_ranked_merge_equals_the_global_sort(spark):
    rows = [(f"u{i % 9}", None if i % 7 == 0 else str(i), "store" if i % 7 == 0 else "log")
            for i in range(300)]
    rows = sorted(set(rows), key=str)
    df = spark.createDataFrame(rows, "mdn string, app_id string, source string")
    order = [tuple(r) for r in profile.merged_sorted(df).collect()]
    got = sorted((tuple(r) for r in profile.merged_ranked(df).collect()), key=lambda r: r[-1])
    assert [r[:-1] for r in got] == order


HOT = "mdn string, app_id string, times bigint"


def test_salted_join_equals_the_broadcast_join(spark):
    rows = [(f"u{i}", "7", i) for i in range(3000)] + [(f"u{i}", str(i % 50), i) for i in range(2000)]
    rows += [("x", None, 1), ("y", "none", 2)]
    sums = spark.createDataFrame(rows, HOT)
    tags = spark.range(60).where("id <> 7 or id = 7").select(
        F.col("id").cast("string").alias("app_id"),
        *[(F.col("id") + F.lit(i)).cast("double").alias(n) for i, n in enumerate(TAG_VALUES)])
    tiers = hot_keys(sums, "app_id", 16)
    assert [(s, k) for s, k in tiers] == [(16, ["7"])]        # 3040 of 5002 rows: 9.7 shares
    got = join_tags_salted(sums, tags, 16)
    assert sorted(map(str, got.collect())) == sorted(map(str, join_tags(sums, tags).collect()))
    plan = plan_of(got)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    rows_of = salted_left_join(sums, tags.select("app_id"), "app_id", F.col("mdn"), 16)
    assert rows_of.count() == len(rows)


def test_sweep_equals_the_range_join(spark):
    rng = random.Random(4)
    rules = [(i * 100_000, i * 100_000 + 60_000 + 7 * i, f"p{i}") for i in range(1, 60)]
    rules += [(2**31 + 5, 2**31 + 5, "one"), (2**31 + 6, 2**32 - 1, "rest")]
    ips = [rng.randrange(0, 6_000_000) for _ in range(2000)] + [500_000 + i for i in range(3000)]
    ips += [x + d for s, e, _ in rules for x in (s, e) for d in (-1, 0, 1)] + [2**33, 0, 700_001, 700_001]
    table = spark.createDataFrame(rules, "start bigint, end bigint, province string")
    probes = spark.createDataFrame([(ip, f"k{i % 5}") for i, ip in enumerate(ips)], "ip bigint, k string")
    got = ipgeo.attach_province_sweep(probes, table, partitions=16)
    want = [(ip, f"k{i % 5}", next((p for s, e, p in rules if s <= ip <= e), ipgeo.UNKNOWN_PROVINCE))
            for i, ip in enumerate(ips)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "Broadcast" not in plan_of(got) and "NestedLoop" not in plan_of(got)
    # the hot block's probes are in many (block, salt) groups
    tiers = hot_keys(probes.withColumn("b", F.shiftright("ip", 16)), "b", 16)
    assert max(s for s, _ in tiers) >= 8
    with pytest.raises(ValueError, match="overlap"):
        ipgeo.attach_province_sweep(probes, table.union(table), partitions=4)


def test_hot_key_salts_stay_in_proportion(spark):
    df = spark.range(10_000).select(F.when(F.col("id") < 3334, -1).otherwise(F.col("id")).alias("k"))
    assert hot_keys(df, "k", 100) == [(64, [-1])]
    assert hot_keys(df.where("k > 0"), "k", 100) == []
    assert hot_keys(df.limit(0), "k", 100) == []


@pytest.mark.parametrize("size", [1, 3, 64, 10_000])
def test_fold_is_the_same_for_any_batch_size(spark, size):
    """Users cut by batch ends, untagged apps, NaN and zero tags, users without a store row."""
    rng = random.Random(9)
    stored = [(f"u{i}", *[rng.random() for _ in range(7)]) for i in range(0, 60, 2)]
    store = spark.createDataFrame(stored, "mdn string, " + ", ".join(
        f"{n} double" for n in profile.PROFILE_VALUES))
    steps = []
    for i in range(60):
        for a in range(rng.choice([0, 1, 3, 40])):
            v = [None] * 7 if rng.random() < 0.2 else [
                rng.choice([0.0, rng.random(), float("nan") if i == 7 else 0.5]) for _ in range(7)]
            steps.append((f"u{i}", str(a), rng.choice([0, 1, 10**6, 2**60 + 1]), *v))
    tagged = spark.createDataFrame(steps, "mdn string, app_id string, times bigint, " + ", ".join(
        f"{n} double" for n in TAG_VALUES)).cache()
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        got = sorted(map(repr, profile.merge_profiles_sorted(store, tagged).collect()))
    finally:
        spark.conf.set(key, old)
    assert got == sorted(map(repr, profile.merge_profiles(store, tagged).collect()))
