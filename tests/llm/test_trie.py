"""The prefix trie against a dictionary of prefixes; its queue; odd and deep conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.queries import op12_prefix_trie
from tessera.llm.trie import SpillingQueue, keyed_turns, prefix_trie, trie
from tests.llm.conftest import SF_TINY


def by_prefixes(convs):
    """Sorted result rows of ``{conv_id: [(role, text), ...]}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        own = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += own
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k],
                   saved[k], sha(ends[k])) for k, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def conversations(rows):
    """Turns by number, null first; of equal numbers by the digest of role and text."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            out[c].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[3] for t in sorted(v)] for c, v in out.items()}


pytestmark = pytest.mark.usefixtures("few_partitions")
SCHEMA = "conv_id long, turn long, role string, text string"


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_TINY}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    own = conversations(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert rows_of(op12_prefix_trie(spark, SF_TINY)) == by_prefixes(rebuilt)


def random_rows(rng, n, words=("a", "b", "é", None)):
    return [(c, t, rng.choice(["user", None]), rng.choice(words))
            for c in range(n) for t in range(rng.randint(1, 6))]


def test_random_conversations_in_few_and_many_shards(spark):
    rng = random.Random(3)
    rows = random_rows(rng, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    want = by_prefixes(conversations(rows))
    assert rows_of(prefix_trie(df)) == want
    turns = keyed_turns(df).withColumnRenamed("pos", "depth").cache()
    members = turns.groupBy("conv_id").agg(F.count("*").alias("length")).cache()
    for shards, limit in ((1, 3), (1000, 1)):
        assert rows_of(trie(turns, members, limit, shards)) == want


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 5, None, "x" * 10**6),
            (2, None, "", None), (2, 3, "user", None), (None, 1, "user", "lost"), (-7, 2, "us", "er1"),
            (-8, 2, "use", "r1"), (3, 1, "user", "a"), (3, 1, "user", "b"), (3, 1, "user", "b")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'x' AS TEXT", "1 AS depth", "2 AS pos", "3 AS x1", "4 AS length", "5 AS own", "6 AS rank")
    got = prefix_trie(df)
    assert rows_of(got) == by_prefixes(conversations(rows))
    assert prefix_trie(df.limit(0)).count() == 0


def test_members_without_turns_end_at_the_root(spark):
    turns = keyed_turns(spark.createDataFrame([(4, 1, "user", "a")], SCHEMA)).withColumnRenamed(
        "pos", "depth")
    members = spark.createDataFrame([(4, 1), (2, 0), (30, 0)], "conv_id long, length long")
    assert rows_of(trie(turns, members)) == by_prefixes({4: [("user", "a")], 2: [], 30: []})
    none = spark.createDataFrame([(2, 0)], "conv_id long, length long")
    assert rows_of(trie(turns.limit(0), none)) == by_prefixes({2: []})


def test_deep_and_hot_conversations(spark):
    deep = [("user", str(i % 7)) for i in range(700)]
    convs = {c: deep[:700 - (c % 3) * 200] for c in range(40)}
    convs |= {c: [("user", "hello"), ("bot", "hi"), ("user", str(c))] for c in range(100, 250)}
    convs[900] = deep[:600] + [("user", "else")]
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert rows_of(prefix_trie(df)) == by_prefixes(convs)


def test_queue_spills_and_merges():
    rng = random.Random(5)
    for limit in (1, 4, 50, 10**6):
        queue, plain, got = SpillingQueue(limit), [], []
        for step in range(300):
            for _ in range(rng.randint(0, 4)):
                item = ((step + rng.randint(0, 20), 0), rng.randint(0, 9))
                queue.push(item)
                plain.append(item)
            got += list(queue.pop_until((step, 0)))
            assert len(queue.heap) <= limit
        got += list(queue.pop_until((10**6,)))
        assert sorted(got) == sorted(plain)
        assert [g[0] for g in got] == sorted(g[0] for g in got)
