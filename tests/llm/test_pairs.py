"""Near-duplicate operators and the pipeline against brute force, and odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import chosen_path, hnsw, pii
from tessera.llm.common import components, with_rank, with_running_total
from tests.llm.conftest import SF_TINY, odd_documents


def closed(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_by_hand(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)]
    df = spark.createDataFrame([(a, b) for a, b in pairs], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    want = closed({x for p in pairs for x in p if p[0] != p[1]}, pairs)
    assert got == want
    assert components(df.limit(0)).count() == 0


def test_rank_and_running_total(spark):
    rng = np.random.default_rng(6)
    rows = [(int(k), int(v)) for k, v in zip(rng.integers(0, 50, 500), rng.integers(0, 9, 500))]
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "i int, k int, v int")
    order = sorted(range(500), key=lambda i: (rows[i][0], i))
    rank = {r.i: r["rank"] for r in with_rank(df, [F.col("k"), F.col("i")]).collect()}
    assert rank == {i: n for n, i in enumerate(order)}
    total, want = 0, {}
    for i in order:
        want[i] = total
        total += rows[i][1]
    got = with_running_total(df, [F.col("k"), F.col("i")], "v").collect()
    assert {r.i: r.before for r in got} == want


def jaccard_by_hand(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5
                    else frozenset([tuple(w)] if w else []))
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    pairs = []
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j > i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                pairs.append((i, j))
    links = Counter(x for p in pairs for x in p)
    root = closed(range(len(rows)), pairs)
    least = {}
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return Counter((rows[i][0], least.get(root[i]), links[i]) for i in range(len(rows)))


def check_jaccard(table):
    rows = [(r[0], r[1]) for r in table.collect()]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in chosen_path.jaccard_classes(table).collect())
    assert got == jaccard_by_hand(rows)


def test_jaccard_links_by_hand(spark, docs):
    check_jaccard(docs)
    text = " ".join(f"w{i}" for i in range(60))
    check_jaccard(odd_documents(spark, [text, text + " x", text + " y z", text.replace("w30", "v"),
                                        "a b c d", "a b c d", "a b c d e", text]))


def test_hot_groups_stay_exact(spark, monkeypatch):
    """Near copies that no split separates, joined in blocks; a passage that many share."""
    monkeypatch.setattr(chosen_path, "SMALL", 8)
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    rng = np.random.default_rng(7)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 80, rng.integers(0, 3)):
            w[k] = f"x{i}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(100 + i, passage + " " + " ".join(f"q{i}_{k}" for k in range(20))) for i in range(60)]
    check_jaccard(spark.createDataFrame(rows, "doc_id long, text string"))


def sets_of_similarity(rng, pairs, size, both):
    """Pairs of sets of ``size`` hashes, ``both`` of them shared, with their offsets."""
    out = []
    for _ in range(pairs):
        h = rng.integers(0, 2**64, 2 * size - both, np.uint64)
        out += [h[:size], h[size - both:]]
    return np.concatenate(out), np.arange(2 * pairs) * size


def test_sketches_lose_no_link():
    """Equal min-hashes spread like independent draws, and no pair falls below the filter."""
    rng = np.random.default_rng(11)
    h, at = sets_of_similarity(rng, 4000, 90, 80)                # Jaccard 0.8
    m = chosen_path.minhashes(h, at)
    same = m[::2] == m[1::2]
    assert abs(same.mean() - 0.8) < 0.01
    assert same.sum(axis=1).std() < 3.5                          # 3.2 for independent ones
    assert (same.sum(axis=1) >= chosen_path.AGREE).all()
    assert (same[:, :chosen_path.FIRST].sum(axis=1) >= chosen_path.AGREE_FIRST).all()


def test_lost_links_are_noticed(spark, monkeypatch):
    """A filter that drops real links is seen by the exact audit, and the join fails."""
    import pytest
    text = [f"w{i}" for i in range(60)]
    table = spark.createDataFrame([(i, " ".join([*text, f"x{i}"])) for i in range(8)],
                                  "doc_id long, text string")
    asked = chosen_path.asked_nodes(table)
    assert len(asked.nodes) == 8
    rows = chosen_path.sketched(table, asked).collect()
    assert all(r.asked and len(r.near) == 8 for r in rows)
    monkeypatch.setattr(chosen_path, "_decide", lambda batches: iter(()))
    with pytest.raises(RuntimeError, match="0 of 56 links"):
        chosen_path.jaccard_classes(table)


def test_one_of_each_class_stays(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {c if c is not None else d for d, c, _ in jaccard_by_hand(rows)}
    got = chosen_path.deduplicate(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)
    odd = odd_documents(spark)
    kept = sorted(r[0] for r in chosen_path.deduplicate(odd).collect() if r[0] is not None)
    assert kept == [1, 2, 3, 4, 7, 9, 10]
    assert chosen_path.deduplicate(odd.limit(0)).count() == 0


def cosine_by_hand(rows, least=0.98):
    ids = [r[0] for r in rows]
    pairs = []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la is None or la != lb or a is None or b is None or len(a) != len(b) or not a:
                continue
            if None in a or None in b:
                continue
            x, y = np.array(a, float), np.array(b, float)
            if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                if (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= least:
                    pairs.append((j, i))
    links = Counter(x for p in pairs for x in p)
    root = closed(range(len(rows)), pairs)
    least_id = {}
    for i, r in root.items():
        if ids[i] is not None:
            least_id[r] = min(least_id.get(r, ids[i]), ids[i])
    return Counter((ids[i], links[i], least_id.get(root[i]), ids[i] == least_id.get(root[i]))
                   for i in range(len(rows)))


def test_embedding_links_by_hand(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 16))
    rows = []
    for i in range(300):
        c = centers[0] if i % 3 == 0 else centers[i % 40]
        rows.append((i, (c + 0.03 * rng.normal(size=16)).astype(np.float32).tolist(), i % 2))
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0),
             (304, [None] + [1.0] * 15, 0), (305, rows[0][1], None), (306, rows[0][1], 0),
             (307, [2 * x for x in rows[0][1]], 0), (None, rows[3][1], 1), (309, [float("inf")] * 16, 1),
             (310, [1.0, 2.0], 0), (311, [1.0, 2.0], 0), (312, [-0.0, 1.0], 0), (313, [0.0, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS node", "2 AS shard", "3 AS dim", "4 AS LABEL")
    own = [(r[0], r[1], r[2]) for r in table.collect()]
    for shard in (4096, 40):                                    # one shard a label, then several
        got = Counter((r.vec_id, r.n_links, r.component_id, r.kept)
                      for r in hnsw.near_duplicates(table, shard).collect())
        assert got == cosine_by_hand(own)
    assert hnsw.near_duplicates(table.limit(0)).count() == 0


def test_text_labels_are_kept_apart(spark):
    rows = [(1, [1.0, 2.0], "x"), (2, [2.0], "x,1.0"), (3, [2.0], "x,1.0"), (4, [1.0, 2.0], "x"),
            (5, [2.0], "x,1.0,"), (6, [1.0, 2.0], ""), (7, [2.0], ",1.0"), (8, [1.0, 2.0], "1,x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept)
                  for r in hnsw.near_duplicates(table).collect())
    assert got == cosine_by_hand(rows)


def test_graph_search_finds_neighbours():
    rng = np.random.default_rng(9)
    x = hnsw._unit(np.repeat(rng.normal(size=(500, 24)), 4, 0) + 0.02 * rng.normal(size=(2000, 24)))
    graph = hnsw.Graph(x, hnsw.levels(np.array([f"{i * 2654435761 % 2**48:012x}" for i in range(2000)])))
    assert len(graph.near) > 1
    ids, _ = graph.beam(x[:300].astype(np.float32), graph.descend(x[:300].astype(np.float32), 0), 32, 0)
    truth = x[:300] @ x.T >= 0.98
    found = sum(len(set(row) & set(np.flatnonzero(t))) for row, t in zip(ids, truth))
    assert found >= 0.95 * truth.sum()


def twins(n, linked, seed):
    """``n`` directions of their own, and a near copy of each of the rows ``linked``."""
    rng = np.random.default_rng(seed)
    x = hnsw._unit(rng.normal(size=(n, 24)))
    return x, hnsw._unit(x[linked] + 0.01 * rng.normal(size=(len(linked), 24)))


def shard_row(x, shard, blind=False):
    import pickle
    nodes = np.array([f"{shard}{i * 2654435761 % 2**44:011x}" for i in range(len(x))])
    graph = hnsw.Graph(x, np.zeros(len(x), int))
    if blind:                                                   # leads nowhere
        graph.near[0][:] = -1
    return {"shard": shard, "lo": 0, "hi": 1, "graph": pickle.dumps((nodes, np.ones(len(x), int), x, graph))}


def test_links_missed_from_one_side_are_found_from_the_other():
    import pandas as pd
    linked = np.arange(5, 2000, 100)
    x, y = twins(2000, linked, 12)
    y = np.concatenate([hnsw._unit(np.random.default_rng(13).normal(size=(1500, 24))), y])
    got = hnsw._meet(pd.DataFrame([shard_row(x, 0, blind=True), shard_row(y, 1)]))
    truth = int((x @ y.T >= 0.98).sum())
    assert truth >= 20 and got["links"].sum() == 2 * truth
    # a blind shard with itself: trivial links do not hide that the others are missing
    both = np.concatenate([x, y])
    alone = pd.DataFrame([{**shard_row(both, 0, blind=True), "hi": 0}])
    got = hnsw._meet(alone, audit=len(both))
    assert got["truth"].sum() == 2 * truth and got["found"].sum() < 0.1 * truth


def test_several_large_shards_by_scan(spark, monkeypatch):
    """Twins spread over four shards, found although the first beams are narrow."""
    monkeypatch.setattr(hnsw, "BEAM", 2)
    x, y = twins(5000, np.arange(0, 5000, 5), 14)
    x = np.concatenate([x, y]).astype(np.float32)
    unit = hnsw._unit(x)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)],
                                  "vec_id long, embedding array<float>, label int")
    linked = unit @ unit.T >= 0.98
    want = linked.sum(axis=1) - 1
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(table, 1500).collect()}
    wrong = sum(got[i][0] != want[i] for i in got)
    assert want.sum() >= 2000 and wrong <= 0.005 * want.sum()
    assert sum(got[5000 + k][1] != 5 * k for k in range(1000)) <= 5


def test_pipeline_stages(spark, docs):
    names = docs.columns
    table = docs
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, SF_TINY).cache()
        assert table.columns == names, name
        seen.append(table.count())
    assert seen[0] > seen[1] > seen[2] == seen[3] and seen[4] > 0
    assert table.select(pii.mask(F.col("text")).alias("m"), "text").filter("m <> text").count() == 0
    out = corpus_pipeline.run(spark, SF_TINY)
    assert out.count() == seen[4] and out.filter("NOT exact").count() == 0
    assert [r.doc_id for r in out.orderBy("doc_id").collect()] == [
        r.doc_id for r in table.orderBy("doc_id").collect()]


def test_plans_of_components_stay_small(spark, monkeypatch):
    """The driver holds the plan of every query; none reads the edges more than twice."""
    from tessera.llm import common
    seen, cut = [], common.cut

    def watched(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count("Scan "))
        return cut(df)

    monkeypatch.setattr(common, "cut", watched)
    edges = spark.range(40).selectExpr("id + 1 AS a", "id AS b")
    edges = edges.unionByName(edges.selectExpr("a + 100 AS a", "b + 100 AS b")).localCheckpoint()
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i + k: k for i in range(41) for k in (0, 100)}
    assert len(seen) > 2 and max(seen) <= 2


def test_audited_texts_stay_in_the_tasks(spark, monkeypatch):
    """The driver gets the shingle sets of the audited nodes, and takes no text apart itself."""
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(9))) for i in range(20)]
    table = spark.createDataFrame([*rows, *rows, (30, "few words"), (31, " "), (32, None)],
                                  "doc_id long, text string")
    h, at = chosen_path.shingles([t for _, t in rows] + ["few words"])
    want = set(chosen_path._node_keys(h, at[:-1]))

    shingles = chosen_path.shingles

    def in_tasks(texts):
        from pyspark import TaskContext
        assert TaskContext.get() is not None, "texts on the driver"
        return shingles(texts)

    monkeypatch.setattr(chosen_path, "shingles", in_tasks)
    asked = chosen_path.asked_nodes(table)
    assert asked.nodes == want and asked.sizes.sum() == len(h)
