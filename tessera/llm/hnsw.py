"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Vectors are compared only within a label. Equal vectors become one node; the nodes of a
label are dealt by hash to shards of about ``SHARD`` nodes, and each shard gets a graph of
its own. Every pair of shards meets once: the nodes of each query the graph of the other
(or of their own). A beam is widened while it holds nothing but links. An audit compares
``AUDIT`` queries of each task and side with a full scan, links of a node to itself left
out; their counts are added up over all tasks, all queries are audited if that is less than
``AUDIT_LINKS`` links, and while less than ``RECALL`` of them are found, all tasks run again
with wider beams; a beam as wide as the shard is replaced by the scan itself. What the
graphs propose is verified by the cosine in double precision.

Per task and node only a link count and one edge to the smallest linked node leave the
task, so a cluster of near copies costs no row per pair. Components are joined in Spark.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows without a label, link with nothing and are their own component; vectors of different
lengths never link; equal rows link with each other; a null id is never the smallest; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, pick, written

COSINE = 0.98
SHARD = 4096            # nodes of a graph, on average
LINKS = 12              # neighbours per node and layer, twice as many in the lowest
BEAM = 32               # width to start with
RECALL = 0.995          # of the links of the audited queries
AUDIT = 512             # audited queries per task and side, at first
AUDIT_LINKS = 1000      # true links that an audit must rest on unless it has all queries
BLOCK = 512             # queries that advance together


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)        # against overflow of the squares
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Graph:
    """Layered neighbour lists over the rows of ``x`` (unit vectors)."""

    def __init__(self, x: np.ndarray, level: np.ndarray):
        self.x = x.astype(np.float32)
        self.level = level
        n = len(x)
        self.near = [np.full((n, LINKS * (2 if layer == 0 else 1)), -1, np.int32)
                     for layer in range(int(level.max()) + 1)]
        self.entry = int(level.argmax())
        order = np.concatenate([[self.entry], np.delete(np.arange(n), self.entry)])
        done, size = 1, 1
        while done < n:
            size = min(max(32, done), 1024, n - done)
            self._insert(order[done:done + size], order[:done] if done < 256 else None)
            done += size

    # -- search -----------------------------------------------------------------------

    def beam(self, q: np.ndarray, entry: np.ndarray, width: int, layer: int
             ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the best ``width`` nodes met from ``entry`` on (-1: none)."""
        m, n = len(q), len(self.x)
        rows = np.arange(m)[:, None]
        ids = np.full((m, width), -1, np.int64)
        sims = np.full((m, width), -np.inf, np.float32)
        ids[:, 0] = entry
        sims[:, 0] = np.einsum("qd,qd->q", q, self.x[entry])
        seen = np.zeros((m, n + 1), bool)               # column n takes the writes for -1
        seen[:, n] = True
        seen[rows[:, 0], entry] = True
        fresh = ids >= 0
        at_once = max(1, width // 16)
        near = self.near[layer]
        while True:
            live = np.flatnonzero(fresh.any(axis=1))
            if not len(live):
                return ids, sims
            key = np.where(fresh[live], sims[live], -np.inf)
            top = np.argpartition(-key, at_once - 1, axis=1)[:, :at_once] if at_once < width \
                else np.tile(np.arange(width), (len(live), 1))
            use = np.take_along_axis(fresh[live], top, axis=1)
            spots = np.where(use, np.take_along_axis(ids[live], top, axis=1), -1)
            fresh[live[:, None], top] = False
            cand = np.where((spots >= 0)[:, :, None], near[spots], -1).reshape(len(live), -1)
            if at_once > 1:                             # two spots may share a neighbour
                cand.sort(axis=1)
                cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            cand = np.where(seen[live[:, None], cand], -1, cand)
            seen[live[:, None], cand] = True            # -1 is the last column
            full = (cand >= 0).sum(axis=1).max()
            if full == 0:
                continue
            if full < cand.shape[1]:
                cand = -np.sort(-cand, axis=1)[:, :full]
            s = np.einsum("qd,qkd->qk", q[live], self.x[cand])
            s[cand < 0] = -np.inf
            all_ids = np.concatenate([ids[live], cand], axis=1)
            all_sims = np.concatenate([sims[live], s], axis=1)
            all_fresh = np.concatenate([fresh[live], cand >= 0], axis=1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            sims[live] = np.take_along_axis(all_sims, best, axis=1)
            fresh[live] = np.take_along_axis(all_fresh, best, axis=1)

    def descend(self, q: np.ndarray, to_layer: int) -> np.ndarray:
        """The node nearest to each query that greedy search finds above ``to_layer``."""
        at = np.full(len(q), self.entry)
        for layer in range(len(self.near) - 1, to_layer, -1):
            ids, sims = self.beam(q, at, 1, layer)
            at = ids[:, 0]
        return at

    # -- construction -----------------------------------------------------------------

    def _diverse(self, sims: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates those that are nearer to the node than to a neighbour
        taken before, then the rest by similarity; ``most`` of them."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        real = np.isfinite(sims) & (ids >= 0)
        v = self.x[np.where(real, ids, 0)]
        cross = np.einsum("qad,qbd->qab", v, v)
        chosen = np.zeros(real.shape, bool)
        for k in range(ids.shape[1]):
            closest = np.where(chosen, cross[:, k, :], -np.inf).max(axis=1)
            chosen[:, k] = real[:, k] & (closest < sims[:, k]) & (chosen.sum(axis=1) < most)
        rank = np.where(chosen, 0, np.where(real, 1, 2))
        take = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out = np.where(np.take_along_axis(real, take, 1), np.take_along_axis(ids, take, 1), -1)
        if out.shape[1] < most:
            out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
        return out

    def _insert(self, new: np.ndarray, scan: np.ndarray | None) -> None:
        """Adds nodes at once: neighbours from the graph so far (all of it while it is
        small) and from the others that are added with them."""
        top = int(self.level[new].max())
        for lo in range(0, len(new), BLOCK):
            part = new[lo:lo + BLOCK]
            for layer in range(min(top, len(self.near) - 1), -1, -1):
                mine = part[self.level[part] >= layer]
                if not len(mine):
                    continue
                q = self.x[mine]
                if scan is not None:
                    ids = np.tile(scan[self.level[scan] >= layer], (len(mine), 1))
                    sims = q @ self.x[ids[0]].T if ids.size else np.empty((len(mine), 0), np.float32)
                else:
                    ids, sims = self.beam(q, self.descend(q, layer), BEAM, layer)
                peers = new[self.level[new] >= layer]
                both = q @ self.x[peers].T
                both[mine[:, None] == peers[None, :]] = -np.inf
                few = min(2 * LINKS, len(peers))
                pick_ = np.argpartition(-both, few - 1, axis=1)[:, :few]
                ids = np.concatenate([ids, peers[pick_]], axis=1)
                sims = np.concatenate([sims, np.take_along_axis(both, pick_, 1)], axis=1)
                if ids.shape[1] > 3 * BEAM:
                    keep = np.argpartition(-sims, 3 * BEAM - 1, axis=1)[:, :3 * BEAM]
                    ids, sims = np.take_along_axis(ids, keep, 1), np.take_along_axis(sims, keep, 1)
                self.near[layer][mine, :LINKS] = self._diverse(sims, ids, LINKS)
                self._link_back(mine, layer)

    def _link_back(self, mine: np.ndarray, layer: int) -> None:
        """Every neighbour of a new node gets the node as a neighbour, or keeps the more
        diverse ones when its list is full."""
        near = self.near[layer]
        cap = near.shape[1]
        to = near[mine, :LINKS]
        frm = np.repeat(mine, LINKS)[to.ravel() >= 0]
        to = to.ravel()[to.ravel() >= 0]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        width = min(int(counts.max()), 4 * cap) if len(counts) else 0
        for lo in range(0, len(nodes), BLOCK):
            some, at, k = nodes[lo:lo + BLOCK], first[lo:lo + BLOCK], counts[lo:lo + BLOCK]
            slots = at[:, None] + np.arange(width)
            more = np.where(np.arange(width) < k[:, None], frm[np.minimum(slots, len(frm) - 1)], -1)
            ids = np.concatenate([near[some], more], axis=1).astype(np.int64)
            ids = -np.sort(-ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.einsum("qd,qkd->qk", self.x[some], self.x[ids])
            sims[ids < 0] = -np.inf
            near[some] = self._diverse(sims, ids, cap)


def levels(nodes: np.ndarray) -> np.ndarray:
    """A node's top layer, geometric by its (random) key, the same in every run."""
    u = np.array([(int(k[:12], 16) + 1) / 16 ** 12 for k in nodes])
    return np.minimum((-np.log(u) / math.log(LINKS)).astype(int), 6)


def links(queries: np.ndarray, graph: Graph, stored: np.ndarray, least: float = COSINE,
          beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, stored row) of cosine >= ``least`` that the graph leads to."""
    found = [_widened(queries[lo:lo + BLOCK], graph, stored, least, beam, lo)
             for lo in range(0, len(queries), BLOCK)]
    return tuple(np.concatenate([f[i] for f in found]) for i in (0, 1))


def audited(queries: np.ndarray, stored: np.ndarray, a: np.ndarray, own: bool, audit: int
            ) -> np.ndarray:
    """True links of evenly spaced queries by a full scan, and those of them among the found
    links, whose query rows are ``a``."""
    at = np.unique(np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int))
    truth = 0
    for lo in range(0, len(at), BLOCK):
        part = at[lo:lo + BLOCK]
        linked = queries[part] @ stored.T >= COSINE
        if own:
            linked[np.arange(len(part)), part] = False
        truth += int(linked.sum())
    return np.array([truth, int(np.isin(a, at).sum())])


def _widened(q: np.ndarray, graph: Graph, stored: np.ndarray, least: float, beam: int, base: int):
    """Links of a block of queries; a beam that is full of links is widened."""
    n = len(stored)
    todo, out_a, out_b = np.arange(len(q)), [], []
    q32 = q.astype(np.float32)
    while len(todo):
        if beam * 2 > n:                                # the scan is the widest beam
            a, b = np.nonzero(q[todo] @ stored.T >= least)
            out_a.append(todo[a] + base)
            out_b.append(b)
            break
        ids, sims = graph.beam(q32[todo], graph.descend(q32[todo], 0), beam, 0)
        full = sims.min(axis=1) >= least - 1e-4
        done = ~full
        a, k = np.nonzero(done[:, None] & (sims >= least - 1e-4) & (ids >= 0))
        b = ids[a, k]
        exact = np.einsum("pd,pd->p", q[todo[a]], stored[b]) >= least
        out_a.append(todo[a][exact] + base)
        out_b.append(b[exact])
        todo, beam = todo[full], beam * 4
    return (np.concatenate(out_a) if out_a else np.empty(0, int),
            np.concatenate(out_b) if out_b else np.empty(0, int))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    """One shard's nodes -> one row with the graph."""
    group = group.sort_values("node")
    x = _unit(np.stack(group["embedding"].to_numpy()).astype(np.float64))
    nodes = group["node"].to_numpy(str)
    graph = Graph(x, levels(nodes))
    blob = pickle.dumps((nodes, group["copies"].to_numpy(np.int64), x, graph), protocol=5)
    return pd.DataFrame({"label": [group["label"].iloc[0]], "dim": [group["dim"].iloc[0]],
                         "shard": [group["shard"].iloc[0]], "shards": [group["shards"].iloc[0]],
                         "graph": [blob]})


def _meet(pair: pd.DataFrame, beam: int = BEAM, audit: int = AUDIT) -> pd.DataFrame:
    """Two shards (or one with itself) -> link counts and an edge for every linked node, and
    a row without a node that has the true and the found links of the audited queries."""
    pair = pair.sort_values("shard")
    nodes, copies, x, graph = pickle.loads(pair["graph"].iloc[0])
    # a link counts if either end has found it
    if pair["lo"].iloc[0] == pair["hi"].iloc[0]:
        a, b = links(x, graph, x, beam=beam)
        a, b = a[a != b], b[a != b]
        both = np.unique(np.minimum(a, b) * len(nodes) + np.maximum(a, b))
        a, b = both // len(nodes), both % len(nodes)
        seen = audited(x, x, np.concatenate([a, b]), True, audit)
    else:
        more, copies2, x2, graph2 = pickle.loads(pair["graph"].iloc[1])
        a, b = links(x, graph2, x2, beam=beam)
        b2, a2 = links(x2, graph, x, beam=beam)
        both = np.unique(np.concatenate([a * len(more) + b, a2 * len(more) + b2]))
        a, b = both // len(more), both % len(more)
        seen = audited(x, x2, a, False, audit) + audited(x2, x, b, False, audit)
        b = b + len(nodes)
        nodes, copies = np.concatenate([nodes, more]), np.concatenate([copies, copies2])
    count = np.bincount(a, weights=copies[b], minlength=len(nodes)) + np.bincount(
        b, weights=copies[a], minlength=len(nodes))
    root = np.arange(len(nodes))
    while True:                                         # smallest node of each component
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            break
        root = low
    linked = np.flatnonzero(count)
    return pd.DataFrame({"node": [*nodes[linked], None],
                         "links": np.append(count[linked], 0).astype(np.int64),
                         "root": [*nodes[root[linked]], None],
                         "truth": np.append(np.zeros(len(linked), np.int64), seen[0]),
                         "found": np.append(np.zeros(len(linked), np.int64), seen[1])})


def _meeting(beam: int, audit: int):
    def meet(pair: pd.DataFrame) -> pd.DataFrame:
        return _meet(pair, beam, audit)

    return meet


def near_duplicates(table: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = pick(table, "vec_id", "embedding", "label")
    v = F.col("embedding")
    usable = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
              & F.exists(v, lambda c: c != 0))
    # + 0 makes -0 the same as 0, so equal vectors have equal keys
    same = F.transform(v, lambda c: c + F.lit(0).cast("float"))
    # the label's length in front: a label that ends like a component is not taken for one
    label = F.col("label").cast("string")
    key = F.md5(F.concat_ws(",", F.length(label).cast("string"), label, same.cast("array<string>"))
                .cast("binary"))
    rows = rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), key))
    nodes = written(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.count("*").alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("dim", F.size("embedding")), "hnsw-nodes")
    sizes = nodes.groupBy("label", "dim").agg(
        F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    dealt = nodes.select("label", "dim", "node", "copies", "embedding").join(
        sizes, ["label", "dim"]).withColumn("shard", F.expr("pmod(xxhash64(node), shards)").cast("int"))
    kind = dict(rows.dtypes)["label"]
    graphs = written(dealt.groupBy("label", "dim", "shard", "shards").applyInPandas(
        _build, f"label {kind}, dim int, shard int, shards int, graph binary"), "hnsw-graphs")
    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(
        "label", "dim", "shard", "graph", F.least("shard", "other").alias("lo"),
        F.greatest("shard", "other").alias("hi"))
    largest = dealt.groupBy("label", "dim", "shard").count().agg(F.max("count")).first()[0] or 0
    beam, audit = BEAM, AUDIT
    while True:
        met = written(pairs.groupBy("label", "dim", "lo", "hi").applyInPandas(
            _meeting(beam, audit), "node string, links long, root string, truth long, found long"),
            "hnsw-links")
        truth, found = (x or 0 for x in met.agg(F.sum("truth"), F.sum("found")).first())
        if 2 * beam > largest:                          # every query was a scan
            break
        if truth < AUDIT_LINKS and audit < largest:
            audit = largest
        elif found < RECALL * truth:
            beam *= 4
        else:
            break
    met = met.filter("node IS NOT NULL").select("node", "links", "root")
    roots = components(met.filter("node <> root").select(F.col("node").alias("a"),
                                                         F.col("root").alias("b")))
    counted = met.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = nodes.select("node", "copies", "least").join(roots, "node", "left").join(
        counted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of_node.groupBy("root").agg(F.min("least").alias("component_id"))
    known = of_node.join(least, "root").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
