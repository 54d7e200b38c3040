"""Jaccard self-join on word shingles by the chosen-path method.

Documents become sets of hashed five-word shingles; equal sets become one node. Each node
is embedded by ``COORDS`` min-hashes. A run starts from all nodes and splits recursively:
every bucket draws ``BRANCH`` random coordinates, its nodes go on to the sub-bucket of
their value at each. A bucket of at most ``SMALL`` nodes is joined by brute force; so is
one that splitting does not take apart (most of its pairs agree at a random coordinate)
and one at ``DEPTH``. Large buckets are joined in blocks.

With two draws and similarity s a pair stays together with probability
p = 1 - (1 - s p)^2 at any depth, at least 0.93 for s = 0.8, so it is missed by all of the
``RUNS`` runs once in 50,000 times. Two audits double the runs until both reach ``TARGET``:
one estimates the recall from how many runs have found each link (Chao's estimator); the
other compares the links of ``AUDIT`` nodes, drawn by hash, with those that their shingle
sets have with the sets of all rows, so it also sees what the sketches lose. If that is
still not met at ``MOST`` runs, the join fails instead of giving an incomplete result.

A pair that meets in several buckets counts in its smallest common bucket only, so counts
are exact without pairs being shuffled: a task ships per node a link count and one edge
to the smallest linked node. Min-hashes propose a pair, the shingle sets decide; a pair of
similarity 0.8 has fewer than ``AGREE`` equal min-hashes once in a billion times (``LOST``).

Edge cases: a text that is null or has no word links with nothing and is its own class;
one of fewer than five words is a single shingle; equal texts link; equal rows are copies
of each other; the class is the smallest id in it (null if all are null); an empty table
gives an empty result; other columns are ignored, or kept by ``deduplicate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, partitions, pick, written

SHINGLE = 5
JACCARD = 0.8
COORDS = 64
BRANCH = 2
RUNS = 4
SMALL = 512
BLOCK = 1024
DEPTH = 12
STUCK = 0.5             # share of a bucket's pairs that agree at a random coordinate
TARGET = 0.99
MOST = 16               # runs; the low four bits of a path tell the run
LOST = 1e-9             # share of the pairs of similarity JACCARD that a filter step may lose
FIRST = 16              # coordinates of the first filter step
AUDIT = 512             # nodes whose links are compared with exact overlaps
AUDIT_CHARS = 1 << 24   # characters of their texts together
SLICE = 1 << 20         # characters of text handled at a time

_B = 0x9E3779B97F4A7C15


def _least_agreeing(n: int) -> int:
    """The largest number of equal coordinates out of ``n`` independent ones that all but
    ``LOST`` of the pairs of similarity ``JACCARD`` reach."""
    below = 0.0
    for k in range(n + 1):
        below += math.comb(n, k) * JACCARD ** k * (1 - JACCARD) ** (n - k)
        if below > LOST:
            return k
    return n


AGREE_FIRST, AGREE = _least_agreeing(FIRST), _least_agreeing(COORDS)

def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


# unrelated, so that the coordinates are independent: multiples of one number are not
_SEEDS = np.random.default_rng(7).integers(1, 2**64 - 1, COORDS, np.uint64).tolist()


def minhashes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``COORDS`` min-hashes of each set; the sets begin at ``first``."""
    mins = np.stack([np.minimum.reduceat(_mix(h, seed), first) for seed in _SEEDS], axis=1)
    return (mins >> np.uint64(8)).astype(np.uint32).view(np.int32)


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as far as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = pow(_B, -1, 2**64)
            one = np.ones(1, np.uint64)
            cls.up = np.cumprod(np.concatenate([one, np.full(n, _B, np.uint64)]))
            cls.down = np.cumprod(np.concatenate([one, np.full(n, inverse, np.uint64)]))
        return cls.up, cls.down


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, text by text in rising order, and the offsets."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([b"", *raw, b""]), np.uint8)
    begins = np.cumsum([1] + [len(r) + 1 for r in raw])
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    up, down = _Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    word = _mix((sums[ends] - sums[starts]) * down[starts])
    owner = np.searchsorted(begins, starts, "right") - 1
    n = len(word) - SHINGLE + 1
    h, own = np.empty(0, np.uint64), np.empty(0, np.int64)
    if n > 0:
        h = word[:n].copy()
        for k in range(1, SHINGLE):
            h = h * np.uint64(_B) + word[k:n + k]
        same = owner[:n] == owner[SHINGLE - 1:]
        h, own = _mix(h[same], 5), owner[:n][same]
    counts = np.bincount(owner, minlength=len(texts))
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):     # one shingle, all its words
        at = np.flatnonzero(owner == i) if len(starts) < 64 else np.arange(
            *np.searchsorted(owner, [i, i + 1]))
        one = len(at)
        for w in word[at].tolist():
            one = (one * _B + w) % 2**64
        h, own = np.append(h, _mix(np.array([one], np.uint64), 5)), np.append(own, i)
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    h, own = h[new], own[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(texts)))])


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, n in enumerate(lengths):
        if i > lo and size + n > SLICE:
            yield lo, i
            lo, size = i, 0
        size += n
    if lengths:
        yield lo, len(lengths)


def _node_keys(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits of each set: two sums of mixed shingles."""
    a, b = (np.add.reduceat(_mix(h, seed), first) for seed in (11, 12))
    return [x.tobytes() + y.tobytes() for x, y in zip(a.astype(">u8"), b.astype(">u8"))]


def row_key(doc_id: Column, text: Column) -> Column:
    """64 bits of a row's id and text."""
    return F.xxhash64(F.xxhash64(text), F.coalesce(doc_id.cast("string"), F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, rk`` of all rows."""
    return pick(docs, "doc_id", "text").withColumn("rk", row_key(F.col("doc_id"), F.col("text")))


class Asked:
    """Shingle sets of the audited nodes, and the rows of a table that link with them."""

    def __init__(self, own: dict[bytes, np.ndarray]):
        self.nodes = set(own)
        self.sizes = np.array([len(x) for x in own.values()], np.int64)
        flat = np.concatenate([np.empty(0, np.uint64), *own.values()])
        of = np.repeat(np.arange(len(own)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.of = of[order]                                 # nodes, shingle by shingle
        self.shingle, self.first = np.unique(flat[order], return_index=True)
        self.times = np.diff(np.append(self.first, len(flat)))

    def linked(self, h: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Rows (of the sets ``h`` with offsets ``at``) and the audited nodes they link with."""
        n = len(self.sizes)
        if not n:
            return
        for lo in range(0, len(at) - 1, 1024):
            ends = at[lo:lo + 1025]
            part = h[ends[0]:ends[-1]]
            where = np.minimum(np.searchsorted(self.shingle, part), len(self.shingle) - 1)
            hit = np.flatnonzero(self.shingle[where] == part)
            if not len(hit):
                continue
            row = np.searchsorted(ends, hit + ends[0], "right") - 1
            where = where[hit]
            times = self.times[where]
            skip = np.cumsum(times) - times
            of = self.of[np.repeat(self.first[where] - skip, times) + np.arange(times.sum())]
            both = np.bincount(np.repeat(row, times) * n + of, minlength=(len(ends) - 1) * n)
            both = both.reshape(-1, n)
            size = np.diff(ends)[:, None] + self.sizes[None, :] - both
            near = (both > 0) & (both >= JACCARD * size)
            for i in np.flatnonzero(near.any(axis=1)):
                yield lo + int(i), np.flatnonzero(near[i]).astype(np.int32)


def asked_nodes(docs: DataFrame) -> Asked:
    """The nodes to audit: ``AUDIT`` rows by hash of their key, as far as their texts have
    ``AUDIT_CHARS`` characters together."""
    rows = _keyed(docs)
    drawn = rows.select("rk", F.length("text").alias("n")).filter("n > 0").orderBy(
        F.xxhash64("rk"), "rk").limit(AUDIT).collect()
    keys, size = [], 0
    for r in drawn:
        if size + r.n <= AUDIT_CHARS:
            keys.append(r.rk)
            size += r.n
    # the sets come from tasks: taking the texts apart needs some sixty times their size
    sets = _shingled(rows.filter(F.col("rk").isin(keys))).dropDuplicates(["node"]).collect()
    return Asked({bytes(r.node): np.frombuffer(r.shingles, np.uint64) for r in sets})


def sketched(docs: DataFrame, asked: Asked) -> DataFrame:
    """``doc_id, rk, node, sketch, asked, near``: node is null for a text without words,
    near has the audited nodes that the row links with."""
    rows = pick(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in _slices([len(t or "") for t in texts]):
                h, at = shingles(texts[lo:hi])
                has = np.flatnonzero(np.diff(at))
                node: list = [None] * (hi - lo)
                sketch: list = [None] * (hi - lo)
                near: list = [None] * (hi - lo)
                if len(has):
                    mins = minhashes(h, at[has])
                    for i, key, m in zip(has, _node_keys(h, at[has]), mins):
                        node[i], sketch[i] = key, m
                    for i, q in asked.linked(h, at):
                        near[i] = q
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(node, pa.binary()), pa.array(sketch, pa.list_(pa.int32())),
                     pa.array([x in asked.nodes for x in node], pa.bool_()),
                     pa.array(near, pa.list_(pa.int32()))],
                    names=["doc_id", "rk", "node", "sketch", "asked", "near"])

    return rows.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("rk"),
                       "text").mapInArrow(run, f"doc_id {kind}, rk long, node binary, sketch array<int>, "
                                          "asked boolean, near array<int>")


# -- buckets ------------------------------------------------------------------------------

def _children(path: Column, run: Column, sketch: Column) -> Column:
    """The sub-buckets of a node below ``path``: as many coordinates as branches, all
    different, drawn by the path alone. The low four bits of a path tell its run."""
    start = F.pmod(F.xxhash64(path, F.lit(0)), F.lit(COORDS))
    out = []
    for c in range(BRANCH):
        step = F.pmod(F.xxhash64(path, F.lit(1)), F.lit(COORDS // BRANCH - 1)) + 1
        coord = F.pmod(start + c * step, F.lit(COORDS)).cast("int")
        child = F.xxhash64(path, coord, F.get(sketch, coord))
        out.append(F.shiftleft(F.shiftright(child, 4), 4).bitwiseOR(run.cast("long")))
    return F.array(*out)


def buckets(nodes: DataFrame, runs: int) -> DataFrame:
    """``(path, n, node)``: the leaves of ``runs`` runs with two nodes or more."""
    # all nodes share the root of each run
    rows = nodes.select("node", "sketch", F.explode(F.array(*[F.lit(r) for r in range(runs)])).alias("run"))
    rows = rows.select("node", F.explode(_children(F.col("run").cast("long"), F.col("run"),
                                                   F.col("sketch"))).alias("path"))
    leaves = []
    counts = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
    live = written(rows.join(counts, "path"), "path-0")
    for depth in range(1, DEPTH + 1):
        leaves.append(live.filter(f"n <= {SMALL}"))
        large = live.filter(f"n > {SMALL}")
        if depth == DEPTH or not large.take(1):
            leaves.append(large)
            break
        run = F.col("path").bitwiseAND(F.lit(15).cast("long"))
        kids = large.join(nodes.select("node", "sketch"), "node").select(
            "node", "path", "n", F.posexplode(_children(F.col("path"), run, F.col("sketch"))).alias(
                "draw", "child"))
        kids = written(kids, f"path-kids-{depth}")
        sizes = kids.groupBy("path", "n", "draw", "child").agg(F.count("*").alias("m"))
        # share of the pairs of a bucket that agree, averaged over its draws
        agree = sizes.groupBy("path", "n").agg(
            (F.sum(F.col("m") * (F.col("m") - 1)) / (BRANCH * F.col("n") * (F.col("n") - 1))
             ).alias("agree"))
        stuck = written(agree.filter(F.col("agree") >= STUCK).select("path"), f"path-stuck-{depth}")
        leaves.append(large.join(stuck, "path", "left_semi"))
        split = sizes.filter("m > 1").join(stuck, "path", "left_anti").groupBy(
            F.col("child").alias("path")).agg(F.sum("m").alias("n"))
        live = written(kids.select("node", "path", "child").join(stuck, "path", "left_anti").select(
            F.col("child").alias("path"), "node").join(split, "path"), f"path-{depth}")
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out.select("path", "n", "node")


def _dealt(leaves: DataFrame) -> DataFrame:
    """Blocks of large buckets: each row goes to all pairs of blocks that its own is in."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = leaves.withColumn("blocks", blocks).withColumn(
        "block", F.expr("pmod(xxhash64(node, path), blocks)").cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "path", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "node")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole (path, lo, hi) groups out of batches sorted by these columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        key = [table.column(c).to_numpy() for c in ("path", "lo", "hi")]
        last = np.logical_and.reduce([k == k[-1] for k in key])
        cut = int(np.flatnonzero(~last).max()) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _meetings(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs that meet in a group, some hundred thousand at a time."""
    path, lo, hi, block = (table.column(c).to_numpy() for c in ("path", "lo", "hi", "block"))
    new = np.ones(len(path), bool)
    new[1:] = (path[1:] != path[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    first = np.append(np.flatnonzero(new), len(path))
    left, right, size = [], [], 0
    for a, b in zip(first[:-1], first[1:]):
        if lo[a] == hi[a]:
            i, j = np.triu_indices(b - a, 1)
            i, j = i + a, j + a
        else:
            i, j = (x.ravel() for x in np.meshgrid(
                a + np.flatnonzero(block[a:b] == lo[a]), a + np.flatnonzero(block[a:b] == hi[a])))
        for k in range(0, len(i), 200_000):
            left.append(i[k:k + 200_000])
            right.append(j[k:k + 200_000])
            size += len(left[-1])
            if size >= 200_000:
                yield np.concatenate(left), np.concatenate(right)
                left, right, size = [], [], 0
    if size:
        yield np.concatenate(left), np.concatenate(right)


class _Common:
    """The smallest bucket that two rows share, and how many runs bring them together."""

    def __init__(self, leaves: list[np.ndarray]):
        width = max(map(len, leaves))
        mine = np.zeros((len(leaves), width), np.int64)         # rising, then zeros
        for r, x in enumerate(leaves):
            mine[r, :len(x)] = x
        # near copies share their buckets: rows with equal lists are looked at once
        self.mine, self.kind = np.unique(mine, axis=0, return_inverse=True)
        self.kind = self.kind.ravel()
        self.runs = np.unique(self.mine[self.mine != 0] & 15)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs, at = np.unique(self.kind[i] * len(self.mine) + self.kind[j], return_inverse=True)
        first, runs = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        step = max(1, 4_000_000 // self.mine.shape[1] ** 2)
        for k in range(0, len(pairs), step):
            a, b = self.mine[pairs[k:k + step] // len(self.mine)], self.mine[pairs[k:k + step] % len(self.mine)]
            both = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != 0)
            first[k:k + step] = a[np.arange(len(a)), both.argmax(axis=1)]
            for run in self.runs:
                runs[k:k + step] += (both & ((a & 15) == run)).any(axis=1)
        return first[at], runs[at]


_GROUP = "path long, lo int, hi int"


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose min-hashes agree with another row's, in the pair's smallest bucket."""
    for table in _whole_groups(batches):
        n = table.num_rows
        sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(n, COORDS)
        leaves = [np.asarray(x) for x in table.column("leaves").to_numpy()]
        path = table.column("path").to_numpy()
        wanted = np.zeros(n, bool)
        common = _Common(leaves)
        for i, j in _meetings(table):
            mine = common(i, j)[0] == path[i]
            i, j = i[mine], j[mine]
            same = np.zeros(len(i), np.int16)
            for c in range(COORDS):
                column = sketch[:, c]
                same += column[i] == column[j]
                if c == FIRST - 1:      # most pairs of a mixed bucket agree nowhere
                    near = same >= AGREE_FIRST
                    i, j, same = i[near], j[near], same[near]
            near = same >= AGREE
            wanted[i[near]] = wanted[j[near]] = True
        keep = table.select(["path", "lo", "hi", "block", "node", "leaves", "copies"]).filter(
            pa.array(wanted))
        yield from keep.combine_chunks().to_batches()


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links by the shingle sets: per node a count, an edge, and how often links were found."""
    for table in _whole_groups(batches):
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        leaves = [np.asarray(x) for x in table.column("leaves").to_numpy()]
        path = table.column("path").to_numpy()
        copies = table.column("copies").to_numpy()
        node = np.array(table.column("node").to_pylist(), object)
        new = np.flatnonzero(np.append(True, (path[1:] != path[:-1])
                                       | (np.diff(table.column("lo").to_numpy()) != 0)
                                       | (np.diff(table.column("hi").to_numpy()) != 0)))
        group = np.zeros(len(path), np.int64)
        group[new] = 1
        group = np.cumsum(group)
        count = np.zeros(len(path), np.int64)
        once, twice, links, degree = (np.zeros(len(path), np.int64) for _ in range(4))
        root = np.arange(len(path))
        left, right = [], []
        overlap, common = _Overlap(sets, group), _Common(leaves)
        for i, j in _meetings(table):
            first, runs = common(i, j)
            mine = first == path[i]
            i, j, runs = i[mine], j[mine], runs[mine]
            both = overlap(i, j)
            size = overlap.sizes[i] + overlap.sizes[j] - both
            ok = both >= JACCARD * size
            i, j, runs = i[ok], j[ok], runs[ok]
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            np.add.at(links, i, 1)
            np.add.at(degree, i, 1)
            np.add.at(degree, j, 1)
            np.add.at(once, i[runs == 1], 1)
            np.add.at(twice, i[runs == 2], 1)
            left.append(i)
            right.append(j)
        if not left or not count.any():
            continue
        i, j = np.concatenate(left), np.concatenate(right)
        order = np.argsort(np.argsort(node))            # nodes by their order
        low = order.copy()
        while True:
            nxt = low.copy()
            np.minimum.at(nxt, i, low[j])
            np.minimum.at(nxt, j, low[i])
            if (nxt == low).all():
                break
            low = nxt
        by_order = np.argsort(order)
        root = by_order[low]
        hit = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[hit], pa.binary()), pa.array(count[hit]),
             pa.array(node[root[hit]], pa.binary()), pa.array(links[hit]), pa.array(once[hit]),
             pa.array(twice[hit]), pa.array(degree[hit])],
            names=["node", "n", "root", "links", "once", "twice", "degree"])


class _Overlap:
    """Sizes of intersections of rows of one group, group after group."""

    def __init__(self, sets: list[np.ndarray], group: np.ndarray):
        self.sets, self.group = sets, group
        self.sizes = np.array([len(s) for s in sets], np.int64)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        which = self.group[i]
        for g in np.unique(which):
            at = np.flatnonzero(which == g)
            if len(at) <= 64:
                for k in at:
                    out[k] = len(np.intersect1d(self.sets[i[k]], self.sets[j[k]], True))
                continue
            members = np.unique(np.concatenate([i[at], j[at]]))
            flat = np.concatenate([self.sets[m] for m in members])
            row = np.repeat(np.arange(len(members)), self.sizes[members])
            _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
            shared = times > 1
            number = np.cumsum(shared) - 1
            row, column = row[shared[column]], number[column[shared[column]]]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            gram = np.zeros((len(members), len(members)), np.float32)
            width = 4096
            for c in range(0, int(shared.sum()), width):
                lo, hi = np.searchsorted(column, [c, c + width])
                dense = np.zeros((len(members), width), np.float32)
                dense[row[lo:hi], column[lo:hi] - c] = 1
                gram += dense @ dense.T
            out[at] = gram[np.searchsorted(members, i[at]), np.searchsorted(members, j[at])].astype(
                np.int64)
        return out


# -- the join -----------------------------------------------------------------------------

def _shingled(rows: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the rows that have a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in _slices([len(t or "") for t in texts]):
                h, at = shingles(texts[lo:hi])
                has = np.flatnonzero(np.diff(at))
                if len(has):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_node_keys(h, at[has]), pa.binary()),
                         pa.array([h[at[k]:at[k + 1]].tobytes() for k in has], pa.binary())],
                        names=["node", "shingles"])

    return rows.select("text").mapInArrow(run, "node binary, shingles binary")


def _grouped(df: DataFrame) -> DataFrame:
    keys = ["path", "lo", "hi"]
    return df.repartition(partitions(df), *keys).sortWithinPartitions(*keys)


def _true_links(nodes: DataFrame) -> int:
    """Links of the audited nodes by their shingle sets, without those to themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(batch.column(0).flatten()) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    all_ = nodes.filter("near IS NOT NULL").select("near").mapInArrow(run, "n long").agg(
        F.sum("n")).first()[0] or 0
    return all_ - nodes.filter("asked").count()


def node_links(docs: DataFrame, nodes: DataFrame, target: float = TARGET) -> DataFrame:
    """``(node, n, root, ...)``: link counts and edges of all nodes, in several rows each."""
    runs = RUNS
    truth = _true_links(nodes)
    asked = nodes.filter("asked").select("node")
    while True:
        leaves = written(buckets(nodes, runs), "path-leaves")
        of_node = leaves.groupBy("node").agg(F.array_sort(F.collect_set("path")).alias("leaves"))
        known = nodes.select("node", "sketch", "copies", "rep").join(of_node, "node")
        rows = _grouped(_dealt(leaves).join(known.drop("rep"), "node").select(
            "path", "lo", "hi", "block", "node", "sketch", "leaves", "copies"))
        proposed = written(rows.mapInArrow(
            _propose, f"{_GROUP}, block int, node binary, leaves array<long>, copies long"),
            "path-proposed")
        wanted = written(known.select("node", "rep").join(
            proposed.select("node").distinct(), "node", "left_semi").select(
            F.col("rep").alias("rk")), "path-wanted")
        sets = _shingled(_keyed(docs).join(wanted, "rk", "left_semi")).dropDuplicates(["node"])
        found = written(_grouped(proposed.join(sets, "node").select(
            "path", "lo", "hi", "block", "node", "leaves", "copies", "shingles")).mapInArrow(
            _decide, "node binary, n long, root binary, links long, once long, twice long, degree long"),
            "path-links")
        total, once, twice = (x or 0 for x in found.agg(
            F.sum("links"), F.sum("once"), F.sum("twice")).first())
        missed = once * once / (2 * twice) if twice else once * (once - 1) / 2
        got = found.join(asked, "node", "left_semi").agg(F.sum("degree")).first()[0] or 0
        if total >= target * (total + missed) and got >= target * truth:
            return found
        if runs >= MOST:
            raise RuntimeError(f"recall below {target} at {runs} runs: {total} links found, about "
                               f"{missed:.0f} missed; {got} of {truth} links of the audited nodes")
        runs *= 2


def _classes(docs: DataFrame) -> DataFrame:
    """``doc_id, rk, node, root, least, first, n_links`` of every row."""
    rows = written(sketched(docs, asked_nodes(docs)), "path-sketches")
    nodes = written(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("sketch").alias("sketch"), F.first("asked").alias("asked"),
        F.first("near").alias("near"), F.count("*").alias("copies"),
        F.min("doc_id").alias("least"), F.min("rk").alias("rep")), "path-nodes")
    found = node_links(docs, nodes)
    roots = components(found.filter("node <> root").select(F.col("node").alias("a"),
                                                           F.col("root").alias("b")))
    counted = found.groupBy("node").agg(F.sum("n").alias("links"))
    full = written(nodes.select("node", "copies", "least").join(roots, "node", "left").join(
        counted, "node", "left").withColumn("root", F.coalesce("root", "node")), "path-rooted")
    least = full.groupBy("root").agg(F.min("least").alias("class_id"))
    known = written(full.join(least, "root").select(
        "node", "root", "class_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "path-classes")
    return rows.select("doc_id", "rk", "node").join(known, "node", "left")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links`` (other documents linked directly)."""
    alone = F.col("node").isNull()
    return _classes(docs).select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that share a class with a row of smaller id.

    Rows without words all stay. Of rows that are equal in id and text one stays.
    """
    rows = _classes(docs).filter("node IS NOT NULL")
    best = rows.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("rk"))).alias("best"))
    judged = written(rows.select("rk", "root").join(best, "root").select(
        "rk", (F.col("rk") == F.col("best.rk")).alias("stays")), "path-judged")
    gone = written(judged.filter("NOT stays").select("rk").distinct(), "path-gone")
    again = judged.filter("stays").groupBy("rk").count().filter("count > 1").take(1)
    names = docs.columns
    key = {n: names.index(n) if n in names else [c.lower() for c in names].index(n)
           for n in ("doc_id", "text")}
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kept = flat.withColumn("rk", row_key(F.col(f"c{key['doc_id']}"), F.col(f"c{key['text']}"))).join(
        gone, "rk", "left_anti")
    if again:
        wordless = ~F.coalesce(F.col(f"c{key['text']}"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        kept = kept.filter(wordless).unionByName(kept.filter(~wordless).dropDuplicates(["rk"]))
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
