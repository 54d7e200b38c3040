"""Prefix trie of conversations, its subtree totals by time-forward processing.

Every distinct sequence of first ``d`` turns is a node of depth ``d``. A prefix is named by
two 64-bit sums (exclusive or) of hashes of (depth, role and text), so equal prefixes of all
conversations meet in one aggregation that is combined map-side: thousands of copies of a
conversation cost one row per node and task. No text is shuffled, only its digest.

Totals go from nodes to parents in time-forward order: nodes are sorted by reverse level
(Spark's external sort), and what a node has to tell its parent waits in a priority queue
whose key is the parent's place in that order. The queue spills sorted runs beyond a fixed
length. This runs twice:

* within shards. A node is light if its subtree holds at most ``1 / (4 * partitions)`` of
  all turns; the uppermost light nodes are the shard roots. A shard is bounded by its turns,
  so a first turn that a third of all conversations share is cut into many shards;
* across shard roots. Their totals are added per parent, and the nodes that are not light,
  at most ``4 * partitions`` on a level whatever the data's size, take them in the same way,
  in one task.

Edge cases: turns are ordered by ``turn``, null first; turns of equal number by the digest of
role and text. A null role or text is the empty string. Rows without ``conv_id`` belong to no
conversation and are left out. Repeated rows are turns of their own. An empty table has no
nodes, not even a root. Other columns are ignored. Texts are only hashed and measured. A
conversation of any length is ranked and summed in blocks, not in one task; only if its turns
are more than a shard holds do they meet, a number per turn, in the last step's one task.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import partitions, pick, with_rank, written

SHARDS_PER_PARTITION = 4
BLOCK_TURNS = 256                 # turns of a conversation that are summed in one window
QUEUE_LIMIT = 200_000             # messages that a queue holds in memory
CHUNK_CHARS = 1 << 16             # of the id lists that are hashed
NODE = ("depth", "x1", "x2")


class SpillingQueue:
    """A priority queue of ``(key, ...)`` tuples that holds at most ``limit`` in memory.

    The rest are sorted runs in unlinked files where Spark's own sorts of this executor
    spill; no other process reads them, and they are gone with the task.
    """

    def __init__(self, limit: int = QUEUE_LIMIT):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        for item in sorted(self.heap):
            pickle.dump(item, file, protocol=pickle.HIGHEST_PROTOCOL)
        file.flush()
        file.seek(0)
        self.heap, self.spills = [], self.spills + 1
        heapq.heappush(self.runs, (pickle.load(file), self.spills, file))

    def pop_until(self, key: tuple):
        """All items of a key up to ``key``, in order."""
        while True:
            ours = bool(self.heap) and not (self.runs and self.runs[0][0] < self.heap[0])
            head = self.heap[0] if ours else self.runs[0][0] if self.runs else None
            if head is None or head[0] > key:
                return
            if ours:
                yield heapq.heappop(self.heap)
                continue
            _, n, file = self.runs[0]
            try:
                heapq.heapreplace(self.runs, (pickle.load(file), n, file))
            except EOFError:
                heapq.heappop(self.runs)
                file.close()
            yield head


def _time_forward(limit: int):
    """Adds up ``n_children, n_leaves, saved`` of nodes that come by falling depth."""
    def run(batches):
        import pyarrow as pa

        queue = SpillingQueue(limit)
        for batch in batches:
            col = {f.name: batch.column(i).to_pylist() for i, f in enumerate(batch.schema)}
            totals = []
            for depth, x1, x2, p1, p2, top, own, children, leaves, saved in zip(*(col[c] for c in (
                    "depth", "x1", "x2", "p1", "p2", "top", "own", "n_children", "n_leaves", "saved"))):
                for _, more_leaves, more_saved in queue.pop_until((-depth, x1, x2)):
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves, saved = leaves if children else 1, saved + own
                totals.append((children, leaves, saved))
                if not top:
                    queue.push(((1 - depth, p1, p2), leaves, saved))
            names = list(batch.schema.names)
            columns = list(batch.columns)
            for name, values in zip(("n_children", "n_leaves", "saved"), zip(*totals)):
                columns[names.index(name)] = pa.array(values, pa.int64())
            if totals:
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if next(queue.pop_until((1,)), None):
            raise RuntimeError("a subtree total found no parent")
    return run


def _chunks(limit: int):
    """Sorted ``(node, conv_id)`` rows -> ``(node, first id, ids joined by commas)``."""
    def run(batches):
        import pyarrow as pa

        def made(rows):
            kinds = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                              names=[*NODE, "conv_id", "ids"])

        node, ids, size, rows = None, [], 0, []
        for batch in batches:
            for *key, c in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if ids and (key != node or size >= limit):
                    rows.append((*node, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                    if len(rows) >= 1000:
                        yield made(rows)
                        rows = []
                node = key
                ids.append(c)
                size += 20
        if ids:
            rows.append((*node, ids[0], ",".join(map(str, ids))))
        if rows:
            yield made(rows)
    return run


def _digests(batches):
    """Sorted chunks -> ``(node, SHA-256 of all its chunks joined by commas)``."""
    import pyarrow as pa

    node, digest, rows = None, None, []

    def made(rows):
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == node:
                digest.update(b"," + ids.encode())
                continue
            if node:
                rows.append((*node, digest.hexdigest()))
            node, digest = key, hashlib.sha256(ids.encode())
        if len(rows) >= 1000:
            yield made(rows)
            rows = []
    if node:
        rows.append((*node, digest.hexdigest()))
    if rows:
        yield made(rows)


def keyed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, n_bytes``: each turn's place (from 1), the digest of its role
    and text, and the text's UTF-8 bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
                      .cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    ranked = with_rank(turns, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")])
    begin = ranked.groupBy("conv_id").agg(F.min("rank").alias("begin"))
    return ranked.join(begin, "conv_id").select(
        "conv_id", (F.col("rank") - F.col("begin") + 1).alias("pos"), "digest", "n_bytes")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Adds the names of every turn's prefix (``x1, x2``) and of the prefix before (``p1, p2``)."""
    lanes = {"1": F.xxhash64("depth", "digest"), "2": F.xxhash64(F.lit("lane"), "digest", "depth")}
    rows = turns.withColumns({f"h{i}": h for i, h in lanes.items()}).withColumn(
        "block", F.floor((F.col("depth") - 1) / BLOCK_TURNS))
    so_far = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    inside = rows.withColumns({f"x{i}": F.bit_xor(f"h{i}").over(so_far) for i in lanes})
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.bit_xor(f"h{i}").alias(f"b{i}") for i in lanes])
    offsets = blocks.select("conv_id", "block", *[F.bit_xor(f"b{i}").over(earlier).alias(f"o{i}")
                                                  for i in lanes]).where("block > 0")
    both = inside.join(offsets, ["conv_id", "block"], "left")

    def name(i: str) -> Column:
        return F.col(f"x{i}").bitwiseXOR(F.coalesce(F.col(f"o{i}"), F.lit(0).cast("long")))

    return both.select("conv_id", "depth", "n_bytes", "length", name("1").alias("x1"),
                       name("2").alias("x2"), name("1").bitwiseXOR(F.col("h1")).alias("p1"),
                       name("2").bitwiseXOR(F.col("h2")).alias("p2"))


def _solved(nodes: DataFrame, limit: int) -> DataFrame:
    schema = ", ".join(f"{n} {t}" for n, t in nodes.dtypes)
    return nodes.mapInArrow(_time_forward(limit), schema)


def trie(turns: DataFrame, members: DataFrame, queue_limit: int = QUEUE_LIMIT,
         shards_per_partition: int = SHARDS_PER_PARTITION) -> DataFrame:
    """The nodes of all conversations, one row each.

    ``turns`` has ``conv_id, depth`` (from 1 without gaps)``, digest, n_bytes``; ``members``
    has ``conv_id`` and ``length``, its number of turns, of every conversation, 0 included.
    A node is named by ``conv_id``, its smallest member, and ``depth``. ``parent_conv_id`` is
    null for the root, ``saved_tokens`` adds ``(n_convs - 1) * bytes of the last text`` over
    the subtree, ``ends_sha256`` is that of the sorted ids of members that end here.
    """
    n = partitions(turns)
    prefixes = written(_prefixes(turns.join(members, "conv_id")), "trie-prefixes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("x1", "x2")]
    names = [F.col("depth").cast("long").alias("depth"), "x1", "x2"]
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                       F.sum("length").alias("weight")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *zero, F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), "conv_id", "n_convs", F.lit(0).cast("long").alias("own"),
        "weight")
    nodes = written(prefixes.groupBy(*names).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.min("n_bytes").alias("own"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("own")).unionByName(root), "trie-nodes")
    total = nodes.where("depth = 0").select("weight").first()
    bound = -(-(total[0] if total else 0) // (shards_per_partition * n))
    light = nodes.where((F.col("depth") > 0) & (F.col("weight") <= bound))
    heavy = nodes.where((F.col("depth") == 0) | (F.col("weight") > bound))
    empty = {c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved")}

    # the shard root on the path of each conversation: its first prefix that is light
    above = heavy.where("depth > 0").select(*NODE, F.lit(True).alias("heavy"))
    roots = prefixes.join(above, list(NODE), "left").groupBy("conv_id").agg(
        F.min(F.when(F.col("heavy").isNull(), F.struct(*names))).alias("shard"))
    sharded = light.join(roots, "conv_id").withColumn(
        "top", F.struct(*NODE) == F.col("shard")).withColumns(empty)
    order = [F.col("depth").desc(), F.col("x1"), F.col("x2")]
    low = written(_solved(sharded.repartition(n, "shard").drop("shard", "weight")
                          .sortWithinPartitions(*order), queue_limit), "trie-shards")

    told = low.where("top").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"),
                                    F.col("p2").alias("x2")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    upper = heavy.drop("weight").withColumn("top", F.col("depth") == 0).join(
        told, list(NODE), "left").withColumns({c: F.coalesce(F.col(c), zero) for c, zero in empty.items()})
    high = _solved(upper.select(*low.columns).repartition(1).sortWithinPartitions(*order), queue_limit)
    solved = written(low.unionByName(high), "trie-solved")

    ends = prefixes.where("depth = length").select(*names, "conv_id").unionByName(
        members.where("length = 0").select(F.lit(0).cast("long").alias("depth"), *zero, "conv_id"))
    by = [*NODE, "conv_id"]
    chunks = ends.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(
        _chunks(CHUNK_CHARS), "depth long, x1 long, x2 long, conv_id long, ids string")
    digests = chunks.repartition(n, *NODE).sortWithinPartitions(*by).mapInArrow(
        _digests, "depth long, x1 long, x2 long, ends_sha256 string")

    parents = solved.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"),
                            F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return solved.join(parents, ["depth", "p1", "p2"], "left").join(digests, list(NODE), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (``conv_id, turn, role, text``), see ``trie``."""
    turns = written(keyed_turns(conversations).withColumnRenamed("pos", "depth"), "trie-turns")
    members = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    return trie(turns, written(members, "trie-members"))


# executors get this module's functions with the job and need not have it installed
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["x"]))
