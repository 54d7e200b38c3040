"""Helpers shared by the corpus operators: column picking, lineage cuts, distributed
ranks and running totals, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import scratch_path, shared_root

# A word is a maximal run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, whatever else the table holds.

    Columns are found by position: the exact name first, else the only one that
    differs in case. So an extra column ``TEXT`` beside ``text`` is no ambiguity.
    """
    at = []
    for name in names:
        hits = [i for i, c in enumerate(df.columns) if c == name] or [
            i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
        if not hits:
            raise ValueError(f"column {name!r} is missing; there are {df.columns}")
        at.append(hits[0])
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names)])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared ``spark.checkpoint.dir`` and go on from there."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Like ``cut`` as a Parquet table, whose size Spark knows when it plans a join."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Exact 0-based rank of every row under a total order, without a global window.

    One range shuffle on the order; the position inside a range partition comes
    from ``monotonically_increasing_id`` and the partition's offset from the row
    counts of the partitions before it (one row per partition, so the broadcast
    is bounded by the number of shuffle partitions).
    """
    n = partitions(df)
    placed = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__pid", F.shiftrightunsigned("__at", 33))
    sizes = placed.groupBy("__pid").agg(F.count("*").alias("__n"))
    before = W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (placed.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__pid", "__at", "__off"))


def with_running_total(df: DataFrame, order: list[Column], value: str,
                       name: str = "before") -> DataFrame:
    """Sum of ``value`` over all rows that stand before a row under a total order.

    Range partitions are summed first (one row each); inside a partition a window
    over that partition alone adds up the rest.
    """
    n = partitions(df)
    placed = cut(df.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id()))
    sizes = placed.groupBy("__pid").agg(F.sum(value).alias("__n"))
    earlier = W.orderBy("__pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    within = W.partitionBy("__pid").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (placed.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop("__pid", "__off"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph given as ``(a, b)`` rows.

    Returns ``(node, root)`` for every node of an edge; the root is the smallest
    node of its component. Alternates the large-star and small-star steps until
    the edge set is a set of stars around the roots. Every step is a ``min`` per
    node followed by a join, so a node with very many neighbours is combined
    map-side and its join is one that AQE can split. Each step is checkpointed and
    reads its edges twice, so plans, which the driver holds, do not grow from step to
    step.
    """
    def linked(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                         F.least("a", "b").alias("b")).distinct()

    def with_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        return pairs.join(least, "u")

    def two(e: DataFrame, first: dict[str, Column], second: dict[str, Column]) -> DataFrame:
        # both rows out of one, where a union would hold the plan of e twice
        rows = F.array(*[F.struct(*[c.alias(n) for n, c in x.items()]) for x in (first, second)])
        return e.select(F.explode(rows).alias("row")).select("row.*")

    a, b, u, v, m = (F.col(c) for c in "abuvm")
    now, loose = cut(linked(edges)), -1
    for _ in range(max_rounds):
        both = two(now, {"u": a, "v": b}, {"u": b, "v": a})
        large = cut(linked(with_least(both).filter("v > u").select(v.alias("a"), m.alias("b"))))
        stars = with_least(large.select(a.alias("u"), b.alias("v")))
        now = cut(linked(two(stars, {"a": v, "b": m}, {"a": u, "b": m})))
        # a star forest has one edge per non-root node and no root that is itself a leaf
        ends = two(now, {"n": a, "leaf": F.lit(1), "root": F.lit(0)},
                   {"n": b, "leaf": F.lit(0), "root": F.lit(1)})
        loose = ends.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).filter(
            "leaf + root > 1").count()
        if not loose:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds: {loose} nodes are left")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
