"""Mixing sources to target weights.

Each document gets a hash-random key (md5 of its id). Documents are range-sorted by
(source, key), a distributed prefix sum of their word counts runs along each source,
and a source is cut exactly where its budget is used up. A budget above the source's
size takes whole epochs first and cuts the last one.

Budgets: sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ... and share
all words by weight. No target is above ``max_epochs`` times its source's size; what a
capped source leaves is shared again by weight among the others.

Edge cases: a null text has size 0; null is a source of its own; a null id is an id like
any other; equal rows take neighbouring places; an empty table gives an empty result;
other columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, pick, with_rank, with_running_total, written

KEY_SEED = "mix-1:"


def random_key(doc_id: Column, seed: str = KEY_SEED) -> Column:
    """60 bits of the md5 of the id: the same in every run and on every platform."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
                   .cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text", "source").select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        random_key(F.col("doc_id")).alias("key"))


def budgets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``(source, source_size)`` rows -> adds ``start`` (words of all earlier sources),
    ``target`` (double), ``epochs`` and ``rest`` (whole passes, and words of the last).

    The share per unit of weight rises until no source is above its cap; each step is
    one sum over the sources, so only three numbers reach the driver.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = written(with_running_total(with_rank(sizes, order, "place"), order, "source_size",
                                        "start"), "mix-sources")
    weight = (F.col("place") % 3 + 1).cast("decimal(18,0)")
    size = F.col("source_size").cast("decimal(18,0)")
    cap = size * F.lit(max_epochs)
    first = ranked.agg(F.sum(size), F.sum(weight), F.count("*")).first()
    total, open_weight, closed = int(first[0] or 0), int(first[1] or 1), 0

    def dec(x: int) -> Column:
        return F.lit(str(x)).cast("decimal(19,0)")

    for _ in range(first[2] + 1):
        full = weight * dec(total - closed) > cap * dec(open_weight)
        got = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, weight))).first()
        now = (int(got[0] or 0), int(got[1] or open_weight))
        if now == (closed, open_weight):
            break
        closed, open_weight = now
    full = weight * dec(total - closed) > cap * dec(open_weight)
    share = weight * dec(total - closed)
    target = F.when(full, cap.cast("double")).otherwise(share.cast("double") / float(open_weight))
    words = F.when(full, cap).otherwise(F.floor(share / dec(open_weight))).cast("long")
    at_least_one = F.greatest(F.col("source_size"), F.lit(1))
    return (ranked.withColumn("target", target).withColumn("__words", words)
            .withColumn("epochs", F.expr("__words div greatest(source_size, 1)"))
            .withColumn("rest", F.col("__words") % at_least_one)
            .drop("__words", "place"))


def _placed(docs: DataFrame, max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the words ``before`` them in their source; the sources' budgets."""
    sized = written(_sized(docs), "mix-sizes")
    sources = written(budgets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                              max_epochs), "mix-budgets")
    order = [F.col("source").asc_nulls_last(), *[F.col(c).asc_nulls_first()
                                                 for c in ("key", "doc_id", "size")]]
    placed = with_running_total(sized, order, "size")
    joined = placed.join(sources.withColumnRenamed("source", "__s"),
                         F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    return joined.withColumn("before", F.col("before") - F.col("start")).drop("start"), sources


def mix(docs: DataFrame, max_epochs: int = 3) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``.

    ``taken`` counts the words that the mix takes of the document, repeats counted. A
    source's ``taken`` add up to its target without the fraction.
    """
    placed, _ = _placed(docs, max_epochs)
    last = F.least(F.col("size"), F.greatest(F.col("rest") - F.col("before"), F.lit(0)))
    taken = F.col("size") * F.col("epochs") + last
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, max_epochs: int = 3) -> DataFrame:
    """The mix itself: whole rows of ``docs``, each as often as it is taken.

    The document at a source's cut is taken whole if at least half of it lies within
    the budget. The texts are not shuffled: the prefix sums only yield each source's
    cut, a place in its key order, and a document compares its own key with it. Rows
    that are equal in id and size at the cut are all treated alike.
    """
    placed, sources = _placed(docs, max_epochs)
    inside = F.col("rest") > F.col("before")
    over = F.col("rest") <= F.col("before") + F.col("size")
    cuts = placed.filter(inside & over).groupBy("source").agg(F.min(F.struct(
        F.col("key").alias("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.col("size").alias("size"),
        (2 * (F.col("rest") - F.col("before")) >= F.col("size")).alias("whole"))).alias("__cut"))
    plan = written(sources.select(F.col("source").alias("__s"), F.col("epochs").alias("__e")).join(
        cuts.withColumnRenamed("source", "__c"), F.col("__s").eqNullSafe(F.col("__c")),
        "left").drop("__c"), "mix-cuts")
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{[c.lower() for c in names].index(n) if n not in names else names.index(n)}"
          for n in ("doc_id", "text", "source")}
    key = random_key(F.col(at["doc_id"]))
    size = F.regexp_count(F.coalesce(F.col(at["text"]), F.lit("")), F.lit(WORD)).cast("long")
    mine = F.struct(key.alias("key"),
                    F.coalesce(F.col(at["doc_id"]).cast("string"), F.lit("")).alias("id"),
                    size.alias("size"))
    cut = F.struct(F.col("__cut.key").alias("key"), F.col("__cut.id").alias("id"),
                   F.col("__cut.size").alias("size"))
    extra = F.when(F.col("__cut").isNull() | (size == 0), 0).when(mine < cut, 1).when(
        (mine == cut) & F.col("__cut.whole"), 1).otherwise(0)
    copies = F.when(size == 0, 0).otherwise(F.col("__e") + extra).cast("int")
    joined = flat.join(plan, F.col(at["source"]).cast("string").eqNullSafe(F.col("__s")))
    repeated = joined.withColumn("__n", F.explode(F.array_repeat(F.lit(1), copies)))
    return repeated.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
