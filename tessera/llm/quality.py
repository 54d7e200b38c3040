"""Quality rules by hashed n-gram likelihood ratio [DataFrame functions only].

A text is read as runs of letters and digits and runs of other signs; unigrams and
bigrams of these tokens are hashed into ``BUCKETS`` buckets. Two multinomials are
counted over whole tables: the trusted target (documents labelled good) and the raw
corpus (all documents). The target is smoothed by mixing ``RAW_SHARE`` of the raw
distribution into it, which means the same at every corpus size. A document's score is
the mean over its n-grams of log(p_target / p_raw); it is kept when the score is at
least ``THRESHOLD``. The rule is deterministic and is applied to every document.

The raw counts cover all documents. The trusted ones are at most ``MAX_TRUSTED``
labelled documents (beyond that, those with the smallest hashes of their ids), which
bounds what is broadcast.

Before that, base rules reject texts of under 50 words and texts of which more than
half lies in repeated three-word windows.

Edge cases: a null text counts as empty and fails the base rules; without any trusted
row the target equals the raw corpus and only the base rules reject; labels of null or
of unknown ids are ignored; a document counts once however many label rows it has, as
trusted if one says so; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, pick, words

BUCKETS = 1 << 14
TOKEN = r"[\p{L}\p{N}]++|[^\p{L}\p{N}\s]++"
RAW_SHARE = 0.75        # of the raw distribution in the smoothed target
THRESHOLD = -0.03       # nats per n-gram below the raw corpus' own likelihood
MIN_WORDS = 50
MAX_TRUSTED = 100_000   # documents that the target is counted on


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _bucket(*x: Column) -> Column:
    return F.xxhash64(*x).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def ngram_buckets(w: Column) -> Column:
    """Buckets of all unigrams and bigrams of an array of tokens."""
    ones = F.transform(w, lambda x: _bucket(x))
    twos = F.when(F.size(w) >= 2, F.transform(
        F.sequence(F.lit(0), F.size(w) - 2),
        lambda i: _bucket(F.get(w, i), F.get(w, i + 1)))).otherwise(F.array().cast("array<int>"))
    return F.concat(ones, twos)


FEW = 16                # repeated windows of a text that are looked up one by one


def repeated_words(w: Column) -> Column:
    """Number of words that lie in a three-word window which the text holds twice or more."""
    def by_lookup(h: Column, again: Column) -> Column:
        return F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i)))

    def by_sorting(h: Column) -> Column:
        # equal windows stand side by side once sorted by hash
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(order, lambda o: F.sort_array(F.transform(
            F.filter(o, lambda s, i: (s["x"] == F.get(o, i - 1)["x"]) | (s["x"] == F.get(o, i + 1)["x"])),
            lambda s: s["i"])))

    def covered(places: Column) -> Column:
        # a window covers its three words, as far as the next one does not
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(
            F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda s, x: s + x))

    def spread(h: Column) -> Column:
        again = let(F.sort_array(h), lambda o: F.array_distinct(
            F.filter(o, lambda x, i: x == F.get(o, i + 1))))
        return let(again, lambda a: covered(
            F.when(F.size(a) <= FEW, by_lookup(h, a)).otherwise(by_sorting(h))))

    def exact(n: Column) -> Column:
        hashes = F.transform(F.slice(w, F.lit(3), n), lambda x, i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), x))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0)
                   .otherwise(spread(h)))

    return F.when(F.size(w) < 4, 0).otherwise(exact(F.size(w)))


def _base(text: Column, w: Column) -> dict[str, Column]:
    """The base figures of a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(w).cast("long"),
    }


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """Ids labelled good, about ``most`` of them at most, chosen by the hash of the id."""
    good = pick(labels, "doc_id", "quality").filter("quality = 1 AND doc_id IS NOT NULL").select(
        "doc_id").distinct()
    n = good.count()
    steps = 1 << 30
    share = steps if n <= most else steps * most // n
    return good.filter(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(steps)) < share)


def target_weights(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log(p_target / p_raw) of every bucket; ``BUCKETS`` rows reach the driver.

    The corpus is read once. Counts are combined map-side, so a task ships at most one
    row per bucket.
    """
    good = F.broadcast(trusted_ids(labels).select("doc_id", F.lit(1).alias("good")))
    rows = pick(docs, "doc_id", "text").join(good, "doc_id", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = rows.select("good", F.explode(let(tokens(text), ngram_buckets)).alias("b")).groupBy(
        "b").agg(F.count("*").alias("raw"), F.count("good").alias("good")).collect()
    n_raw, n_good = sum(r.raw for r in counted), sum(r.good for r in counted)
    out = [0.0] * BUCKETS
    if n_good:
        for r in counted:
            ratio = (r.good / n_good) / (r.raw / n_raw)
            out[r.b] = math.log(RAW_SHARE + (1 - RAW_SHARE) * ratio)
    return out


def _score(w: Column, weights: list[float]) -> Column:
    table = F.array(*[F.lit(x) for x in weights])
    total = F.aggregate(ngram_buckets(w), F.lit(0.0), lambda s, b: s + F.get(table, b))
    return total / F.greatest(F.lit(1), 2 * F.size(w) - 1)


def _verdict(text: Column, weights: list[float]) -> Column:
    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: F.struct(
        *[c.alias(n) for n, c in _base(t, w).items()],
        let(tokens(t), lambda k: _score(k, weights)).alias("score"))))


def _base_failed(v: Column) -> Column:
    return (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > 50 * v["n_words"])


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    weights = target_weights(docs, labels)
    names = docs.columns
    at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    ok = let(_verdict(F.col(f"c{at}"), weights),
             lambda v: ~_base_failed(v) & (v["score"] >= threshold))
    return flat.filter(ok).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, the base figures, ``base_failed``, ``score``, ``kept``."""
    weights = target_weights(docs, labels)
    rows = pick(docs, "doc_id", "text")
    out = rows.select("doc_id", _verdict(F.col("text"), weights).alias("v"))
    out = out.select("doc_id", "v.*", _base_failed(F.col("v")).alias("base_failed"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
