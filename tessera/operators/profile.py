"""Gender / age profile inference: the ordered fold and the jobs around it.

Per user, today's usage sums (one row per app) are joined to the tag library,
sorted by app id *as a string*, and folded into the starting profile (the stored
one, else the prior):

    d = sum(state) + sum(tag) * t ;   if d != 0:  state_i = (state_i + tag_i * t) / d

Gender (2 values) and age (5 brackets) are folded independently. The fold is
order dependent -- every step renormalises -- so it is never replaced by a sum.

Two exact implementations, bit-identical:

* array fold (default): Spark's ``aggregate`` higher-order function over the
  user's steps ordered by ``sort_array``, inside the JVM. The array holds at
  most one entry per tagged app of the user (it is built after the
  per-(user, app) aggregate), so its length is bounded by the size-checked tag
  library whatever the user's share of the log.
* sorted fold (``fold_sorted``): secondary sort -- hash-partition by mdn, sort
  within partitions, fold each partition in order -- for when no such bound is
  proven; no group is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators import sorted_fold
from tessera.operators.ranking import ranked
from tessera.operators.tags import TAG_VALUES

GENDER = ("male", "female")
AGES = ("age1", "age2", "age3", "age4", "age5")
PROFILE_VALUES = GENDER + AGES
PROFILE_COLUMNS = ("mdn",) + PROFILE_VALUES

# --- fixed values: the prior of a user without a stored profile ------------------
PRIOR = {"male": 0.5, "female": 0.5, "age1": 0.2, "age2": 0.2, "age3": 0.2, "age4": 0.2,
         "age5": 0.2}
# ---------------------------------------------------------------------------------

SOURCE_STORE, SOURCE_LOG = "store", "log"


def _left_sum(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def step_struct(times: Column, tag: dict[str, Column], app_id: Column | None = None) -> Column:
    """One fold step with its state-independent products computed up front.

    ``w_<n> = tag_n * t`` and ``s_gender`` / ``s_age`` = (sum of the group's tag
    values) * t are exactly the sub-expressions of the update that do not depend
    on the state, evaluated in the same order, so the fold's results are
    bit-identical while the per-step work inside the (interpreted) lambda shrinks.
    ``app_id`` leads the struct so ``sort_array`` orders steps by it.
    """
    t = times
    fields = [] if app_id is None else [app_id.alias("app_id")]
    fields += [(_left_sum([tag[n] for n in GENDER]) * t).alias("s_gender"),
               (_left_sum([tag[n] for n in AGES]) * t).alias("s_age")]
    fields += [(tag[n] * t).alias("w_" + n) for n in PROFILE_VALUES]
    return F.struct(*fields)


def _renormalise(acc: Column, x: Column, names: tuple[str, ...], s: str) -> list[Column]:
    d = _left_sum([acc[n] for n in names]) + x[s]
    return [F.when(d != F.lit(0.0), (acc[n] + x["w_" + n]) / d).otherwise(acc[n]).alias(n)
            for n in names]


def fold_step(acc: Column, x: Column) -> Column:
    """Apply one step to the state struct: for each group,
    ``d = sum(state) + sum(tag) * t``; if ``d != 0``: ``state_i = (state_i + tag_i * t) / d``."""
    return F.struct(*_renormalise(acc, x, GENDER, "s_gender"), *_renormalise(acc, x, AGES, "s_age"))


def prior_state() -> Column:
    return F.struct(*[F.lit(PRIOR[n]).cast("double").alias(n) for n in PROFILE_VALUES])


def fold_profile(start: Column, steps: Column) -> Column:
    """Fold an array of step structs, sorted by ``app_id`` string, into ``start``."""
    return F.aggregate(F.sort_array(steps), start, fold_step)


def collect_steps(tagged_sums: DataFrame) -> DataFrame:
    """``DF[mdn, app_id, times, tag values (NULL on miss)]`` -> ``DF[mdn, steps]``.

    Untagged apps contribute no step but keep the user (``collect_list`` skips
    the NULLs, leaving an empty array)."""
    step = F.when(F.col("male").isNotNull(),
                  step_struct(F.col("times"), {n: F.col(n) for n in TAG_VALUES}, F.col("app_id")))
    return tagged_sums.groupBy("mdn").agg(F.collect_list(step).alias("steps"))


def build_profiles(tagged_sums: DataFrame) -> DataFrame:
    """Profiles of today's users from the prior (no stored profiles)."""
    per_user = collect_steps(tagged_sums)
    return per_user.select("mdn", fold_profile(prior_state(), F.col("steps")).alias("p")).select(
        "mdn", *[F.col("p." + n).alias(n) for n in PROFILE_VALUES])


def merge_profiles(store: DataFrame, tagged_sums: DataFrame) -> DataFrame:
    """Fold today's usage into the stored profiles (full outer join on mdn).

    Output users = store union logs: stored users without logs come out
    unchanged, new users start from the prior. Stored rows with an empty mdn are
    dropped. A NULL component in a stored profile fails the job (``raise_error``),
    rather than shifting columns as a positional reader would.
    """
    st = store.where(F.length("mdn") > 0).select("mdn", F.struct(*[
        F.coalesce(F.col(n), F.raise_error(F.lit(f"NULL {n} in a stored profile"))).alias(n)
        for n in PROFILE_VALUES]).alias("stored"))
    per_user = collect_steps(tagged_sums)
    j = st.join(per_user, "mdn", "full_outer")
    start = F.when(F.col("stored").isNotNull(), F.col("stored")).otherwise(prior_state())
    steps = F.coalesce(F.col("steps"), F.array().cast(per_user.schema["steps"].dataType))
    return j.select("mdn", fold_profile(start, steps).alias("p")).select(
        "mdn", *[F.col("p." + n).alias(n) for n in PROFILE_VALUES])


# --- the reference's intermediate representations, for inspection jobs -----------

def tagged_union(store: DataFrame, usage_sums: DataFrame) -> DataFrame:
    """Stored profiles and usage sums as one typed relation with a ``source``
    column and real NULLs where the other side has no value."""
    st = store.where(F.length("mdn") > 0).select(
        "mdn", *PROFILE_VALUES, F.lit(None).cast("string").alias("app_id"),
        F.lit(None).cast("bigint").alias("times"), F.lit(SOURCE_STORE).alias("source"))
    lg = usage_sums.where(F.length("mdn") > 0).select(
        "mdn", *[F.lit(None).cast("double").alias(n) for n in PROFILE_VALUES], "app_id",
        F.col("times").cast("bigint").alias("times"), F.lit(SOURCE_LOG).alias("source"))
    return st.unionByName(lg)


def source_rank() -> Column:
    return F.when(F.col("source") == SOURCE_STORE, F.lit(0)).otherwise(F.lit(1))


def update_sequence(tagged: DataFrame) -> DataFrame:
    """Position of every record in its user's update sequence: the stored row
    first, then the apps by id as a string. Partitioned by mdn; each partition
    holds at most one row per app plus the stored row."""
    w = Window.partitionBy("mdn").orderBy(source_rank(), F.col("app_id"))
    return tagged.select("mdn", "source", "app_id", "times",
                         F.row_number().over(w).cast("bigint").alias("seq"))


def secondary_sort(tagged: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by mdn and sort inside partitions by (mdn, source, app):
    every user's records are contiguous and in update order, with no global sort."""
    df = tagged.repartition(num_partitions, "mdn") if num_partitions else tagged.repartition("mdn")
    return df.sortWithinPartitions("mdn", source_rank(), "app_id")


def merged_sorted(tagged: DataFrame) -> DataFrame:
    """Global order by (mdn, source, app): range-partitioned sort."""
    return tagged.orderBy("mdn", source_rank(), "app_id")


def merged_ranked(tagged: DataFrame) -> DataFrame:
    """``merged_sorted`` with each row's place in the global order, which proves it."""
    by = tagged.withColumn("_source_rank", source_rank())
    return ranked(by, [F.col("mdn"), F.col("_source_rank"), F.col("app_id")]).drop("_source_rank")


# --- streaming fold: the exact path for groups with no proven size bound ---------

_OUT_SCHEMA = "mdn string, " + ", ".join(f"{n} double" for n in PROFILE_VALUES)


def fold_sorted(events: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Profiles from an event relation ``(mdn, rank, app_id, times, 7 values)``
    by secondary sort: hash-partition by mdn, sort inside partitions by
    (mdn, rank, app_id) -- Spark's external sort, spilling as needed -- and fold
    each partition in order. No group is materialised anywhere."""
    n = num_partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = events.repartition(n, "mdn").sortWithinPartitions("mdn", "rank", "app_id")
    return ordered.mapInArrow(sorted_fold.fold_partition(PRIOR, PROFILE_VALUES), _OUT_SCHEMA)


def step_events(tagged_sums: DataFrame) -> DataFrame:
    """Usage sums as fold events (rank 1); ``tagged`` marks a tag-library hit
    (a NaN tag value is a hit, as in the array fold)."""
    return tagged_sums.select("mdn", F.lit(1).alias("rank"), "app_id",
                              F.col("times").cast("bigint").alias("times"),
                              F.col("male").isNotNull().alias("tagged"), *TAG_VALUES)


def store_events(store: DataFrame) -> DataFrame:
    return store.where(F.length("mdn") > 0).select(
        "mdn", F.lit(0).alias("rank"), F.lit(None).cast("string").alias("app_id"),
        F.lit(None).cast("bigint").alias("times"), F.lit(True).alias("tagged"),
        *[F.coalesce(F.col(n), F.raise_error(F.lit(f"NULL {n} in a stored profile")))
          .alias(n) for n in PROFILE_VALUES])


def build_profiles_sorted(tagged_sums: DataFrame) -> DataFrame:
    """``build_profiles`` by secondary sort (no per-user array)."""
    return fold_sorted(step_events(tagged_sums))


def merge_profiles_sorted(store: DataFrame, tagged_sums: DataFrame) -> DataFrame:
    """``merge_profiles`` by secondary sort: the stored row sorts first in its
    user's sequence (rank 0), exactly the order the fold needs."""
    return fold_sorted(store_events(store).unionByName(step_events(tagged_sums)))
