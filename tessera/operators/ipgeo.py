"""IP address -> province: a broadcast range join over /16 blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.parsing import field, parse_long, required, split_once
from tessera.operators.ranking import ranked
from tessera.operators.skew import hot_keys, replicated, salted
from tessera.plans.broadcast import (DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS,
                                     materialize)

# --- fixed values ------------------------------------------------------------------
UNKNOWN_PROVINCE = "未知"   # an address outside every range
BLOCK_BITS = 16             # ranges are cut into /16 blocks for the equi-join key
# -----------------------------------------------------------------------------------


def parse_ip_rules(lines: DataFrame) -> DataFrame:
    """``|``-separated rule lines -> ``(start, end, province)``; fields 2, 3 and 6.

    A malformed rule (missing field, non-numeric bound) fails the job."""
    parts = F.col("_parts")
    return split_once(lines, "|").select(
        required(parse_long(field(parts, 2)), "rule start", "bigint").alias("start"),
        required(parse_long(field(parts, 3)), "rule end", "bigint").alias("end"),
        required(field(parts, 6), "rule province", "string").alias("province"))


def overlapping_rules(rules: DataFrame, small: bool = False) -> DataFrame:
    """Rules whose start is not above the end of the rule before it in order of start.

    If any two rules overlap, two neighbours do, so neighbours are enough, and no rule is
    exploded. ``small`` (a table of measured, broadcast size) looks through them in one
    sorted task; otherwise each rule gets its exact rank and is joined to the one before.
    """
    if small:
        w = Window.orderBy("start", "end")
        return rules.withColumn("prev_end", F.lag("end").over(w)).where(F.col("prev_end") >= F.col("start"))
    placed = ranked(rules, [F.col("start"), F.col("end")], "place")
    before = placed.select((F.col("place") + 1).alias("place"), F.col("end").alias("prev_end"))
    return placed.join(before, "place").where(F.col("prev_end") >= F.col("start")).drop("place")


def rule_blocks(rules: DataFrame) -> DataFrame:
    """One row per (rule, /16 block it touches). Disjoint ranges over 32 bits give
    at most ``n_rules + 65536`` rows."""
    return rules.select(
        F.explode(F.sequence(F.shiftright("start", BLOCK_BITS), F.shiftright("end", BLOCK_BITS)))
        .alias("block"), "start", "end", "province")


def prepare_rules(rules: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                  check_disjoint: bool = True) -> tuple[DataFrame, bool]:
    """Block table of ``rules`` and whether it is broadcast.

    The rules are written once and measured. Disjoint ranges over 32 bits explode to
    at most ``n_rules + 65536`` blocks, so the rows and bytes of the rules bound those of
    the block table; within both bounds it is broadcast. Otherwise the join is a shuffle
    join on the block key (AQE splits hot blocks). Overlapping rules are refused either way.
    """
    table, n, size = materialize(rules.select("start", "end", "province"))
    blocks_at_most = n + (1 << BLOCK_BITS)
    row = size / max(1, n) + 8                  # a block's row: the rule and the block
    small = blocks_at_most <= max(max_rows, 1) and blocks_at_most * row <= DEFAULT_MAX_BROADCAST_BYTES
    if check_disjoint and overlapping_rules(table, small).take(1):
        raise ValueError("IP rules overlap; a range lookup over them is ambiguous")
    blocks = rule_blocks(table)
    return (F.broadcast(blocks), True) if small else (blocks, False)


def attach_province(df: DataFrame, rules: DataFrame, ip_col: str = "ip",
                    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    prepared: tuple[DataFrame, bool] | None = None) -> DataFrame:
    """Left range join: ``province`` of the rule with ``start <= ip <= end``, else
    ``UNKNOWN_PROVINCE``. Equi-join on the /16 block plus the range condition, so
    Spark plans a hash join instead of a nested loop."""
    blocks, _ = prepared or prepare_rules(rules, max_rows)
    ip = F.col(ip_col)
    probe = df.withColumn("_block", F.shiftright(ip, BLOCK_BITS))
    b = blocks.select(F.col("block").alias("_rb"), F.col("start").alias("_rs"),
                      F.col("end").alias("_re"), F.col("province").alias("_rp"))
    j = probe.join(b, (F.col("_block") == F.col("_rb")) & (ip >= F.col("_rs")) & (ip <= F.col("_re")),
                   "left")
    return j.select(*df.columns, F.coalesce(F.col("_rp"), F.lit(UNKNOWN_PROVINCE)).alias("province"))


def attach_province_sweep(df: DataFrame, rules: DataFrame, ip_col: str = "ip",
                          partitions: int | None = None, check_disjoint: bool = True) -> DataFrame:
    """``attach_province`` by a sweep, for rules that may not be broadcast.

    Rules, cut into /16 blocks, and probes are one relation, sorted by address within each
    block with rules first; the last rule that starts at or before a probe is carried
    forward and holds if it has not ended. A block with more than a partition's share of
    the probes is cut into salts: its probes are dealt to them by their hash, its rules
    stand in each. A task sees about a partition's share of rows, however hot a block or an
    address is; probes that are equal in every column stay together.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table, _, _ = materialize(rules.select("start", "end", "province"))
    if check_disjoint and overlapping_rules(table).take(1):
        raise ValueError("IP rules overlap; a range lookup over them is ambiguous")
    rows, _, _ = materialize(df)
    probes = rows.withColumn("_block", F.shiftright(F.col(ip_col), BLOCK_BITS))
    tiers = hot_keys(probes, "_block", n)
    spread = F.struct(*[F.col(c) for c in df.columns])
    rule = F.struct(F.col("end").alias("end"), F.col("province").alias("province"))
    starts = replicated(rule_blocks(table).withColumnRenamed("block", "_block"), "_block", tiers)
    events = salted(probes, "_block", tiers, spread).select(
        "*", F.col(ip_col).alias("_at"), F.lit(1).alias("_probe")).unionByName(
        starts.select("_block", "_salt", F.col("start").alias("_at"), F.lit(0).alias("_probe"),
                      rule.alias("_rule")), allowMissingColumns=True)
    sweep = Window.partitionBy("_block", "_salt").orderBy("_at", "_probe").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("_last", F.last("_rule", ignorenulls=True).over(sweep)).where("_probe = 1")
    hit = F.when(F.col("_last.end") >= F.col(ip_col), F.col("_last.province"))
    return found.select(*df.columns, F.coalesce(hit, F.lit(UNKNOWN_PROVINCE)).alias("province"))
