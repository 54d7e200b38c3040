"""Workload inputs derived from the driver's TPC-H-style tables.

The reference ships no data, so every input it reads (usage logs, the app tag
library, stored profiles, order lines, IP rules, app-statistics lines) is built
here from ``lineitem``/``orders``/``part``/``customer``/``nation``/``events`` as a
DataFrame of text lines (``value``), exactly what ``spark.read.text`` would give.
Every row of the source tables becomes a line, so the work grows with the tables.

Some lines are deliberately spoiled (a field made unparsable, dropped or set to a
sentinel) so that the validation filters have something to reject. Which rows
are spoiled is a fixed function of the row key; the DuckDB oracles in
``__spark_entry__`` apply the same predicates to the structured columns and never
parse the text, so they are independent of the parsers under test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.parsing import ip_from_long

# --- fixed fixture parameters (shared with the oracle SQL) ----------------------
N_APPS = 60                 # usage app_id = l_partkey % N_APPS + 1
N_TAGGED_APPS = 50          # tag line app_id = p_partkey % N_TAGGED_APPS + 1
USAGE_SPOIL_TIMES_TEXT = 17   # l_orderkey % 17 = 0 -> times field "x"
USAGE_SPOIL_EMPTY_MDN = 19    # l_orderkey % 19 = 0 -> mdn ""
USAGE_SPOIL_APP_ZERO = 23     # l_orderkey % 23 = 0 -> app_id "0"
USAGE_SPOIL_TIMES_NEG = 29    # l_orderkey % 29 = 0 -> times "-1"
ORDER_SPOIL_DROP_FIELD = 13   # l_orderkey % 13 = 0 -> last field dropped
ORDER_SPOIL_OCTET_ZERO = 31   # l_orderkey % 31 = 0 -> first octet 0
ORDER_SPOIL_PRICE_TEXT = 37   # l_orderkey % 37 = 0 -> price "x"
STAT_SPOIL_DROP_FIELD = 11    # event_id % 11 = 0 -> last field dropped
STAT_SPOIL_OCTET_ZERO = 13    # event_id % 13 = 0 -> first octet 0
STAT_SPOIL_DATE_TEXT = 17     # event_id % 17 = 0 -> date "x"
STAT_MONTH_13 = 19            # event_id % 19 = 0 -> month 13 (lenient parse only)
IP_BASE = 16777216            # 1.0.0.0
IP_SPAN = 3741319168          # addresses drawn from [1.0.0.0, 1.0.0.0 + IP_SPAN)
IP_MUL_ORDER = 1640531527     # keys are reduced mod IP_SPAN first: no 64-bit overflow
IP_MUL_PART = 104729
RULE_STEP = 149000000         # nation k owns [IP_BASE + k*RULE_STEP, + RULE_WIDTH]
RULE_WIDTH = 120000000
STORE_SEGMENTS = ("BUILDING", "MACHINERY")   # customers still active; the others have lapsed
STORE_EMPTY_MDN = 97                          # c_custkey % 97 = 0 -> stored mdn ""
LAPSED_PREFIX = "L"
LANDING_GROUPS = 6            # order lines land in batches by l_orderkey % 6; short lines, which
                              # are all rejected, make a last batch of their own
ROLL_START = 1704039000       # clock of the first batch: 2024-01-01 00:10 in Asia/Shanghai
ROLL_STEP = 25 * 60           # seconds from one batch to the next
ROLL_BYTES = 1_000_000        # a small bound, so that the given tables fill parts
ROLL_SECONDS = 60 * 60
REPORT_PARTITIONS = 32        # partitions of the per-partition report
# ---------------------------------------------------------------------------------


# Columns of the driver tables used here. Declaring them skips the footer-reading
# schema inference job on every read; columns not listed are never read anyway.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "customer": "c_custkey bigint, c_mktsegment string, c_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _by_order(lineitem: DataFrame) -> DataFrame:
    """Hash-partition line items by order key ahead of the join with ``orders``.

    A shuffle join on the order key needs exactly this distribution (same key,
    ``spark.sql.shuffle.partitions`` partitions), so on a large input the
    exchange is the join's own; when ``orders`` is small enough to broadcast it
    still spreads the CPU-bound text building and parsing that follow over all
    tasks. The count is explicit so AQE does not merge these partitions by byte
    size (the rows are narrow, the work per row is not).
    """
    n = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lineitem.repartition(n, "l_orderkey")


def _pseudo_ip(a: Column, mul_a: int, b: Column | None = None, mul_b: int = 0) -> Column:
    x = (a % F.lit(IP_SPAN)) * F.lit(mul_a)
    if b is not None:
        x = x + (b % F.lit(IP_SPAN)) * F.lit(mul_b)
    return F.lit(IP_BASE) + x % F.lit(IP_SPAN)


def _spoil_first_octet(ip: Column, spoil: Column) -> Column:
    dotted = ip_from_long(ip)
    return F.when(spoil, F.regexp_replace(dotted, r"^[0-9]+", "0")).otherwise(dotted)


def usage_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Usage log: 16 ``|`` fields, mdn at 0, procedure time at 12, app id at 15; ``keep``
    names columns of the tables that stay beside the line."""
    li = _by_order(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    k = F.col("l_orderkey")
    mdn = F.when(k % USAGE_SPOIL_EMPTY_MDN == 0, F.lit("")).otherwise(
        F.col("o_custkey").cast("string"))
    times = (F.when(k % USAGE_SPOIL_TIMES_TEXT == 0, F.lit("x"))
             .when(k % USAGE_SPOIL_TIMES_NEG == 0, F.lit("-1"))
             .otherwise(F.col("l_quantity").cast("bigint").cast("string")))
    app = F.when(k % USAGE_SPOIL_APP_ZERO == 0, F.lit("0")).otherwise(
        (F.col("l_partkey") % N_APPS + 1).cast("string"))
    fillers_a = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                 F.col("l_suppkey").cast("string"), F.lit("460"), F.lit("03"), F.lit("cmnet"),
                 F.lit("LTE"), F.lit("0"), F.lit("1"), F.lit("up"), F.lit("down")]
    fillers_b = [F.lit("200"), F.lit("wap")]
    return j.select(F.concat_ws("|", mdn, *fillers_a, times, *fillers_b, app).alias("value"), *keep)


def with_wrong_widths(line: Column) -> Column:
    """A usage-sum line, followed by a line without its last field where its CRC-32 is
    divisible by 7, and by a line with one more field where it is divisible by 11."""
    crc = F.crc32(line.cast("binary"))
    short = F.when(crc % 7 == 0, F.substring_index(line, "|", 2))
    long = F.when(crc % 11 == 0, F.concat(line, F.lit("|9")))
    return F.array_compact(F.array(line, short, long))


def tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App tag library: ``app_id|name|male|female|age1..age5``, one line per part.

    Several parts share an app id; the line with the larger ``p_partkey`` comes
    later (``line_no``) and wins. Apps above ``N_TAGGED_APPS`` have no tag.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    key = F.col("p_partkey")
    male = ((key * 37) % 101).cast("double") / F.lit(100.0)
    raw = [((key * k) % 7 + 1).cast("double") for k in range(1, 6)]
    total = raw[0] + raw[1] + raw[2] + raw[3] + raw[4]
    vals = [male, F.lit(1.0) - male] + [r / total for r in raw]
    return p.select(
        F.concat_ws("|", (key % N_TAGGED_APPS + 1).cast("string"), F.col("p_name"),
                    *[v.cast("string") for v in vals]).alias("value"),
        key.alias("line_no"))


def stored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's profiles, one per customer: those of two segments under their own
    mdn, the others as lapsed users whose mdn never appears in today's logs
    (``L<custkey>``), and a few without an mdn."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    key = F.col("c_custkey")
    male = (key % 100).cast("double") / F.lit(100.0)
    ages = [F.lit(k / 15.0) for k in range(1, 6)]
    cols = [male.alias("male"), (F.lit(1.0) - male).alias("female")] + [
        a.alias(f"age{i}") for i, a in enumerate(ages, 1)]
    mdn = F.when(key % STORE_EMPTY_MDN == 0, "").when(
        F.col("c_mktsegment").isin(*STORE_SEGMENTS), key.cast("string")).otherwise(
        F.concat(F.lit(LAPSED_PREFIX), key.cast("string")))
    return c.select(mdn.alias("mdn"), *cols)


def order_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Orders: ``user ip category item price amount`` separated by one space; ``keep``
    names columns of the tables that stay beside the line."""
    li = _by_order(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    k = F.col("l_orderkey")
    ip = _pseudo_ip(k, IP_MUL_ORDER, F.col("l_partkey"), IP_MUL_PART)
    head = [F.col("o_custkey").cast("string"), _spoil_first_octet(ip, k % ORDER_SPOIL_OCTET_ZERO == 0),
            F.col("p_type"), F.regexp_replace(F.col("p_name"), " ", "_"),
            F.when(k % ORDER_SPOIL_PRICE_TEXT == 0, F.lit("x")).otherwise(
                F.col("p_retailprice").cast("string"))]
    amount = F.col("l_quantity").cast("string")
    full = F.concat_ws(" ", *head, amount)
    short = F.concat_ws(" ", *head)
    return j.select(F.when(k % ORDER_SPOIL_DROP_FIELD == 0, short).otherwise(full).alias("value"),
                    *keep)


def ip_rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP rules ``start_ip|end_ip|start|end|continent|country|province|isp|region``."""
    n = table(spark, sf_dir, "nation")
    start = F.lit(IP_BASE) + F.col("n_nationkey").cast("bigint") * F.lit(RULE_STEP)
    end = start + F.lit(RULE_WIDTH)
    return n.select(F.concat_ws("|", ip_from_long(start), ip_from_long(end), start.cast("string"),
                                end.cast("string"), F.lit("Asia"), F.lit("China"), F.col("n_name"),
                                F.lit("ISP"), F.col("n_regionkey").cast("string")).alias("value"))


def appstat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App statistics CSV: ``ip,user_id,event_type,yyyy-MM-dd HH:mm:ss,event_id``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    k = F.col("event_id")
    ip = _pseudo_ip(k, IP_MUL_ORDER)
    head = [_spoil_first_octet(ip, k % STAT_SPOIL_OCTET_ZERO == 0), F.col("user_id").cast("string"),
            F.col("event_type"),
            F.when(k % STAT_SPOIL_DATE_TEXT == 0, F.lit("x"))
            .when(k % STAT_MONTH_13 == 0, F.date_format(F.col("ts"), "yyyy-'13'-dd HH:mm:ss"))
            .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"))]
    full = F.concat_ws(",", *head, k.cast("string"))
    short = F.concat_ws(",", *head)
    return e.select(F.when(k % STAT_SPOIL_DROP_FIELD == 0, short).otherwise(full).alias("value"))
