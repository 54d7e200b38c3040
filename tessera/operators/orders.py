"""Order-line ETL and order KPIs (total, by province, by category)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import (evaluate_once, field, ip_to_long, ipv4_to_long, is_ipv4,
                                       parse_double, parse_float, split_once)

ORDER_COLUMNS = ("user", "ip", "category", "item", "price", "amount", "total")
POLICIES = ("strict", "lenient")
METRIC_TOTAL, METRIC_PROVINCE, METRIC_CATEGORY = "total", "province", "category"
TOTAL_KEY = "all"


def parse_orders(lines: DataFrame, policy: str = "strict") -> DataFrame:
    """``user ip category item price amount`` -> typed orders with ``total``.

    strict : exactly 6 fields, IPv4 pattern, price parses as double and amount as
             float.
    lenient: the same without the IPv4 pattern; every dot-separated part of the
             address must parse as a long.
    ``total = price * amount`` with the float amount widened to double.
    Other columns of ``lines`` (e.g. a source offset) are carried along.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    extra = [c for c in lines.columns if c != "value"]
    parts = F.col("_parts")
    typed = evaluate_once(
        split_once(lines, " "),
        F.size(parts).alias("_n"), field(parts, 0).alias("user"), field(parts, 1).alias("_ip_text"),
        field(parts, 2).alias("category"), field(parts, 3).alias("item"),
        parse_double(field(parts, 4)).alias("price"), parse_float(field(parts, 5)).alias("amount"),
        *[F.col(c) for c in extra])
    ok = (F.col("_n") == 6) & F.col("price").isNotNull() & F.col("amount").isNotNull()
    if policy == "strict":
        ok = ok & is_ipv4(F.col("_ip_text"))
        as_long = ipv4_to_long
    else:
        as_long = ip_to_long
    typed = evaluate_once(typed, *[F.col(c) for c in typed.columns],
                          as_long(F.col("_ip_text")).alias("_ip"))
    ok = ok & F.col("_ip").isNotNull()
    ip = F.col("_ip")
    return typed.where(ok).select(
        "user", ip.alias("ip"), "category", "item", "price", "amount",
        (F.col("price") * F.col("amount").cast("double")).alias("total"), *extra)


def order_total(orders: DataFrame) -> DataFrame:
    return orders.agg(F.sum("total").alias("value"))


def order_by_category(orders: DataFrame) -> DataFrame:
    return orders.groupBy("category").agg(F.sum("total").alias("value"))


def order_by_province(orders_with_province: DataFrame) -> DataFrame:
    return orders_with_province.groupBy("province").agg(F.sum("total").alias("value"))


def kpi_rows(orders_with_province: DataFrame) -> DataFrame:
    """Each order contributes to three counters: (total, all), (province, p),
    (category, c). One scan, three rows per order, no extra shuffle."""
    keys = F.array(
        F.struct(F.lit(METRIC_TOTAL).alias("metric"), F.lit(TOTAL_KEY).alias("key")),
        F.struct(F.lit(METRIC_PROVINCE).alias("metric"), F.col("province").alias("key")),
        F.struct(F.lit(METRIC_CATEGORY).alias("metric"), F.col("category").alias("key")))
    return orders_with_province.select(F.inline(keys), "total")


def order_kpis(orders_with_province: DataFrame) -> DataFrame:
    """All three KPIs as ``(metric, key, value)`` in one aggregate; the partial
    aggregate runs before the shuffle, so the single ``total`` key costs one row
    per task, not one per order. A batch is first summed by province and category,
    so that groups are tripled and not orders; a stream has one aggregation only."""
    df = orders_with_province
    if not df.isStreaming:
        df = df.groupBy("province", "category").agg(F.sum("total").alias("total"))
    return kpi_rows(df).groupBy("metric", "key").agg(F.sum("total").alias("value"))
