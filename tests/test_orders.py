"""Order ETL, the IP range join and the KPIs (an own sample of lines)."""

import bisect
import random

import pytest

from tessera.operators import orders as O
from tessera.operators.ipgeo import (UNKNOWN_PROVINCE, attach_province, parse_ip_rules,
                                     prepare_rules)
from tessera.plans import jobs
from tests.conftest import lines_df

# six whole orders, then eight that lack the amount
SAMPLE = [
    "ann 61.135.7.9 books atlas 40 3",
    "bob 61.135.7.200 garden rake 25.5 2",
    "cyd 10.20.30.40 books novel 12 1",
    "dee 120.5.6.7 tools saw 75 4",
    "eli 61.135.8.1 garden pot 8 10",
    "fay 9.9.9.9 toys kite 30.25 4",
    *[f"{u} 10.20.30.{i} {c} thing 5" for i, (u, c) in enumerate(
        (u, c) for u in ("ann", "bob", "cyd", "dee") for c in ("books", "toys"))],
]
NORTH = "a|b|1032259328|1032259583|x|y|north|z"      # 61.135.7.0/24


def test_sample_orders(spark):
    orders = O.parse_orders(lines_df(spark, SAMPLE))
    assert orders.count() == 6
    assert O.order_total(orders).collect()[0].value == 684.0
    cat = {r.category: r.value for r in O.order_by_category(orders).collect()}
    assert cat == {"books": 132.0, "garden": 131.0, "tools": 300.0, "toys": 121.0}
    a = orders.where("user = 'ann'").collect()[0]
    assert a.ip == 1032259337 and a.amount == 3.0 and a.total == 120.0


def test_address_must_end_at_its_last_digit(spark):
    lines = [f"u 1.1.1.1{end} c i 10 2" for end in ("", "\u0085", "\u2028", "\r")]
    strict = O.parse_orders(lines_df(spark, lines), "strict").collect()
    assert [r.ip for r in strict] == [16843009]
    assert [r.ip for r in O.parse_orders(lines_df(spark, lines), "lenient").collect()] == [16843009]


def test_policies(spark):
    lines = ["u 0.1.1.1 c i 10 2", "u 1.01.1.1 c i 10 2", "u 1.1.1.1 c i x 2",
             "u 1.1.1.1 c i 10 2.5", "u 1.1.1.1 c i 10 2 ", "u 1.1.1.1 c i 10 2 extra",
             "u 1..1.1 c i 10 2", "u 1.1.1.1 c i inf 2", "u 1.1.1.1 c i Infinity 2"]
    strict = O.parse_orders(lines_df(spark, lines), "strict").collect()
    lenient = O.parse_orders(lines_df(spark, lines), "lenient").collect()
    assert len(strict) == 3      # 2.5 amount, trailing blank, Infinity price
    assert len(lenient) == 5     # + 0.1.1.1 and 1.01.1.1
    assert {r.ip for r in lenient} == {16843009, 65793}


RULES = [(100, 199, "p1"), (200, 200, "p2"), (65536 * 3 - 5, 65536 * 5 + 7, "p3"),
         (2**31 - 10, 2**31 + 10, "p4"), (4294967000, 4294967295, "p5")]


def rule_lines(spark):
    return lines_df(spark, [f"a|b|{s}|{e}|x|y|{p}|z" for s, e, p in RULES])


def brute(ip):
    starts = [s for s, _, _ in RULES]
    i = bisect.bisect_right(starts, ip) - 1
    if i >= 0 and RULES[i][0] <= ip <= RULES[i][1]:
        return RULES[i][2]
    return UNKNOWN_PROVINCE


def test_range_join_matches_binary_search(spark):
    rng = random.Random(5)
    ips = set()
    for s, e, _ in RULES:
        ips.update({s - 1, s, s + 1, e - 1, e, e + 1})
    ips.update(rng.randrange(0, 2**32) for _ in range(3000))
    ips.update(rng.randrange(65536 * 3 - 100, 65536 * 5 + 100) for _ in range(1000))
    ips.update({-1, 0, 2**32, 2**40})
    df = spark.createDataFrame([(i,) for i in sorted(ips)], "ip bigint")
    got = {r.ip: r.province for r in attach_province(df, parse_ip_rules(rule_lines(spark))).collect()}
    assert len(got) == len(ips)
    assert got == {i: brute(i) for i in ips}


def test_range_join_plan_is_hash_join(spark):
    df = spark.createDataFrame([(5,)], "ip bigint")
    plan = attach_province(df, parse_ip_rules(rule_lines(spark)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_overlapping_rules_rejected(spark):
    bad = lines_df(spark, ["a|b|1|10|x|y|p|z", "a|b|5|20|x|y|q|z"])
    for most in (2_000_000, 1):          # whether the rules are broadcast or not
        with pytest.raises(ValueError):
            prepare_rules(parse_ip_rules(bad), most)


def test_kpis_in_one_pass(spark):
    rules = lines_df(spark, [NORTH])
    kpi = {(r.metric, r.key): r.value
           for r in jobs.batch_order_kpis(lines_df(spark, SAMPLE), rules).collect()}
    assert kpi[("total", "all")] == 684.0
    assert kpi[("province", "north")] == 171.0
    assert kpi[("province", UNKNOWN_PROVINCE)] == 513.0
    assert kpi[("category", "books")] == 132.0


def test_malformed_rule_or_tag_fails(spark):
    from tessera.operators.tags import tag_library
    with pytest.raises(Exception):
        parse_ip_rules(lines_df(spark, ["a|b|x|10|c|d|p"])).collect()
    with pytest.raises(Exception):
        parse_ip_rules(lines_df(spark, ["a|b|1|10|c"])).collect()
    with pytest.raises(Exception):
        tag_library(lines_df(spark, ["7|n|0.5|x|0.2|0.2|0.2|0.2|0.2"], line_no=[1])).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            tag_library(lines_df(spark, ["7|n|0.5|x|0.2|0.2|0.2|0.2|0.2"], line_no=[1])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
