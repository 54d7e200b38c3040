"""Independent DuckDB SQL for every registered query.

The oracles never parse the generated text: they apply the fixture's spoil
predicates to the structured columns of the driver tables and compute the
expected result directly (the profile fold as a recursive CTE). Constants come
from ``tessera.sources.derived`` so both sides use the same fixture.
"""

from __future__ import annotations

from tessera.operators.ipgeo import UNKNOWN_PROVINCE
from tessera.operators.profile import PRIOR
from tessera.sources import derived as d

V = ("male", "female", "age1", "age2", "age3", "age4", "age5")
G = ("male", "female")
A = ("age1", "age2", "age3", "age4", "age5")


def _dbl(x: float) -> str:
    return f"'{x!r}'::DOUBLE"


def _dotted(ip: str) -> str:
    return ("concat_ws('.', CAST(({ip}) >> 24 AS VARCHAR), CAST((({ip}) >> 16) & 255 AS VARCHAR), "
            "CAST((({ip}) >> 8) & 255 AS VARCHAR), CAST(({ip}) & 255 AS VARCHAR))").format(ip=ip)


def _pseudo_ip(a: str, mul_a: int, b: str | None = None, mul_b: int = 0) -> str:
    x = f"({a} % {d.IP_SPAN}) * {mul_a}"
    if b is not None:
        x += f" + ({b} % {d.IP_SPAN}) * {mul_b}"
    return f"({d.IP_BASE} + ({x}) % {d.IP_SPAN})"


USAGE_RAW = """usage_raw AS (
  SELECT l.l_orderkey AS k, o.o_custkey, l.l_partkey, l.l_quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

USAGE_STRICT = f"""usage_strict AS (
  SELECT CAST(o_custkey AS VARCHAR) AS mdn, CAST(l_partkey % {d.N_APPS} + 1 AS VARCHAR) AS app_id,
         CAST(l_quantity AS BIGINT) AS times
  FROM usage_raw
  WHERE k % {d.USAGE_SPOIL_TIMES_TEXT} <> 0 AND k % {d.USAGE_SPOIL_EMPTY_MDN} <> 0
    AND k % {d.USAGE_SPOIL_APP_ZERO} <> 0 AND k % {d.USAGE_SPOIL_TIMES_NEG} <> 0)"""

USAGE_LENIENT = f"""usage_lenient AS (
  SELECT CAST(o_custkey AS VARCHAR) AS mdn,
         CASE WHEN k % {d.USAGE_SPOIL_APP_ZERO} = 0 THEN '0'
              ELSE CAST(l_partkey % {d.N_APPS} + 1 AS VARCHAR) END AS app_id,
         CASE WHEN k % {d.USAGE_SPOIL_TIMES_NEG} = 0 THEN CAST(-1 AS BIGINT)
              ELSE CAST(l_quantity AS BIGINT) END AS times
  FROM usage_raw
  WHERE k % {d.USAGE_SPOIL_TIMES_TEXT} <> 0 AND k % {d.USAGE_SPOIL_EMPTY_MDN} <> 0)"""

SUMS = """sums AS (
  SELECT mdn, app_id, CAST(SUM(times) AS BIGINT) AS times FROM usage_strict GROUP BY mdn, app_id)"""
SUMS_LENIENT = SUMS.replace("usage_strict", "usage_lenient")

_raw = [f"CAST((pk * {k}) % 7 + 1 AS DOUBLE)" for k in range(1, 6)]
_raw_total = "(" + " + ".join(_raw) + ")"
TAGS = f"""tag_keys AS (
  SELECT p_partkey % {d.N_TAGGED_APPS} + 1 AS app, MAX(p_partkey) AS pk FROM part GROUP BY 1),
tags AS (
  SELECT CAST(t.app AS VARCHAR) AS app_id, p.p_name AS name,
         CAST((pk * 37) % 101 AS DOUBLE) / {_dbl(100.0)} AS male,
         {_dbl(1.0)} - CAST((pk * 37) % 101 AS DOUBLE) / {_dbl(100.0)} AS female,
         {", ".join(f"{r} / {_raw_total} AS age{i}" for i, r in enumerate(_raw, 1))}
  FROM tag_keys t JOIN part p ON p.p_partkey = t.pk)"""

_store_vals = (f"CAST(c_custkey % 100 AS DOUBLE) / {_dbl(100.0)} AS male, "
               f"{_dbl(1.0)} - CAST(c_custkey % 100 AS DOUBLE) / {_dbl(100.0)} AS female, "
               + ", ".join(f"{_dbl(float(k))} / {_dbl(15.0)} AS age{k}" for k in range(1, 6)))
_segments = ", ".join(f"'{s}'" for s in d.STORE_SEGMENTS)
STORE = f"""store AS (
  SELECT CASE WHEN c_custkey % {d.STORE_EMPTY_MDN} = 0 THEN ''
              WHEN c_mktsegment IN ({_segments}) THEN CAST(c_custkey AS VARCHAR)
              ELSE '{d.LAPSED_PREFIX}' || CAST(c_custkey AS VARCHAR) END AS mdn, {_store_vals}
  FROM customer)"""

STEPS = """steps AS (
  SELECT s.mdn, s.times, t.male AS t_male, t.female AS t_female, t.age1 AS t_age1,
         t.age2 AS t_age2, t.age3 AS t_age3, t.age4 AS t_age4, t.age5 AS t_age5,
         ROW_NUMBER() OVER (PARTITION BY s.mdn ORDER BY s.app_id) AS k
  FROM sums s JOIN tags t ON s.app_id = t.app_id)"""


def _fold_cols() -> str:
    out = []
    for group in (G, A):
        state = " + ".join(f"f.{n}" for n in group)
        tag = " + ".join(f"s.t_{n}" for n in group)
        den = f"(({state}) + ({tag}) * s.times)"
        for n in group:
            out.append(f"CASE WHEN {den} <> 0 THEN (f.{n} + s.t_{n} * s.times) / {den} "
                       f"ELSE f.{n} END AS {n}")
    return ",\n         ".join(out)


def _fold(seed: str) -> str:
    """Recursive CTE: step k applies the k-th tagged app (by app id string)."""
    return f"""fold AS (
  SELECT mdn, 0 AS k, {", ".join(V)} FROM {seed}
  UNION ALL
  SELECT f.mdn, f.k + 1 AS k,
         {_fold_cols()}
  FROM fold f JOIN steps s ON s.mdn = f.mdn AND s.k = f.k + 1)"""


_FOLD_RESULT = f"""SELECT mdn, {", ".join(V)} FROM fold
QUALIFY ROW_NUMBER() OVER (PARTITION BY mdn ORDER BY k DESC) = 1"""

_prior = ", ".join(f"{_dbl(PRIOR[n])} AS {n}" for n in V)

PROFILE_BUILD = f"""WITH RECURSIVE {USAGE_RAW},
{USAGE_STRICT},
{SUMS},
{TAGS},
{STEPS},
seed AS (SELECT DISTINCT mdn, {_prior} FROM sums),
{_fold("seed")}
{_FOLD_RESULT}"""

PROFILE_BUILD_LENIENT = f"""WITH RECURSIVE {USAGE_RAW},
{USAGE_LENIENT},
{SUMS_LENIENT},
{TAGS},
{STEPS},
seed AS (SELECT DISTINCT mdn, {_prior} FROM sums),
{_fold("seed")}
{_FOLD_RESULT}"""

_seed_merge = ", ".join(f"COALESCE(st.{n}, {_dbl(PRIOR[n])}) AS {n}" for n in V)
PROFILE_MERGE = f"""WITH RECURSIVE {USAGE_RAW},
{USAGE_STRICT},
{SUMS},
{TAGS},
{STORE},
{STEPS},
seed AS (
  SELECT COALESCE(st.mdn, u.mdn) AS mdn, {_seed_merge}
  FROM (SELECT * FROM store WHERE length(mdn) > 0) st
  FULL OUTER JOIN (SELECT DISTINCT mdn FROM sums) u ON st.mdn = u.mdn),
{_fold("seed")}
{_FOLD_RESULT}"""

# Two days: one sequence of steps per user, the first day's before the second's.
PROFILE_TWO_DAYS = f"""WITH RECURSIVE {USAGE_RAW},
{USAGE_STRICT.replace("AS mdn,", "AS mdn, k % 2 AS day,", 1)},
sums AS (
  SELECT mdn, day, app_id, CAST(SUM(times) AS BIGINT) AS times FROM usage_strict
  GROUP BY mdn, day, app_id),
{TAGS},
{STORE},
{STEPS.replace("ORDER BY s.app_id", "ORDER BY s.day, s.app_id")},
seed AS (
  SELECT COALESCE(st.mdn, u.mdn) AS mdn, {_seed_merge}
  FROM (SELECT * FROM store WHERE length(mdn) > 0) st
  FULL OUTER JOIN (SELECT DISTINCT mdn FROM sums) u ON st.mdn = u.mdn),
{_fold("seed")}
{_FOLD_RESULT}"""

_null_vals = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in V)
TAGGED = f"""tagged AS (
  SELECT mdn, {", ".join(V)}, CAST(NULL AS VARCHAR) AS app_id, CAST(NULL AS BIGINT) AS times,
         'store' AS source
  FROM store WHERE length(mdn) > 0
  UNION ALL
  SELECT mdn, {_null_vals}, app_id, times, 'log' AS source FROM sums WHERE length(mdn) > 0)"""

ORDER_RAW = f"""order_raw AS (
  SELECT l.l_orderkey AS k, o.o_custkey, l.l_quantity, p.p_type, p.p_name, p.p_retailprice,
         {_pseudo_ip("l.l_orderkey", d.IP_MUL_ORDER, "l.l_partkey", d.IP_MUL_PART)} AS ip_full
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""


def _orders(name: str, lenient: bool) -> str:
    ip = (f"CASE WHEN k % {d.ORDER_SPOIL_OCTET_ZERO} = 0 THEN ip_full % 16777216 ELSE ip_full END"
          if lenient else "ip_full")
    where = f"k % {d.ORDER_SPOIL_DROP_FIELD} <> 0 AND k % {d.ORDER_SPOIL_PRICE_TEXT} <> 0"
    if not lenient:
        where += f" AND k % {d.ORDER_SPOIL_OCTET_ZERO} <> 0"
    return f"""{name} AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "user", {ip} AS ip, p_type AS category,
         replace(p_name, ' ', '_') AS item, p_retailprice AS price,
         CAST(l_quantity AS FLOAT) AS amount,
         p_retailprice * CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS total
  FROM order_raw WHERE {where})"""


RULES = f"""rules AS (
  SELECT {d.IP_BASE} + CAST(n_nationkey AS BIGINT) * {d.RULE_STEP} AS r_start,
         {d.IP_BASE} + CAST(n_nationkey AS BIGINT) * {d.RULE_STEP} + {d.RULE_WIDTH} AS r_end,
         n_name AS province
  FROM nation)"""

ORDER_PROV = f"""order_prov AS (
  SELECT o.*, COALESCE(r.province, '{UNKNOWN_PROVINCE}') AS province
  FROM order_strict o LEFT JOIN rules r ON o.ip BETWEEN r.r_start AND r.r_end)"""

_ORDERS_BASE = f"WITH {ORDER_RAW},\n{_orders('order_strict', False)}"
_ORDERS_PROV = f"{_ORDERS_BASE},\n{RULES},\n{ORDER_PROV}"
_ORDER_COLS = '"user", ip, category, item, price, amount, total'

ORDER_KPI = f"""{_ORDERS_PROV}
SELECT 'total' AS metric, 'all' AS key, ROUND(SUM(total), 2) AS value FROM order_prov
UNION ALL
SELECT 'province' AS metric, province AS key, ROUND(SUM(total), 2) AS value
FROM order_prov GROUP BY province
UNION ALL
SELECT 'category' AS metric, category AS key, ROUND(SUM(total), 2) AS value
FROM order_prov GROUP BY category"""



def landed_batches(groups: int) -> str:
    """``batches``: the groups that order lines land in, one micro-batch each, with the rows
    that stay and their size; short lines, all rejected, are the last group."""
    strict = _orders("order_keyed", False).replace("SELECT CAST(o_custkey", "SELECT k, CAST(o_custkey", 1)
    return f"""WITH RECURSIVE {ORDER_RAW},
{strict},
batches AS (
  SELECT g, coalesce(n, 0) AS n, coalesce(bytes, 0) AS bytes FROM (
    SELECT DISTINCT CASE WHEN k % {d.ORDER_SPOIL_DROP_FIELD} = 0 THEN {groups}
                         ELSE k % {groups} END AS g FROM order_raw)
  LEFT JOIN (
    SELECT k % {groups} AS g, count(*) AS n,
           sum(28 + octet_length(encode("user")) + octet_length(encode(category))
               + octet_length(encode(item))) AS bytes
    FROM order_keyed GROUP BY 1) USING (g))"""


def rolled_archive(groups: int, start: int, step: int, roll_bytes: int, roll_seconds: int) -> str:
    """Parts grow batch by batch within an hour until they are full or too old; a part that
    is not full is closed by the first batch at which it is too old, or at the end."""
    end = start + (groups + 1) * step
    return f"""{landed_batches(groups)},
timed AS (
  SELECT g, n, bytes, {start} + g * {step} AS t,
         strftime(make_timestamp(({start} + g * {step} + 8 * 3600) * 1000000::BIGINT), '%Y-%m-%d-%H')
           AS dt_hour FROM batches),
filled AS (
  SELECT *, row_number() OVER (PARTITION BY dt_hour ORDER BY g) AS i FROM timed WHERE n > 0),
grown AS (
  SELECT g, dt_hour, i, t, 0 AS part, bytes AS size, t AS opened FROM filled WHERE i = 1
  UNION ALL
  SELECT f.g, f.dt_hour, f.i, f.t,
         CASE WHEN fresh THEN p.part + 1 ELSE p.part END,
         CASE WHEN fresh THEN f.bytes ELSE p.size + f.bytes END,
         CASE WHEN fresh THEN f.t ELSE p.opened END
  FROM (SELECT *, size >= {roll_bytes} AS is_full FROM grown) p
  JOIN filled f ON f.dt_hour = p.dt_hour AND f.i = p.i + 1,
  LATERAL (SELECT p.is_full OR f.t - p.opened >= {roll_seconds} AS fresh)),
parts AS (
  SELECT dt_hour, part, max(size) AS size, max(opened) AS opened, max(t) AS last
  FROM grown GROUP BY 1, 2),
closed AS (
  SELECT *, greatest(1, CAST(ceil(size / {roll_bytes}) AS BIGINT)) AS files,
         CASE WHEN size >= {roll_bytes} THEN last
              ELSE coalesce((SELECT min(t) FROM timed WHERE t >= opened + {roll_seconds}), {end}) END
           AS closed FROM parts)
SELECT o."user", o.ip, o.category, o.item, o.price, o.amount, o.total, c.dt_hour, c.files,
       CAST(c.opened AS BIGINT) AS opened, CAST(c.closed AS BIGINT) AS closed
FROM order_keyed o JOIN grown w ON w.g = o.k % {groups}
JOIN closed c ON c.dt_hour = w.dt_hour AND c.part = w.part"""


_stat_ip = _pseudo_ip("event_id", d.IP_MUL_ORDER)
_stat_date = (f"CASE WHEN event_id % {d.STAT_MONTH_13} = 0 THEN strftime(ts, '%Y-13-%d %H:%M:%S') "
              "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END")
APPSTATS = f"""SELECT concat_ws(',', {_dotted(_stat_ip)}, CAST(user_id AS VARCHAR), event_type,
                 {_stat_date}, CAST(event_id AS VARCHAR)) AS value
FROM events
WHERE event_id % {d.STAT_SPOIL_DROP_FIELD} <> 0 AND event_id % {d.STAT_SPOIL_OCTET_ZERO} <> 0
  AND event_id % {d.STAT_SPOIL_DATE_TEXT} <> 0"""
APPSTATS_STRICT = APPSTATS + f"\n  AND event_id % {d.STAT_MONTH_13} <> 0"


def oracle_queries() -> dict[str, str]:
    usage = f"WITH {USAGE_RAW},\n{USAGE_STRICT}"
    usage_sums = f"{usage},\n{SUMS}"
    with_store = f"{usage_sums},\n{STORE},\n{TAGGED}"
    rank = "CASE WHEN source = 'store' THEN 0 ELSE 1 END"
    return {
        "usage_clean": f"{usage}\nSELECT mdn, app_id, times FROM usage_strict",
        "usage_clean_lenient": f"WITH {USAGE_RAW},\n{USAGE_LENIENT}\n"
                               "SELECT mdn, app_id, times FROM usage_lenient",
        "usage_by_user_app": f"{usage_sums}\nSELECT mdn, app_id, times FROM sums",
        "distinct_users": f"{usage}\nSELECT COUNT(DISTINCT mdn) AS users FROM usage_strict",
        "record_counts": f"""{usage_sums},\n{STORE}
SELECT 'usage_rows' AS metric, COUNT(*) AS n FROM usage_strict
UNION ALL SELECT 'usage_sums', COUNT(*) FROM sums
UNION ALL SELECT 'stored_profiles', COUNT(*) FROM store
UNION ALL SELECT 'merged_rows', (SELECT COUNT(*) FROM sums) + (SELECT COUNT(*) FROM store)""",
        "tag_library": f"WITH {TAGS}\nSELECT app_id, name, {', '.join(V)} FROM tags",
        "usage_tag_join": f"""{usage_sums},\n{TAGS}
SELECT s.mdn, s.app_id, s.times, {', '.join('t.' + n for n in V)}
FROM sums s LEFT JOIN tags t ON s.app_id = t.app_id""",
        "profile_build": PROFILE_BUILD,
        "profile_build_lenient": PROFILE_BUILD_LENIENT,
        "profile_merge": PROFILE_MERGE,
        "profile_merge_sorted": PROFILE_MERGE,
        "tagged_union": f"{with_store}\nSELECT * FROM tagged",
        "tagged_union_files": f"{with_store}\nSELECT * FROM tagged",
        "update_sequence": f"""{with_store}
SELECT mdn, source, app_id, times,
       ROW_NUMBER() OVER (PARTITION BY mdn ORDER BY {rank}, app_id) AS seq
FROM tagged""",
        "merged_sorted": f"{with_store}\nSELECT * FROM tagged ORDER BY mdn, {rank}, app_id",
        "merged_ranked": f"{with_store}\nSELECT *, row_number() OVER (ORDER BY mdn, {rank}, app_id) "
                         "AS rank FROM tagged",
        "profile_two_days": PROFILE_TWO_DAYS,
        "profile_text": PROFILE_BUILD,
        "order_etl": f"{_ORDERS_BASE}\nSELECT {_ORDER_COLS} FROM order_strict",
        "order_etl_lenient": f"WITH {ORDER_RAW},\n{_orders('order_lenient', True)}\n"
                             f"SELECT {_ORDER_COLS} FROM order_lenient",
        "ip_province": f"{_ORDERS_PROV}\nSELECT {_ORDER_COLS}, province FROM order_prov",
        "order_total": f"{_ORDERS_BASE}\nSELECT ROUND(SUM(total), 2) AS value FROM order_strict",
        "order_by_province": f"{_ORDERS_PROV}\nSELECT province, ROUND(SUM(total), 2) AS value "
                             "FROM order_prov GROUP BY province",
        "order_by_category": f"{_ORDERS_BASE}\nSELECT category, ROUND(SUM(total), 2) AS value "
                             "FROM order_strict GROUP BY category",
        "order_kpi": ORDER_KPI,
        "order_kpi_stream": ORDER_KPI,
        "order_kpi_delta": ORDER_KPI,
        "order_kpi_restart": ORDER_KPI,
        "order_archive": f"{_ORDERS_BASE}\nSELECT {_ORDER_COLS} FROM order_strict",
        "order_archive_rolled": rolled_archive(d.LANDING_GROUPS, d.ROLL_START, d.ROLL_STEP,
                                               d.ROLL_BYTES, d.ROLL_SECONDS),
        "order_archive_batches": f"""{landed_batches(d.LANDING_GROUPS)}
SELECT CAST(row_number() OVER (ORDER BY g) - 1 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS files,
       n AS rows, n AS stored FROM batches""",
        "order_compact_late": f"{_ORDERS_BASE}\nSELECT {_ORDER_COLS} FROM order_strict",
        "order_compact": f"{_ORDERS_BASE}\nSELECT {_ORDER_COLS} FROM order_strict",
        "appstats_etl": APPSTATS,
        "appstats_etl_strict": APPSTATS_STRICT,
        "appstats_text": APPSTATS,
        "usage_from_text": f"{usage}\nSELECT mdn, app_id, times FROM usage_strict",
        "tag_library_from_text": f"WITH {TAGS}\nSELECT app_id, name, {', '.join(V)} FROM tags",
        "ip_province_from_text": f"{_ORDERS_PROV}\nSELECT {_ORDER_COLS}, province FROM order_prov",
        "usage_tag_join_salted": f"""{usage_sums},\n{TAGS}
SELECT s.mdn, s.app_id, s.times, {', '.join('t.' + n for n in V)}
FROM sums s LEFT JOIN tags t ON s.app_id = t.app_id""",
        "ip_province_sweep": f"{_ORDERS_PROV}\nSELECT {_ORDER_COLS}, province FROM order_prov",
        "partition_report": f"""{usage_sums}
SELECT CAST(CAST('0x' || substr(md5(mdn), 1, 8) AS BIGINT) % {d.REPORT_PARTITIONS} AS INTEGER)
         AS partition, COUNT(*) AS rows, COUNT(DISTINCT mdn) AS users FROM sums GROUP BY 1""",
        "partition_placement": f"""{usage_sums}
SELECT COUNT(*) AS rows, COUNT(DISTINCT mdn) AS users, CAST(1 AS BIGINT) AS partitions_per_user
FROM sums""",
        "event_hours": """SELECT event_id, strftime(t, '%Y') AS year, strftime(t, '%m') AS month,
       strftime(t, '%d') AS day, strftime(t, '%H') AS hour, strftime(t, '%Y-%m-%d-%H') AS dt_hour
FROM (SELECT event_id, CAST(ts AS TIMESTAMP) + INTERVAL 8 HOUR AS t FROM events)""",
    }
