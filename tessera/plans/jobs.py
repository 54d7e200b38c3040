"""End-to-end batch jobs composed from the operators (plain DataFrame plans)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.ipgeo import attach_province, parse_ip_rules, prepare_rules
from tessera.operators.orders import order_kpis, parse_orders
from tessera.operators.profile import (build_profiles, build_profiles_sorted, merge_profiles,
                                      merge_profiles_sorted)
from tessera.operators.tags import join_tags, tag_library
from tessera.operators.usage import clean_usage, usage_by_user_app
from tessera.plans.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from tessera.plans.snapshot import SnapshotStore


def usage_sums(usage_lines: DataFrame, policy: str = "strict") -> DataFrame:
    return usage_by_user_app(clean_usage(usage_lines, policy))


FOLD_MODES = ("array", "sorted")
MAX_ARRAY_STEPS = 100_000        # tagged apps that a user's array may hold: 8 MB of steps


def tagged_usage(usage_lines: DataFrame, tag_lines: DataFrame, policy: str = "strict",
                 order_col: str = "line_no",
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                 max_library_rows: int | None = None) -> DataFrame:
    tags = tag_library(tag_lines, order_col)
    return join_tags(usage_sums(usage_lines, policy), tags, max_broadcast_rows, max_library_rows)


def _use_array(fold_mode: str) -> bool:
    """``array`` folds an array per user on the JVM: right while a user's tagged apps,
    at most the tag library, fit in a row; a library above ``MAX_ARRAY_STEPS`` is refused.
    ``sorted`` folds by secondary sort and never builds a group: for libraries of any
    size. The choice is the caller's, not the data's."""
    if fold_mode not in FOLD_MODES:
        raise ValueError(f"fold_mode must be one of {FOLD_MODES}")
    return fold_mode == "array"


def profiles_from_logs(usage_lines: DataFrame, tag_lines: DataFrame, policy: str = "strict",
                       order_col: str = "line_no", fold_mode: str = "array",
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Today's profiles from the prior: parse -> filter -> sum by (user, app) ->
    broadcast tag join -> per-user ordered fold."""
    array = _use_array(fold_mode)
    tagged = tagged_usage(usage_lines, tag_lines, policy, order_col, max_broadcast_rows,
                          MAX_ARRAY_STEPS if array else None)
    if array:
        return build_profiles(tagged)
    return build_profiles_sorted(tagged)


def profiles_with_store(store: DataFrame, usage_lines: DataFrame, tag_lines: DataFrame,
                        policy: str = "strict", order_col: str = "line_no",
                        fold_mode: str = "array",
                        max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    array = _use_array(fold_mode)
    tagged = tagged_usage(usage_lines, tag_lines, policy, order_col, max_broadcast_rows,
                          MAX_ARRAY_STEPS if array else None)
    if array:
        return merge_profiles(store, tagged)
    return merge_profiles_sorted(store, tagged)


def run_daily_update(store: SnapshotStore, base_version: int, usage_lines: DataFrame,
                     tag_lines: DataFrame, policy: str = "strict",
                     order_col: str = "line_no", fold_mode: str = "array",
                     day: str | None = None) -> int:
    """Read snapshot ``base_version``, fold the day's logs in, write
    ``base_version + 1``. Re-running the same day from the same base rewrites the
    same snapshot, so a retried day does not apply its logs twice; ``day`` is
    recorded with the version, see ``SnapshotStore.base_of_day``."""
    merged = profiles_with_store(store.read(base_version), usage_lines, tag_lines, policy,
                                 order_col, fold_mode)
    store.write(merged, base_version + 1, day=day, placed=True)
    return base_version + 1


def orders_with_province(order_lines: DataFrame, rule_lines: DataFrame, policy: str = "strict",
                         max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    orders = parse_orders(order_lines, policy)
    prepared = prepare_rules(parse_ip_rules(rule_lines), max_broadcast_rows)
    return attach_province(orders, None, prepared=prepared)


def batch_order_kpis(order_lines: DataFrame, rule_lines: DataFrame,
                     policy: str = "strict") -> DataFrame:
    return order_kpis(orders_with_province(order_lines, rule_lines, policy))
