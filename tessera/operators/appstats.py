"""App-statistics line validation (the line itself is kept unchanged)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.parsing import (field, is_ipv4, lenient_datetime_ok, split_once,
                                       strict_datetime_ok)

N_FIELDS, IP_IDX, TIME_IDX = 5, 0, 3


def appstat_filter(date_policy: str = "lenient"):
    """Over ``_parts`` (see ``split_once``): exactly 5 comma fields, an IPv4 first
    field and a parsable timestamp in field 3 (lenient ``SimpleDateFormat`` rules
    by default, a real calendar timestamp with ``date_policy='strict'``)."""
    parts = F.col("_parts")
    ts = field(parts, TIME_IDX)
    date_ok = lenient_datetime_ok(ts) if date_policy == "lenient" else strict_datetime_ok(ts)
    return (F.size(parts) == N_FIELDS) & is_ipv4(field(parts, IP_IDX)) & date_ok


def clean_appstats(lines: DataFrame, date_policy: str = "lenient") -> DataFrame:
    """Valid lines, unchanged."""
    return split_once(lines.select("value"), ",").where(appstat_filter(date_policy)).select("value")
