"""Column expressions that accept exactly what the reference's Java parsers accept.

Everything here is a plain Catalyst expression (split, rlike, try_cast), evaluated in
the JVM; no Python UDF. Only the lenient address fold uses lambda functions, which Spark
interprets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------------
# IPv4 check used by the order and app-statistics ETL: first octet 1-255, the
# others 0-255, no leading zeros, exactly four octets.
IPV4_PATTERN = (r"^(1\d{2}|2[0-4]\d|25[0-5]|[1-9]\d|[1-9])\.(1\d{2}|2[0-4]\d|25[0-5]|[1-9]\d|\d)\."
                r"(1\d{2}|2[0-4]\d|25[0-5]|[1-9]\d|\d)\.(1\d{2}|2[0-4]\d|25[0-5]|[1-9]\d|\d)\z")
# Lenient "yyyy-MM-dd HH:mm:ss" parse: numeric fields may be preceded by blanks or
# tabs, need not be in range, and anything may follow the seconds.
LENIENT_DATETIME_PATTERN = r"^[ \t]*\d+-[ \t]*\d+-[ \t]*\d+ [ \t]*\d+:[ \t]*\d+:[ \t]*\d+"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------------

_INTEGER = r"^[+-]?[0-9]+\z"      # $ would also match before a final line terminator
# Java's Double.parseDouble trims chars <= U+0020 and accepts only these spellings
# of the special values; Spark's cast also takes "inf", "nan", ... in any case.
_JAVA_SPECIAL = r"^[+-]?(NaN|Infinity)$"
_ANY_SPECIAL = r"(?i)^[+-]?(nan|inf|infinity)$"
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _split_regex(sep: str) -> str:
    """The separator as a one-char or backslash-escaped regex: ``String.split``
    then takes its non-regex fast path instead of compiling a Pattern per row."""
    return "\\" + sep if sep in ".$|()[{^?*+\\" else sep


def java_split(s: Column, sep: str) -> Column:
    """``String.split`` on a one-character separator.

    Java drops trailing empty fields ("a|b||" -> 2 fields), returns ``[""]`` for
    the empty string and ``[]`` for a string made only of separators.
    """
    if len(sep) != 1:
        raise ValueError("separator must be one character")
    stripped = F.rtrim(s, F.lit(sep))
    return (F.when(s == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, _split_regex(sep))))


def field(parts: Column, idx: int) -> Column:
    """0-based field of a split array, NULL when the line is too short."""
    return F.try_element_at(parts, F.lit(idx + 1))


def parse_int(s: Column) -> Column:
    """``Integer.parseInt``: optional sign, ASCII digits, no blanks, 32-bit range."""
    return F.when(s.rlike(_INTEGER), s.try_cast("int"))


def parse_long(s: Column) -> Column:
    """``Long.parseLong``: optional sign, ASCII digits, no blanks, 64-bit range."""
    return F.when(s.rlike(_INTEGER), s.try_cast("bigint"))


def _java_float_text(s: Column) -> Column:
    t = F.regexp_replace(s, _EDGE_BLANKS, "")
    return F.when(~t.rlike(_ANY_SPECIAL) | t.rlike(_JAVA_SPECIAL), t)


def parse_double(s: Column) -> Column:
    """``Double.parseDouble`` (decimal, exponent, hex, d/f suffix, NaN, Infinity)."""
    return _java_float_text(s).try_cast("double")


def parse_float(s: Column) -> Column:
    """``Float.parseFloat``; widen with ``.cast('double')`` like Java's float*double."""
    return _java_float_text(s).try_cast("float")


def required(value: Column, what: str, dtype: str) -> Column:
    """``value`` (of type ``dtype``), or fail the job when it is NULL -- a
    malformed mandatory field -- independent of the session's ANSI setting."""
    return F.coalesce(value, F.raise_error(F.lit(f"malformed input: {what}")).cast(dtype))


def is_blank(s: Column) -> Column:
    """commons-lang ``StringUtils.isEmpty``: null or zero length."""
    return F.coalesce(F.length(s) == 0, F.lit(True))


def is_ipv4(s: Column) -> Column:
    return F.coalesce(s.rlike(IPV4_PATTERN), F.lit(False))


def ip_to_long(ip: Column) -> Column:
    """Fold the dot-separated parts as ``acc = part | (acc << 8)``.

    Any number of parts is accepted, like the reference; a part that is not a
    Java long makes the whole value NULL (the row is then rejected).
    """
    parts = F.transform(java_split(ip, "."), lambda x: parse_long(x))
    return F.aggregate(parts, F.lit(0).cast("bigint"),
                       lambda acc, x: x.bitwiseOR(F.shiftleft(acc, 8)))


def ipv4_to_long(ip: Column) -> Column:
    """The 32 bits of an address that ``is_ipv4`` accepts, by arithmetic on its four
    octets; NULL for anything else."""
    octet = [F.try_element_at(F.split(ip, r"\."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    return ((octet[0] * 256 + octet[1]) * 256 + octet[2]) * 256 + octet[3]


def ip_from_long(n: Column) -> Column:
    """Dotted text of a 32-bit address held in a long."""
    return F.concat_ws(".", *[F.shiftright(n, s).bitwiseAND(255).cast("string")
                              for s in (24, 16, 8, 0)])


def lenient_datetime_ok(s: Column) -> Column:
    """What a lenient ``SimpleDateFormat(DATETIME_FORMAT).parse`` accepts."""
    return F.coalesce(s.rlike(LENIENT_DATETIME_PATTERN), F.lit(False))


def strict_datetime_ok(s: Column) -> Column:
    """A real calendar timestamp in ``DATETIME_FORMAT`` (the strict option)."""
    return F.try_to_timestamp(s, F.lit(DATETIME_FORMAT)).isNotNull()


def split_once(lines: DataFrame, sep: str, col: str = "value", out: str = "_parts") -> DataFrame:
    """Add the Java split of ``col`` as column ``out``, evaluated once per row.

    The split is wrapped in a one-element ``explode``: Catalyst cannot push a
    filter below a generator, so the filters that follow read the array instead
    of re-inlining the regex/split into every predicate (which multiplies the
    per-row work and makes the generated method too large for the JIT).
    """
    return lines.select("*", F.explode(F.array(java_split(F.col(col), sep))).alias(out))


def evaluate_once(df: DataFrame, *cols: Column) -> DataFrame:
    """Project ``cols`` (all aliased) through a one-row generator so that later
    filters and projections reference the computed values, not their formulas."""
    return df.select(F.inline(F.array(F.struct(*cols))))
