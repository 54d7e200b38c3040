from tessera.functions.parsing import (  # noqa: F401
    evaluate_once, field, ip_from_long, ip_to_long, is_blank, is_ipv4, java_split, lenient_datetime_ok,
    parse_double, parse_float, parse_int, parse_long, split_once, strict_datetime_ok,
)
