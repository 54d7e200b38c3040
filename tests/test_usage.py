"""Usage-log cleaning policies and per-(user, app) sums."""

from tessera.operators import usage as U
from tests.conftest import lines_df


def line(mdn="13800000000", times="10", app="7", nfields=16):
    f = [mdn] + ["f"] * 11 + [times] + ["g", "h"] + [app]
    return "|".join(f[:nfields])


CASES = [
    (line(), ("13800000000", "7", 10)),
    (line(app="007"), ("13800000000", "7", 10)),        # int re-printed
    (line(app="+7"), ("13800000000", "7", 10)),
    (line(app=" 7"), None),                               # Java rejects blanks
    (line(mdn=""), None),
    (line(mdn="NULL"), "lenient-only"),
    (line(app="0"), "lenient-only"),
    (line(times="-1"), "lenient-only"),
    (line(times="x"), None),
    (line(nfields=15), None),                             # app id field missing
    (line() + "||", ("13800000000", "7", 10)),            # trailing delimiters ignored
    (line(app=""), None),                                 # trailing empty app: dropped field
]


def test_strict_and_lenient(spark):
    df = lines_df(spark, [c[0] for c in CASES])
    strict = sorted(tuple(r) for r in U.clean_usage(df, "strict").collect())
    lenient = sorted(tuple(r) for r in U.clean_usage(df, "lenient").collect())
    exp_strict = sorted(c[1] for c in CASES if isinstance(c[1], tuple))
    assert strict == exp_strict
    assert len(lenient) == len(exp_strict) + sum(1 for c in CASES if c[1] == "lenient-only")
    assert ("NULL", "7", 10) in lenient and ("13800000000", "0", 10) in lenient
    assert ("13800000000", "7", -1) in lenient


def test_sums_and_distinct(spark):
    df = lines_df(spark, [line(times="5"), line(times="6"), line(app="8", times="1"),
                          line(mdn="139", times="2")])
    u = U.clean_usage(df)
    sums = sorted(tuple(r) for r in U.usage_by_user_app(u).collect())
    assert sums == [("13800000000", "7", 11), ("13800000000", "8", 1), ("139", "7", 2)]
    assert U.distinct_users(u).collect()[0].users == 2


def test_sum_overflow_raises(spark):
    import pytest
    df = lines_df(spark, [line(times=str(2**62)), line(times=str(2**62)), line(times=str(2**62))])
    with pytest.raises(Exception):
        U.usage_by_user_app(U.clean_usage(df)).collect()
