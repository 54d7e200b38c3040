import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tessera.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, app_name="tessera-tests")
    yield s
    s.stop()


@pytest.fixture
def few_partitions(spark):
    """Two shuffle partitions: for tests of many small jobs."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "2")
    yield
    spark.conf.set(key, old)


def lines_df(spark, lines, **extra):
    """A ``value`` DataFrame from literal lines (plus optional extra columns)."""
    rows = [(v, *[extra[k][i] for k in extra]) for i, v in enumerate(lines)]
    schema = "value string" + "".join(f", {k} bigint" for k in extra)
    return spark.createDataFrame(rows, schema)
