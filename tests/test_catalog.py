"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.derived import REPORT_PARTITIONS
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, compare, type_mismatches

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_physical():
    assert set(SQL) <= set(QUERIES)
    assert not {q for q in set(QUERIES) - set(SQL) if q not in E.LLM_QUERIES}


@pytest.mark.parametrize("name", sorted(set(SQL) - set(E.LLM_ORACLES)))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    ok, msg = compare(rows, df.columns, rel.fetchall(), rel.columns)
    assert ok, msg
    assert len(rows) > 0
    assert not type_mismatches(df.dtypes, rel.columns, rel.types)


def test_partition_report_accounts_for_every_row(spark):
    rep = QUERIES["partition_report"](spark, SF_SMALL).collect()
    sums = QUERIES["usage_by_user_app"](spark, SF_SMALL)
    assert sum(r.rows for r in rep) == sums.count()
    assert sum(r.users for r in rep) == sums.select("mdn").distinct().count()
    assert {r.partition for r in rep} <= set(range(REPORT_PARTITIONS))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["mdn", "male", "female", "age1", "age2", "age3", "age4", "age5"]
    assert df.count() > 0
