import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_reference_query_has_a_plan():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_plan_equals_reference_sql(spark, con, name):
    verdict, _ = check.compare(spark, con, name, entry.queries()[name], SQL[name], SF)
    assert verdict.startswith("ok"), verdict


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and "final_risk_score" in df.columns
