"""Every catalog query against its DuckDB oracle on the sf0.001 driver data."""

import duckdb
import pytest

import __spark_entry__ as E
from tenure.plans.catalog import QUERIES
from tests.conftest import SF001
from tools.compare import TABLES, digest, oracle_frame

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["position_nbr", "max_head_count", "head_count", "over_capacity"]


def test_every_query_has_an_oracle():
    assert not set(QUERIES) - set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    odf = oracle_frame(con, sql)
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(sdf)[0] == digest(odf)[0]
