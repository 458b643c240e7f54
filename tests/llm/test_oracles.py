"""The queries against their DuckDB SQL."""

import duckdb
import pytest

from tenure.llm.oracles import ORACLES
from tenure.llm.queries import QUERIES
from tests.llm.helpers import SF, same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    same([tuple(r[n] for n in names) for r in got.collect()], cur.fetchall())


def test_all_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
