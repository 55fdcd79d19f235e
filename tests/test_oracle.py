"""Every registered query against its DuckDB SQL at sf0.001 (the driver runs
the same comparison at sf0.01): row count, column names, value hash."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.oracle_check import TABLES, digest

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert all(callable(f) for f in qs.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["type", "name", "count"]
