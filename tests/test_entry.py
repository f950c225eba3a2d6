import __spark_entry__ as entry
import duckdb
import pytest

from tagloom.plans import queries as core

DATA = "/root/testdata/sf0.001"
TABLES = "events documents pages benchmark labels conversations lineitem".split()


def value(x):
    return round(x, 6) if isinstance(x, float) else tuple(map(value, x)) if isinstance(x, list) else x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_and_oracle(spark, duck, name):
    df = core.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([value(r[c]) for c in columns]) for r in df.collect())
    assert got
    if name in core.ORACLES:
        found = duck.execute(core.ORACLES[name])
        names = [x[0] for x in found.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert got == sorted(repr([value(r[i]) for i in order]) for r in found.fetchall())


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
