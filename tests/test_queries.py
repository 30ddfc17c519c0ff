"""Each query of the engine against its oracle SQL on the smallest tables."""

import duckdb
import pytest

from inuring.plans.queries import ORACLE_SQL, QUERIES
from inuring.sources.tables import RAW

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def plain(value):
    return "" if value is None else repr(round(value + 0.0, 6)) if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    have = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = oracle.execute(ORACLE_SQL[name])
    named = {d[0]: (k, str(d[1])) for k, d in enumerate(result.description)}
    assert sorted(named) == columns
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == {c: t for c, (_, t) in named.items()}
    assert have == sorted(tuple(plain(row[named[c][0]]) for c in columns) for row in result.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
