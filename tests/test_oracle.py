"""Every query against its SQL on the smallest of the given tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(repr(tuple(row[c] for c in columns)) for row in df.collect())
    answer = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == Counter(repr(tuple(row[i] for i in at)) for row in answer.fetchall())
    assert got


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 6000


def test_every_query_is_registered_once():
    assert set(entry.oracle_sql()) <= set(entry.queries())
