"""Every registered query with a SQL twin against DuckDB over the same Parquet files."""

import datetime

import __spark_entry__ as entry
import duckdb
import pytest
from lodestream.plans import queries as commerce

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def duck(smallest):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{smallest}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(commerce.ORACLE_SQL))
def test_query_matches_sql(spark, smallest, duck, name):
    ours = commerce.QUERIES[name](spark, smallest)
    theirs = duck.sql(commerce.ORACLE_SQL[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.columns, [tuple(r) for r in ours.collect()]) == rows(theirs.columns, theirs.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 1000


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_of_this_part_has_a_twin():
    assert set(commerce.ORACLE_SQL) == set(commerce.QUERIES)
