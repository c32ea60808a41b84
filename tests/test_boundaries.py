"""Orders about the first month, month ends and clock changes, in every zone: the queries against their SQL."""

import datetime

import duckdb
import pytest
from lodestream.operators import incremental
from lodestream.operators.joins import asof_join
from lodestream.plans import queries as commerce
from lodestream.sources.published import Published
from test_queries import TABLES, rows

DAYS = ("1995-01-01", "1995-01-31", "1999-10-31", "2000-03-26", "2000-04-02", "2001-10-28", "1996-11-01", "1996-11-30")


@pytest.fixture(scope="module")
def bounds(smallest, tmp_path_factory):
    """The smallest tables with other customers and orders: each nation, hour and day with wall-clock text."""
    out = tmp_path_factory.mktemp("bounds")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"copy (select * from '{smallest}/{t}.parquet') to '{out}/{t}.parquet'")
    con.sql(f"copy (select * replace (c_custkey % 4 as c_nationkey) from '{smallest}/customer.parquet' where c_custkey < 8) to '{out}/customer.parquet'")
    con.sql(
        f"""copy (select k as o_orderkey, k // 8 % 8 as o_custkey, ['O', 'F', 'P'][1 + k % 3] as o_orderstatus, 1000.5 + k as o_totalprice,
          cast({list(DAYS)}[1 + k // 64 % {len(DAYS)}] as timestamp) as o_orderdate, '1-URGENT' as o_orderpriority from range(0, 60000) t(k)) to '{out}/orders.parquet'"""
    )
    return str(out)


@pytest.mark.parametrize("name", ["dq_missing_fx_rate", "fx_to_usd", "order_facts", "payment_facts", "resolve_local_time", "dq_future_dated"])
def test_orders_at_bounds_match_sql(spark, bounds, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{bounds}/{t}.parquet'")
    ours, theirs = commerce.QUERIES[name](spark, bounds), con.sql(commerce.ORACLE_SQL[name])
    assert rows(ours.columns, [tuple(r) for r in ours.collect()]) == rows(theirs.columns, theirs.fetchall())


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_asof_join_repeats_versions_by_year(spark, smallest):
    plan = _plan(commerce.QUERIES["asof_join"](spark, smallest))
    # No month is numbered: a version is repeated for each year that it touches only.
    assert "year(" in plan and "month(" not in plan
    assert "strategy=merge" in plan


def test_asof_join_with_a_known_last_moment(spark):
    at = datetime.datetime
    versions = spark.createDataFrame([(1, at(2020, 1, 31), at(2020, 3, 1), "a"), (1, at(2020, 3, 1), at(2022, 1, 1), "b"), (1, at(2022, 1, 1), None, "c"), (2, at(2021, 5, 1), None, "d")], "k int, valid_from timestamp, valid_to timestamp, v string")
    facts = spark.createDataFrame([(n, k, at(2019 + n // 12, n % 12 + 1, 1)) for n in range(60) for k in (1, 2, 3)], "n int, k int, at timestamp")
    want = sorted(asof_join(facts, versions, "k", "at", columns=["v"]).collect(), key=str)
    for grain in ("day", "month", "year"):
        for last in (None, at(2022, 1, 1), at(2030, 1, 1)):
            assert sorted(asof_join(facts, versions, "k", "at", columns=["v"], grain=grain, last=last).collect(), key=str) == want


def test_asof_repaired_reads_stored_tables(spark, smallest):
    # As one plan it joined 15 times, and broadcasts of all joins at once filled the driver.
    out = commerce.QUERIES["asof_repaired"](spark, smallest)
    plan = _plan(out)
    assert plan.count("Join ") <= 7
    assert "fact" in str(out.inputFiles())


def test_a_full_load_leaves_one_file_a_partition(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).selectExpr("id as k", "cast(id % 5 as string) as month")
    incremental.load(spark, f"{tmp_path}/fact", lambda target: rows, "k", "full", partition_by="month")
    assert len(Published(spark, f"{tmp_path}/fact").files()) == 5
