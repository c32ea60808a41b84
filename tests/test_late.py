"""What comes late: versions, changes and touched keys, against building everything anew."""

import random
from datetime import datetime, timedelta

import pytest
from lodestream.operators import joins, scd2, touched
from lodestream.session import configured
from lodestream.sources.published import Published
from pyspark.sql import functions as F
from test_published import Killed, dies_at, rows_of

BASE = datetime(2024, 1, 1)


def log_rows(seed=1, n=160):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), BASE + timedelta(days=rng.randint(0, 60)), rng.choice("uuuud"), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_do_not_depend_on_the_order_of_batches(spark, tmp_path, seed):
    configured(spark)
    rows, rng = log_rows(seed), random.Random(seed + 10)
    df = lambda some: spark.createDataFrame(some, "k string, v string, at timestamp, _op string, n long")
    want = rows_of(scd2.versions_from_log(df(rows), "k", ["v"], "at", ["at", "n"]))
    rng.shuffle(rows)
    batches = [rows[k : k + 45] for k in range(0, len(rows), 40)]  # they overlap
    table, path = None, str(tmp_path / "v")
    for b in batches:
        table = scd2.merge_log(table, df(b), "k", ["v"], "at", ["at", "n"])
        table = spark.createDataFrame(table.collect(), table.schema)
        with pytest.raises(Killed):
            scd2.keep_versions(spark, path, df(b), "k", ["v"], "at", ["at", "n"], buckets=3, on_step=dies_at("point"))
        kept = scd2.keep_versions(spark, path, df(b), "k", ["v"], "at", ["at", "n"], buckets=3)
    assert rows_of(scd2.versions_of(table, "k", ["v"], "at")) == want
    assert rows_of(scd2.versions_of(kept, "k", ["v"], "at")) == want and kept.count() == len(rows)


def test_a_late_change_splits_a_version(spark):
    df = lambda *some: spark.createDataFrame(some, "k string, v string, at timestamp, _op string, n long")
    day = lambda d: BASE + timedelta(days=d)
    table = scd2.merge_log(None, df(("a", "x", day(0), "c", 1), ("a", "x", day(10), "u", 3), ("b", "x", day(0), "c", 1)), "k", ["v"], "at", ["n"])
    assert [tuple(r) for r in scd2.versions_of(table, "k", ["v"], "at").filter("k = 'a'").collect()] == [("a", "x", day(0), None)]
    table = scd2.merge_log(table, df(("a", "y", day(5), "u", 2)), "k", ["v"], "at", ["n"])
    got = sorted(tuple(r) for r in scd2.versions_of(table, "k", ["v"], "at").filter("k = 'a'").collect())
    assert got == [("a", "x", day(0), day(5)), ("a", "x", day(10), None), ("a", "y", day(5), day(10))]


def versions_of_keys(rng):
    out = []
    for k in ("x", "y", "z"):
        t = BASE + timedelta(days=rng.randint(0, 40))
        for n in range(12):
            end = t + timedelta(hours=rng.randint(1, 2000))
            gone = rng.random() < 0.2
            out.append((k, f"{k}{n}", t, None if n == 11 else t if gone else end))
            t = end + timedelta(hours=rng.choice([0, 0, 50]))
    return out


def facts_of(rng, n=300):
    at = lambda: rng.choice([BASE + timedelta(hours=rng.randint(-500, 20_000)), None])
    return [(i, rng.choice(["x", "y", "w", None]), at()) for i in range(n)]


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_the_carried_version_is_the_joined_one(spark, grain):
    rng = random.Random(3)
    facts = spark.createDataFrame(facts_of(rng), "i long, k string, t timestamp")
    rows = versions_of_keys(rng)
    versions = spark.createDataFrame(rows, "k string, n string, valid_from timestamp, valid_to timestamp").withColumn("_time", F.lit(1))
    for columns in (["n"], ["n", "valid_from", "valid_to"]):
        want = joins.asof_join(facts, versions, "k", "t", columns=columns, grain=grain)
        got = joins.asof_carry(facts, versions, "k", "t", columns=columns, grain=grain)
        assert got.columns == want.columns and rows_of(got) == rows_of(want)
    # Facts that lie on the moment a version begins or ends.
    edges = spark.createDataFrame([(n, k, t) for n, (k, _, a, b) in enumerate(rows) for t in (a, b)], "i long, k string, t timestamp")
    assert rows_of(joins.asof_carry(edges, versions, "k", "t", columns=["n"])) == rows_of(joins.asof_join(edges, versions, "k", "t", columns=["n"]))
    assert joins.asof_carry(facts, versions.limit(0), "k", "t", columns=["n"]).filter("n is null").count() == 300


def test_repair_touches_what_late_versions_change(spark):
    rng = random.Random(5)
    facts = spark.createDataFrame(facts_of(rng), "i long, k string, t timestamp")
    schema = "k string, n string, valid_from timestamp, valid_to timestamp"
    rows = versions_of_keys(rng)
    new = spark.createDataFrame(rows, schema)
    old = spark.createDataFrame([r for i, r in enumerate(rows) if i % 4], schema)
    fact = joins.asof_join(facts, old, "k", "t", columns=["n"])
    fixed = joins.asof_repair(fact, old, new, "k", "t", columns=["n"])
    touched_ids = {r["i"] for r in fixed.collect()}
    whole = rows_of(fact.filter(~F.col("i").isin(list(touched_ids))).unionByName(fixed))
    assert whole == rows_of(joins.asof_join(facts, new, "k", "t", columns=["n"]))
    assert 0 < len(touched_ids) < 150
    assert joins.asof_repair(fact, old, old, "k", "t", columns=["n"]).count() == 0


def test_a_fact_follows_its_feed(spark, tmp_path):
    """Only touched keys' partitions are replaced, a key without rows leaves, and a run that ends early takes its batches again."""
    feed, path = str(tmp_path / "feed"), str(tmp_path / "fact")
    source = {"a": ("2025-01", 1), "b": ("2025-02", 1), "c": ("2025-03", 1)}
    df = lambda: spark.createDataFrame([(k, m, v) for k, (m, v) in source.items()], "k string, month string, v int")
    built = []

    def build(rows):
        built.append(sorted(r["k"] for r in rows.collect()))
        return rows

    run = lambda hear=None: touched.follow(spark, path, feed, df, build, "k", "month", on_step=hear)
    keys = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    touched.write_keys(keys("a", "b", "c"), feed, 0)
    run()
    assert built == [["a", "b", "c"]] and run().count() == 3 and len(built) == 1
    source["a"] = ("2025-02", 2)
    del source["c"]
    touched.write_keys(keys("a"), feed, 1)
    touched.write_keys(keys("c", "a"), feed, 3)
    untouched = set(Published(spark, path).files({("2025-02",)}))
    for step in ("write", "point"):
        with pytest.raises(Killed):
            run(dies_at(step))
    assert rows_of(run()) == rows_of(df()) and built[1:] == [["a"]] * 3
    assert not untouched & set(Published(spark, path).files())
    before = set(Published(spark, path).files({("2025-02",)}))
    source["d"] = ("2025-05", 4)
    touched.write_keys(keys("d"), feed, 4)
    touched.write_keys(keys("d"), feed, 4)
    assert rows_of(run()) == rows_of(df()) and set(Published(spark, path).files({("2025-02",)})) == before
    assert touched.complete_batches(spark, feed, 1) == [3, 4] and Published(spark, path).notes == {touched.APPLIED: 4}
