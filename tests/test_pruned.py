"""Lookups that open only what they need: the key index of facts, the stored timeline, counts kept by the writer."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from lodestream.operators import incremental
from lodestream.operators.key_index import KeyIndex
from lodestream.plans import serving
from lodestream.plans import stored_timeline as S
from lodestream.session import configured
from lodestream.sources import sinks
from lodestream.sources.published import STEPS, Published
from lodestream.streaming import ingest as I
from pyspark.sql import functions as F
from test_ingest import event, records, table  # noqa: F401
from test_operators import batch
from test_published import Killed, dies_at, rows_of


@pytest.mark.parametrize("step", [None, *STEPS])
def test_an_indexed_load_is_a_load(spark, tmp_path, step):
    """Batches that move, add and repeat keys, nulls included; runs that end anywhere, also between index and fact."""
    rng = random.Random(1)
    path, plain = str(tmp_path / "fct"), str(tmp_path / "plain")
    key = lambda: rng.choice([None, *range(40)])
    rows = lambda n: spark.createDataFrame(list({k: (k, rng.choice([None, "a", "b", "c"]), rng.randint(0, 9)) for k in (key() for _ in range(n))}.values()), "k int, p string, v int")
    for n in (30, 8, 1, 12):
        some = rows(n)
        if step is not None and n != 30:
            with pytest.raises(Killed):
                incremental.load(spark, path, lambda t: some, "k", partition_by="p", indexed=True, on_step=dies_at(step))  # noqa: B023
        got = incremental.load(spark, path, lambda t: some, "k", partition_by="p", indexed=True)  # noqa: B023
        want = incremental.load(spark, plain, lambda t: some, "k", partition_by="p")  # noqa: B023
        assert rows_of(got) == rows_of(want)
        where = Counter((r["k"], r["p"]) for r in KeyIndex(spark, path, ["k"], ["p"]).table.read().collect())
        assert where == Counter((r["k"], r["p"]) for r in got.collect())


def test_a_lookup_opens_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "fct")
    df = spark.range(2000).select("id", (F.col("id") % 9).alias("p"))
    incremental.load(spark, path, lambda t: df, "id", "full", partition_by="p", indexed=True)
    index = KeyIndex(spark, path, ["id"], ["p"])
    met, touched = index.lookup(df.filter("id in (3, 77)"))
    assert sorted(map(tuple, met.collect())) == [(3, 3), (77, 5)] and len(touched) <= 2
    assert len(index.table.read(touched).inputFiles()) <= 2 < len(index.table.read().inputFiles())
    # A table that was stored without an index gets one.
    other = str(tmp_path / "old")
    incremental.load(spark, other, lambda t: df, "id", "full", partition_by="p")
    out = incremental.load(spark, other, lambda t: spark.createDataFrame([(3, 8)], "id long, p long"), "id", partition_by="p", indexed=True)
    assert out.count() == 2000 and out.filter("id = 3 and p = 8").count() == 1


def test_pages_of_the_stored_timeline(spark, tmp_path):
    path, rng, base = str(tmp_path / "t"), random.Random(2), datetime(2024, 1, 1)
    rows = [(rng.choice([1, 2, 3, None]), base + timedelta(days=rng.randint(0, 900)), "order", "x", str(i), i, "USD", None) for i in range(300)]
    events = spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} {t}" for c, t in zip(serving.TIMELINE, ("timestamp", "string", "string", "string", "long", "string", "string"), strict=True)))
    S.store_timeline(spark, path, events.filter("amount_cents < 150"), buckets=8)
    S.update_timeline(spark, path, events.filter("customer_id = 2 or customer_id is null"), events)
    for customer, own in ((2, events), (1, events.filter("amount_cents < 150"))):
        cursor = None
        for _ in range(3):
            want = serving.timeline_page(own, customer, 10, cursor).collect()
            assert S.stored_page(spark, path, customer, 10, cursor).collect() == want
            last = min(want, key=lambda r: (r["occurred_at"], r["reference_id"]))
            cursor = (last["occurred_at"], last["reference_id"])
    whole = Published(spark, path, ["_bucket"])
    assert len(S.stored_events(spark, path, 2).inputFiles()) < len(whole.read().inputFiles())
    assert whole.read().count() == events.filter("amount_cents < 150 or customer_id = 2 or customer_id is null").count()


def test_counts_kept_by_the_writer(spark, tmp_path):
    configured(spark)
    path = str(tmp_path / "raw")
    sinks.write_batch(batch(spark, 200), path)
    sinks.write_batch(batch(spark, 120, 150), path)
    assert rows_of(sinks.kept_by_op(spark, path)) == rows_of(I.records_by_op(sinks.read_table(spark, path)).drop("last_flush"))
    sinks.drop_day(spark, path, "2025-03-01")
    assert rows_of(sinks.kept_by_op(spark, path)) == rows_of(I.records_by_op(sinks.read_table(spark, path)).drop("last_flush"))


def test_what_is_observed_of_a_batch_is_kept_once(spark, table):  # noqa: F811
    handle, rows, _, root = table
    first = records(spark, event({"id": 1, "amount": 5, "note": "a"}), event({"id": 1}, "d"), None, "{")
    handle(first)
    handle(first)
    handle(records(spark, event({"id": 2, "amount": 5, "note": "a"}, "u"), first=9))
    seen = sinks.read_metrics(spark, f"{root}/_metrics/t")
    assert sorted((r["records"], r["c"], r["u"], r["d"], r["r"]) for r in seen.collect()) == [(1, 0, 1, 0, 0), (2, 1, 0, 1, 0)]
    assert rows_of(sinks.kept_by_op(spark, f"{root}/t")) == Counter([("c", 1), ("d", 1), ("u", 1)])
    assert sinks.read_metrics(spark, f"{root}/none").count() == 0
