"""Sweeps and bitmaps against days one by one."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from lodestream.operators import bitmaps, sweep
from pyspark.sql import functions as F
from test_published import rows_of

BASE, LAST = datetime(2024, 1, 1), date(2024, 6, 30)


def intervals(seed, n=120):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a = BASE + timedelta(hours=rng.randint(0, 4000))
        out.append((rng.choice(["a", "b", "c", None]), rng.randint(0, 5), a, rng.choice([None, a, a + timedelta(hours=rng.randint(1, 900))])))
    return out


def days_of(a, b):
    d, stop = a.date(), LAST if b is None else min(b.date() - timedelta(days=1), LAST)
    while d <= stop:
        yield d
        d += timedelta(days=1)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("n", [0, 1, 120])
def test_running_sums_are_those_of_every_day(spark, seed, n):
    rows = intervals(seed, n)
    df = sweep.bounded(spark.createDataFrame(rows, "k string, v long, s timestamp, e timestamp"), "s", "e", F.lit(LAST))
    out = sweep.running([sweep.edges(df, total=F.col("v"), n=F.lit(1)), sweep.edges(sweep.islands(df, "k"), keys=F.lit(1))])
    total, count, keys = Counter(), Counter(), defaultdict(set)
    for k, v, a, b in rows:
        for d in days_of(a, b):
            total[d] += v
            count[d] += 1
            if k is not None:
                keys[d].add(k)
    got = {r["date_day"]: (r["total"], r["n"], r["keys"]) for r in out.collect()}
    assert {d: x for d, x in got.items() if x[1]} == {d: (total[d], count[d], len(keys[d])) for d in count}
    assert all(x == (0, 0, 0) for d, x in got.items() if d not in count)


def test_islands_join_what_touches(spark):
    day = lambda n: date(2024, 1, n)
    rows = [("a", day(1), day(3)), ("a", day(4), day(5)), ("a", day(2), day(2)), ("a", day(8), day(9)), ("b", day(4), day(4)), (None, day(1), day(2))]
    out = sweep.islands(spark.createDataFrame(rows, "k string, _begin date, _stop date"), "k")
    assert sorted(map(tuple, out.collect())) == [("a", day(1), day(5)), ("a", day(8), day(9)), ("b", day(4), day(4))]


def test_masks_hold_every_number_of_an_interval(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), a, a + rng.choice([-1, 0, 1, 5, 61, 62, 63, 400])) for a in (rng.randint(0, 500) for _ in range(60))]
    df = bitmaps.interval_mask(spark.createDataFrame(rows, "k string, a int, b int"), F.col("a"), F.col("b"))
    got = rows_of(bitmaps.numbers(bitmaps.masks(df, "k"), "m").select("k", "m"))
    want = {(k, m) for k, a, b in rows for m in range(a, b + 1)}
    assert got == Counter(want)


def test_bitmaps_count_exactly_at_every_grain(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 20), rng.choice([None, rng.randint(-5, 100_000), rng.randint(0, 50), 2**40])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "day int, c long")
    fine = bitmaps.distinct_bitmaps(df, ["day"], "c")
    coarse = bitmaps.rolled_up(fine, F.floor(F.col("day") / 7).cast("int").alias("week"))
    of = lambda grain: Counter((g, len({c for d, c in rows if d // grain == g and c is not None})) for g in {d // grain for d, c in rows if c is not None})
    assert Counter(tuple(r) for r in bitmaps.distinct_counts(fine, ["day"]).collect()) == of(1)
    assert Counter(tuple(r) for r in bitmaps.distinct_counts(coarse, ["week"]).collect()) == of(7)
    assert bitmaps.distinct_counts(bitmaps.distinct_bitmaps(df.limit(0), ["day"], "c"), ["day"]).count() == 0
