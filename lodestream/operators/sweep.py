"""Intervals over a calendar without their days: what begins and ends is summed by day, and a running sum does the rest.

An interval costs two rows however long it lasts. The running sums go over days, whose number the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded(df: DataFrame, start: str, end: str, last: Column, first: Column | None = None) -> DataFrame:
    """``df`` with _begin and _stop, the first and last day of [start, end) from ``first`` up to and with ``last``; intervals without a day in reach vanish. An open end is null."""
    begin = F.to_date(start) if first is None else F.greatest(F.to_date(start), first)
    return df.withColumn("_begin", begin).withColumn("_stop", F.least(F.date_sub(F.to_date(end), 1), last)).filter("_begin <= _stop")


def islands(df: DataFrame, key: str) -> DataFrame:
    """(key, _begin, _stop): each key's intervals of days, with those that overlap or touch made one; rows without a key are left out."""
    w = Window.partitionBy(key).orderBy("_begin", "_stop")
    reach = F.max("_stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.datediff("_begin", reach) > 1, F.lit(True))
    numbered = df.filter(F.col(key).isNotNull()).withColumn("_reach_begins", begins.cast("int")).withColumn("_island", F.sum("_reach_begins").over(w))
    return numbered.groupBy(key, "_island").agg(F.min("_begin").alias("_begin"), F.max("_stop").alias("_stop")).drop("_island")


def edges(df: DataFrame, **amounts: Column) -> DataFrame:
    """(day, amounts): each interval's amounts on the day it begins, and less them on the day after its last."""
    both = F.explode(F.array(F.struct(F.col("_begin").alias("day"), F.lit(1).alias("sign")), F.struct(F.date_add("_stop", 1).alias("day"), F.lit(-1).alias("sign"))))
    signed = df.select(both.alias("_edge"), *(a.cast("long").alias(n) for n, a in amounts.items()))
    return signed.select("_edge.day", *((F.col(n) * F.col("_edge.sign")).alias(n) for n in amounts))


def running(deltas: list[DataFrame], day: str = "date_day") -> DataFrame:
    """(day, amounts): the sums of all amounts whose interval holds the day, for every day from the first beginning to the last end; exact, as whole numbers.

    Deltas are added up by day on the way to the shuffle. Amounts that one of ``deltas`` lacks count as zero there.
    """
    names = list(dict.fromkeys(c for d in deltas for c in d.columns if c != "day"))
    whole = None
    for d in deltas:
        d = d.select("day", *(F.col(n) if n in d.columns else F.lit(0).cast("long").alias(n) for n in names))
        whole = d if whole is None else whole.unionByName(d)
    by_day = whole.groupBy("day").agg(*(F.sum(n).alias(n) for n in names))
    w = Window.orderBy("day")
    sums = by_day.select("day", F.lead("day").over(w).alias("_next"), *(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names))
    days = F.explode(F.sequence("day", F.date_sub("_next", 1)))
    return sums.filter("_next is not null").select(days.alias(day), *names)
