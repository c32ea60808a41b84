"""Exact distinct counts by bitmaps, which merge where counts do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one word of a mask: the sign bit stays free.
WORD = 62


def interval_mask(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """``df`` with _word and _mask: the numbers from ``first`` to ``last`` as bits of a long each WORD numbers; one row for each word, not for each number."""
    spans = df.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).filter("_first <= _last")
    words = spans.withColumn("_word", F.explode(F.sequence(F.floor(F.col("_first") / WORD), F.floor(F.col("_last") / WORD))))
    low = F.greatest(F.col("_first") - F.col("_word") * WORD, F.lit(0)).cast("int")
    high = F.least(F.col("_last") - F.col("_word") * WORD, F.lit(WORD - 1)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), high + 1) - F.call_function("shiftleft", F.lit(1).cast("long"), low)
    return words.withColumn("_mask", mask).drop("_first", "_last")


def masks(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, _word, _mask): the union of each key's masks; tasks unite their own rows before the shuffle."""
    return df.groupBy(*keys, "_word").agg(F.bit_or("_mask").alias("_mask"))


def numbers(df: DataFrame, alias: str) -> DataFrame:
    """One row for each bit of ``_mask``, with its number."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.expr("1L").bitwiseAND(F.call_function("shiftright", F.col("_mask"), b)) == 1)
    return df.withColumn("_bit", F.explode(bits)).withColumn(alias, F.col("_word") * WORD + F.col("_bit")).drop("_word", "_mask", "_bit")


def distinct_bitmaps(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(by, bucket, bitmap) of the distinct values of a whole-number column; nulls are left out.

    A bitmap holds one bucket of 32,768 values in 4 KB, so this is for keys that are numbered densely; rows of one group
    are spread over the buckets of their values.
    """
    some = df.filter(F.col(column).isNotNull()).select(*by, F.bitmap_bucket_number(column).alias("bucket"), F.bitmap_bit_position(column).alias("_position"))
    return some.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_position").alias("bitmap"))


def rolled_up(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """(by, bucket, bitmap) at a coarser grain: no row of the data is read again."""
    names = [F.col(c) if isinstance(c, str) else c for c in by]
    return bitmaps.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, by: list[str], alias: str = "n_distinct") -> DataFrame:
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(alias))
