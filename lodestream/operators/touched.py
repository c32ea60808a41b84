"""Facts that follow a stream by the keys it touches, instead of looking back over days of ingestion.

Each micro-batch leaves the keys of its rows in a feed. A fact's run takes the batches it has not applied yet, builds the
rows of their keys anew from all source rows of those keys, and replaces only the partitions in which they lie or will lie.
How far the feed is applied is published together with the rows, so a run that ends anywhere neither skips nor repeats a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators.incremental import exists, merge
from lodestream.sources.published import Published

#: The note of a fact's table that says up to which batch of its feed it has come.
APPLIED = "applied_through"


def write_keys(keys: DataFrame, feed: str, batch: int) -> None:
    """Leave a micro-batch's keys in the feed. A batch that is run again holds the same keys: what is complete stays as it is."""
    path = f"{feed.rstrip('/')}/batch={batch}"
    if not exists(keys.sparkSession, f"{path}/_SUCCESS"):
        keys.distinct().write.mode("overwrite").parquet(path)


def complete_batches(spark: SparkSession, feed: str, after: int = -1) -> list[int]:
    """Numbers of the feed's complete batches beyond ``after``. A stream completes its batches in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{feed.rstrip('/')}/batch=*/_SUCCESS")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    numbers = (int(re.fullmatch(r"batch=(\d+)", f.getPath().getParent().getName())[1]) for f in found or ())
    return sorted(n for n in numbers if n > after)


def touched_keys(spark: SparkSession, feed: str, batches: list[int]) -> DataFrame:
    return spark.read.parquet(*(f"{feed.rstrip('/')}/batch={n}" for n in batches)).distinct()


def follow(
    spark: SparkSession,
    path: str,
    feed: str,
    source: Callable[[], DataFrame],
    build: Callable[[DataFrame], DataFrame],
    key: str,
    partition_by: str,
    fact_key: str | None = None,
    on_step: Callable[[str], None] | None = None,
) -> DataFrame:
    """Bring the fact at ``path`` up to its feed and return it.

    ``source`` gives the rows to build from, read after the feed so that it holds all that the feed names; ``build`` makes
    the fact's rows of all source rows of some keys. The first run builds everything. A touched key for which ``build``
    gives no row leaves the fact. ``fact_key`` is the key's name in the fact if it has another one. Keys that are null
    are a key like any other. A feed belongs to one stream and its checkpoint, whose batches are numbered from 0.
    """
    table, name = Published(spark, path, [partition_by]), fact_key or key
    through = table.notes.get(APPLIED)
    batches = complete_batches(spark, feed, -1 if through is None else through)
    if through is None:
        table.replace(build(source()).repartition(partition_by), None, notes={APPLIED: max(batches, default=-1)}, on_step=on_step)
    elif batches:
        keys = touched_keys(spark, feed, batches).select(F.col(key).alias("_key"))
        rows = source()
        own = rows.join(keys, rows[key].eqNullSafe(keys["_key"]), "left_semi")
        merge(table, build(own), name, keys.select(F.col("_key").alias(name)), {**table.notes, APPLIED: batches[-1]}, on_step=on_step)
    return table.read()
