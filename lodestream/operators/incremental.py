"""Incremental loads that late arrivals cannot escape, and keyed upserts into Parquet tables.

There is no append mode: a lookback selects rows again on purpose, so only an upsert keeps a table free of duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators.key_index import KeyIndex
from lodestream.sources.published import Published, key_values

#: Days of ingestion that an incremental run reads again.
LOOKBACK_DAYS = 21


def lookback(df: DataFrame, target: DataFrame | None, column: str = "_ingested_at", days: int = LOOKBACK_DAYS, partition: str | None = None) -> DataFrame:
    """Rows ingested after the target's newest less ``days``; all rows on the first run or over an empty target.

    The bound is a literal, so it reaches the scan as a pushed filter; ``partition`` names a date column of the layout
    that follows ``column``, and gets the same bound, which prunes directories.
    """
    if target is None:
        return df
    newest = target.agg(F.max(column)).first()[0]
    if newest is None:
        return df
    bound = F.lit(newest) - F.expr(f"interval {days} days")
    out = df.filter(F.col(column) > bound)
    return out if partition is None else out.filter(F.col(partition) >= F.to_date(bound))


def upsert(target: DataFrame | None, batch: DataFrame, key: str | list[str], deleted_keys: DataFrame | None = None) -> DataFrame:
    """The target without the batch's keys (and without ``deleted_keys``), and the batch. Keys are compared null-safe."""
    keys = [key] if isinstance(key, str) else key
    if target is None:
        return batch
    gone = batch.select(*keys) if deleted_keys is None else batch.select(*keys).union(deleted_keys.select(*keys))
    gone = gone.select(*(F.col(k).alias(f"_k_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return target.join(gone, same, "left_anti").unionByName(batch, allowMissingColumns=True)


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at(path))


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def restored(spark: SparkSession, path: str) -> bool:
    """Whether a table lies at ``path``, after undoing a swap of folders that ended halfway; tables were once put in place so."""
    at, fs = _fs(spark, path)
    old = at(f"{path.rstrip('/')}.old")
    if not fs.exists(at(path)) and fs.exists(old):
        fs.rename(old, at(path))
    return fs.exists(at(path))


def load(
    spark: SparkSession,
    path: str,
    build: Callable[[DataFrame | None], DataFrame],
    key: str | list[str],
    mode: str = "incremental",
    partition_by: str | None = None,
    keep: int = 0,
    on_step: Callable[[str], None] | None = None,
    indexed: bool = False,
) -> DataFrame:
    """Build a fact and store it at ``path``: anew with mode 'full', else by upsert.

    ``build`` gets the stored table, or None, and returns the rows to put in; it applies :func:`lookback` itself. With
    ``partition_by``, a column of days or months say, an incremental run reads and writes only the partitions in which the
    batch's keys lie or will lie: it looks keys up in two columns of the table, and no other partition is opened for its
    rows. The table changes in one step (see :meth:`Published.replace`, also for ``keep`` and ``on_step``), so a run that
    ends anywhere and is repeated gives the same table. Null partition values are a partition like any other. With
    ``indexed`` the keys are looked up in a :class:`KeyIndex` beside the table, of which only the batch's buckets are read.
    """
    if mode not in ("full", "incremental"):
        raise ValueError("mode is 'full' or 'incremental'; append with a lookback would duplicate rows")
    there = restored(spark, path)
    table = Published(spark, path, [partition_by] if partition_by else [])
    target = table.read() if mode == "incremental" and there and table.exists else None
    keys = [key] if isinstance(key, str) else key
    index = KeyIndex(spark, path, keys, table.by) if indexed and partition_by is not None else None
    if target is None or partition_by is None:
        rows = upsert(target, build(target), key)
        if index is not None and index.ready:
            index.widen(rows)
        # By partition, as in merge: else every task would leave a file in every partition.
        table.replace(rows if partition_by is None else rows.repartition(partition_by), None, keep=keep, on_step=on_step)
        if index is not None:
            index.rebuild(table.read())
        return table.read()
    if index is not None and not index.ready:
        index.rebuild(target)
    merge(table, build(target), key, keep=keep, on_step=on_step, index=index)
    return table.read()


def merge(
    table: Published,
    batch: DataFrame,
    key: str | list[str],
    deleted_keys: DataFrame | None = None,
    notes: dict | None = None,
    keep: int = 0,
    on_step: Callable[[str], None] | None = None,
    index: KeyIndex | None = None,
) -> None:
    """Upsert ``batch`` into a stored table, replacing only the partitions in which its keys, or ``deleted_keys``, lie or will lie.

    They are looked up in ``index`` if there is one, else in the table's key and partition columns.
    """
    target, keys = table.read(), [key] if isinstance(key, str) else key
    columns = [*target.columns, *(c for c in batch.columns if c not in target.columns)]
    batch = batch.withColumns({c: F.col(c).cast(target.schema[c].dataType) for c in table.by})
    # Built once: keys are looked up first, rows written after.
    batch = batch.persist(StorageLevel.DISK_ONLY)
    try:
        wanted = batch.select(*keys) if deleted_keys is None else batch.select(*keys).union(deleted_keys.select(*keys))
        if index is not None:
            met, _ = index.lookup(wanted)
        else:
            asked = wanted.select(*(F.col(k).alias(f"_k_{k}") for k in keys)).distinct()
            met = target.select(*keys, *table.by).join(asked, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_semi")
        touched = key_values(met.select(*table.by).union(batch.select(*table.by)), table.by)
        if touched:
            if index is not None:
                index.widen(batch)
            result = upsert(table.read(touched), batch, key, deleted_keys).select(*columns)
            table.replace(result.repartition(*table.by), touched, notes=notes, keep=keep, on_step=on_step)
            if index is not None:
                index.settle(batch, wanted)
        elif notes is not None:
            table.note(notes)
    finally:
        batch.unpersist()


def child_recency(own: Column, child: Column) -> Column:
    """A parent's ingestion time counts the newest child's: a late child makes the parent new."""
    return F.greatest(own, F.coalesce(child, own))


def touched_rebuild(target: DataFrame, touched: DataFrame, source: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The target with the rows of the touched keys built anew from all of their source rows; a key without any goes."""
    keys = touched.select(key).distinct()
    fresh = build(source.join(keys, key, "left_semi"))
    return upsert(target, fresh, key, deleted_keys=keys)


def fingerprint(df: DataFrame, by: list[str], columns: list[str] | None = None, portable: bool = False) -> DataFrame:
    """(by, rows, fingerprint): equal for equal rows in any order; the sum of row hashes counts repeats.

    The hash is Spark's 64-bit one, or with ``portable`` the first 32 bits of an md5 over the columns by name, joined by
    ``|``, which other engines have too.
    """
    cols = sorted(columns or [c for c in df.columns if c not in by])
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("_null_")) for c in cols]
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10) if portable else F.xxhash64(*text)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("fingerprint"))


def backfill(target: DataFrame, build: Callable[[], DataFrame], day: str, first: str, last: str) -> DataFrame:
    """The target with the days from ``first`` to ``last`` replaced by what ``build`` gives for them."""
    inside = F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return target.filter(~inside | F.col(day).isNull()).unionByName(build().filter(inside))
