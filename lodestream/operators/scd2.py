"""Slowly changing dimensions: one row for each version of a key, with half-open validity and an open end that is null."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.scalars import surrogate_key
from lodestream.operators.windows import distinct_over
from lodestream.sources.published import Published, key_values

FOREVER = "9999-12-31 23:59:59"


def snapshot(history: DataFrame | None, current: DataFrame, key: str, updated_at: str, run_as_of, close_missing: bool = True) -> DataFrame:
    """The history after one more look at ``current`` (one row a key): versions whose ``updated_at`` advanced are closed
    where the new ones begin, new keys open one, and keys that vanished are closed at ``run_as_of`` if ``close_missing``.

    Looking twice at the same state changes nothing. Columns of versions are those of ``current`` with valid_from, valid_to.
    """
    fresh = current.withColumn("valid_from", F.col(updated_at)).withColumn("valid_to", F.lit(None).cast("timestamp"))
    if history is None:
        return fresh
    open_ = history.filter("valid_to is null")
    now = current.select(F.col(key).alias("_key"), F.col(updated_at).alias("_now"))
    met = open_.join(now, F.col(key) == F.col("_key"), "left")
    newer = F.col("_now") > F.col(updated_at)
    gone = F.col("_key").isNull() if close_missing else F.lit(False)
    ended = F.when(newer, F.col("_now")).when(gone, F.lit(run_as_of).cast("timestamp")).otherwise(F.col("valid_to"))
    kept = met.withColumn("valid_to", ended).drop("_key", "_now")
    seen = open_.select(F.col(key).alias("_key"), F.col(updated_at).alias("_seen"))
    opened = fresh.join(seen, F.col(key) == F.col("_key"), "left").filter("_seen is null or _seen < valid_from").drop("_key", "_seen")
    return history.filter("valid_to is not null").unionByName(kept).unionByName(opened)


def versions_from_log(log: DataFrame, key: str, attributes: list[str], at: str, order: list) -> DataFrame:
    """Every version that a change log holds: rows in ``order``, those that change no attribute left out.

    Unlike snapshots it misses no state between two looks. A delete row ends its key's last version and opens none.
    """
    w = Window.partitionBy(key).orderBy(*order)
    state = F.struct(F.col("_op") == "d", *(F.col(a) for a in attributes))
    changed = log.withColumn("_state", state).withColumn("_before", F.lag("_state").over(w)).filter(F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before")))
    ended = changed.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.lead(at).over(w))
    return ended.filter(F.col("_op") != "d").select(key, *attributes, "valid_from", "valid_to")


def dimension(versions: DataFrame, key: str, created_at: str, relocation: str, run_as_of) -> DataFrame:
    """The dimension over versions: the first is dated back to creation, ends are also given as a far date, and each row
    knows its number, the total, whether the key ever changed ``relocation``, and its days."""
    by = Window.partitionBy(key)
    number = F.row_number().over(by.orderBy("valid_from"))
    begun = versions.withColumn("_from", F.col("valid_from")).withColumn("version_number", number)
    return (
        begun.withColumn("customer_key", surrogate_key(F.col(key), F.col("_from")))
        .withColumn("valid_from", F.when(F.col("version_number") == 1, F.least("_from", created_at)).otherwise(F.col("_from")))
        .withColumn("valid_to_or_infinity", F.coalesce("valid_to", F.lit(FOREVER).cast("timestamp")))
        .withColumn("is_current", F.col("valid_to").isNull())
        .withColumn("total_versions", F.count("*").over(by))
        .withColumn("has_relocated", distinct_over(relocation, key) > 1)
        .withColumn("version_duration_days", F.datediff(F.coalesce("valid_to", F.lit(run_as_of).cast("timestamp")), "valid_from"))
        .drop("_from")
    )


#: Of a log row kept in a version table: whether it begins a version, and where that one ends.
BEGINS, UNTIL = "_begins", "valid_to"


def merge_log(stored: DataFrame | None, batch: DataFrame, key: str, attributes: list[str], at: str, order: list[str]) -> DataFrame:
    """The version table after one more batch of log rows, in whatever order batches come.

    The table holds every log row once: ``key``, ``attributes``, ``at``, ``_op``, the columns ``order``, which tell a key's
    rows apart, and whether the row begins a version and until when it holds. A late change splits the version that it falls
    into: that one ends where the change begins, and a row that only confirmed the old state begins a version of its own if
    the change came between. Rows of keys that the batch does not name pass through as they are. A row that is delivered
    again, by key and order, counts once. Keys may be null.
    """
    columns = list(dict.fromkeys([key, *attributes, at, "_op", *order]))
    new = batch.select(*columns).dropDuplicates([key, *order])
    if stored is None:
        return _begun(new, key, attributes, at, order)
    keys = new.select(F.col(key).alias("_key")).distinct()
    same = F.col(key).eqNullSafe(F.col("_key"))
    met = stored.join(keys, same, "left_semi").select(*columns)
    both = met.withColumn("_known", F.lit(0)).unionByName(new.withColumn("_known", F.lit(1)))
    once = both.groupBy(*dict.fromkeys([key, *order])).agg(F.min_by(F.struct(*columns), "_known").alias("_row")).select("_row.*")
    return stored.join(keys, same, "left_anti").unionByName(_begun(once, key, attributes, at, order))


def _begun(rows: DataFrame, key: str, attributes: list[str], at: str, order: list[str]) -> DataFrame:
    w = Window.partitionBy(key)
    state = F.struct(F.col("_op") == "d", *(F.col(a) for a in attributes))
    told = rows.withColumn("_state", state).withColumn("_before", F.lag("_state").over(w.orderBy(*order)))
    told = told.withColumn(BEGINS, F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before"))).drop("_state", "_before")
    # Read backwards, the last beginning before a row is where its version ends.
    later = w.orderBy(*(F.col(c).desc() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    end = F.last(F.when(F.col(BEGINS), F.col(at)), ignorenulls=True).over(later)
    return told.withColumn(UNTIL, F.when(F.col(BEGINS), end))


def versions_of(table: DataFrame, key: str, attributes: list[str], at: str) -> DataFrame:
    """The versions that a table of :func:`merge_log` holds, as :func:`versions_from_log` gives them."""
    return table.filter(F.col(BEGINS) & (F.col("_op") != "d")).select(key, *attributes, F.col(at).alias("valid_from"), UNTIL)


def keep_versions(spark, path: str, batch: DataFrame, key: str, attributes: list[str], at: str, order: list[str], buckets: int = 64, on_step=None) -> DataFrame:
    """:func:`merge_log` into the table at ``path``, laid out in ``buckets`` of the key's hash: only those that the batch's keys fall into are read and replaced.

    The table changes in one step, so a batch that ends anywhere is run again without harm. ``buckets`` counts for a new table.
    """
    table = Published(spark, path, ["_bucket"])
    n = table.notes.get("buckets", buckets)
    placed = batch.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).persist()
    try:
        touched = key_values(placed, ["_bucket"])
        if touched:
            stored = table.read(touched).drop("_bucket") if table.exists and table.notes else None
            merged = merge_log(stored, placed, key, attributes, at, order).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
            table.replace(merged.repartition("_bucket"), touched, notes={"buckets": n}, on_step=on_step)
    finally:
        placed.unpersist()
    return table.read()
