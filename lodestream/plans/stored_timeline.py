"""The customer timeline laid out for its reader: a page opens one bucket of customers and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.plans.serving import timeline_page
from lodestream.sources.published import Published, key_values

_BUCKET = "_bucket"


def _placed(events: DataFrame, buckets: int) -> DataFrame:
    # By year as well, so that a customer with very many events is no single task; within a file in the order of pages.
    rows = events.withColumn(_BUCKET, F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int"))
    return rows.repartition(F.col(_BUCKET), F.year("occurred_at")).sortWithinPartitions(_BUCKET, "customer_id", F.col("occurred_at").desc())


def store_timeline(spark: SparkSession, path: str, events: DataFrame, buckets: int = 256) -> None:
    """Store the events of :func:`lodestream.plans.serving.timeline` anew, in ``buckets`` of their customers' hash."""
    Published(spark, path, [_BUCKET]).replace(_placed(events, buckets), None, notes={"buckets": buckets})


def update_timeline(spark: SparkSession, path: str, customers: DataFrame, events: DataFrame) -> None:
    """Replace the events of ``customers`` (column customer_id) by those in ``events``; only these customers' buckets are read and written."""
    table = Published(spark, path, [_BUCKET])
    n = table.notes["buckets"]
    asked = customers.select("customer_id").distinct().withColumn(_BUCKET, F.pmod(F.xxhash64("customer_id"), F.lit(n)).cast("int"))
    touched = key_values(asked, [_BUCKET])
    if touched:
        gone = asked.select(F.col("customer_id").alias("_gone"))
        own = events.join(gone, F.col("customer_id").eqNullSafe(F.col("_gone")), "left_semi")
        rest = table.read(touched).join(gone, F.col("customer_id").eqNullSafe(F.col("_gone")), "left_anti").drop(_BUCKET)
        table.replace(_placed(rest.unionByName(own), n), touched, notes=table.notes)


def stored_events(spark: SparkSession, path: str, customer_id) -> DataFrame:
    """One customer's events out of the stored timeline; the other buckets are not listed."""
    table = Published(spark, path, [_BUCKET])
    kind, n = table.schema["customer_id"].dataType, table.notes["buckets"]
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(customer_id).cast(kind)), F.lit(n)).cast("string")).first()[0]
    return table.read({(bucket,)}).drop(_BUCKET)


def stored_page(spark: SparkSession, path: str, customer_id, limit: int = 50, cursor: tuple | None = None) -> DataFrame:
    """:func:`lodestream.plans.serving.timeline_page` from the stored timeline."""
    return timeline_page(stored_events(spark, path, customer_id), customer_id, limit, cursor)
