"""Writing raw tables so that a replay changes nothing, and the dead-letter and audit sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.operators.changelog import union_by_offset
from lodestream.operators.incremental import exists, fingerprint
from lodestream.operators.schema_guard import IncompatibleSchema, classify, conform
from lodestream.schema import struct
from lodestream.sources.published import Published, key_values

#: Offsets of one block; an offset always falls into the same directory.
BLOCK = 100_000
LAYOUT = ["_ingested_date", "_kafka_partition", "_offset_block"]


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the layout columns: UTC ingestion date and block of offsets."""
    return df.withColumn("_ingested_date", F.to_date("_ingested_at")).withColumn("_offset_block", F.floor(F.col("_kafka_offset") / BLOCK).cast("long"))


#: The raw files' compression level and rows of a row group; dictionaries are on.
WRITER = {"compression": "zstd", "parquet.compression.codec.zstd.level": "3", "parquet.block.row.count.limit": "131072", "parquet.enable.dictionary": "true"}


def raw_table(spark: SparkSession, path: str) -> Published:
    return Published(spark, path, LAYOUT)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of a raw table that :func:`write_batch` wrote, its widest types so far; without one, that of its files."""
    return raw_table(spark, path).schema


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The raw table's live rows, older and narrower files in its widest schema."""
    return raw_table(spark, path).read()


def write_batch(batch: DataFrame, path: str, delivery: list[str] | None = None, keep: int = 0, on_step: Callable[[str], None] | None = None) -> None:
    """Merge a batch into the raw table at ``path``.

    Only the directories that the batch falls into are read and replaced. Within them one row stays for each (partition,
    offset): the batch's, and of the batch's copies the last by ``delivery``, columns that are not stored. So the same batch
    twice, shuffled or overlapping, leaves the same rows. A batch across midnight goes to two days. Columns that only the
    table or only the batch has, and types that either has wider, are kept in the table's schema. Rows and schema change in
    one step, see :meth:`Published.replace`, which also explains ``keep`` and ``on_step``: a run that ends at any moment leaves the
    table as it was or as it will be. A batch with a type that the guard calls incompatible is an error; an empty batch changes nothing.
    """
    spark = batch.sparkSession
    new = placed(batch).persist()
    try:
        table = raw_table(spark, path)
        own = T.StructType([f for f in new.schema if f.name not in (delivery or [])])
        verdict = classify(path, table.schema, own)
        if not verdict.accepted:
            raise IncompatibleSchema(verdict)
        schema, touched = verdict.merged, key_values(new, LAYOUT)
        if not touched:
            return
        prior = conform(table.read(touched), schema) if table.exists else spark.createDataFrame([], schema)
        # One shuffle, by what an offset alone decides: a directory's rows are in one task, and copies of an offset too, whatever their days.
        merged = conform(union_by_offset(prior, new, delivery, block="_offset_block"), schema)
        placed_rows = merged.sortWithinPartitions(*LAYOUT, "_kafka_offset")
        table.replace(placed_rows, touched, schema, WRITER, keep=keep, on_step=on_step, tally="_op" if "_op" in schema.names else None)
    finally:
        new.unpersist()


def drop_day(spark: SparkSession, path: str, day: str) -> None:
    """Remove one ingestion day for replay."""
    raw_table(spark, path).drop(lambda key: key[0] == day)


def day_checksums(spark: SparkSession, path: str, day: str | None = None, portable: bool = False) -> DataFrame:
    """Content fingerprint of each directory of the layout; equal for equal rows however files were cut."""
    df = read_table(spark, path)
    if day is not None:
        df = df.filter(F.col("_ingested_date") == F.lit(day).cast("date"))
    return fingerprint(df, LAYOUT, portable=portable)


def kept_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(layout, files, rows, fingerprint) of each directory as its writer stored them: no data file is opened."""
    return raw_table(spark, path).stored()


def kept_by_op(spark: SparkSession, path: str) -> DataFrame:
    """(op, records) of a raw table as its writer counted them: rows that a later delivery replaced are not counted twice, and no data file is opened."""
    return raw_table(spark, path).tallied("_op").select(F.col("_op").alias("op"), F.col("rows").alias("records"))


METRICS = struct("batch string, records long, c long, u long, d long, r long, newest timestamp")


def batch_metrics(spark: SparkSession, path: str, batch: str, seen: dict) -> None:
    """Keep what was observed of one batch; a batch that is run again replaces its own."""
    row = spark.createDataFrame([tuple(seen.get(f.name) if f.name != "batch" else batch for f in METRICS)], METRICS)
    row.coalesce(1).write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{path}/_batch={batch}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path) if exists(spark, path) else spark.createDataFrame([], METRICS)


def batch_name() -> Column:
    """An aggregate that names a batch of broker records: the same records in any order, as a retry gives them, have the same name."""
    total = F.sum(F.xxhash64("topic", "partition", "offset").cast("decimal(38,0)"))
    return F.concat_ws(".", F.count("*").cast("string"), F.coalesce(total.cast("string"), F.lit("0")))


def batch_id(batch: DataFrame) -> str:
    """The name of a batch, see :func:`batch_name`."""
    return batch.agg(batch_name()).first()[0]


def append_audit(rows: DataFrame, path: str, batch: str = "0") -> None:
    """Keep audit rows under their day and the name of their batch; a batch that is run again replaces its own."""
    by = rows.withColumn("_ingested_date", F.to_date("detected_at")).withColumn("_batch", F.lit(batch))
    by.write.mode("overwrite").options(partitionOverwriteMode="dynamic", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").partitionBy("_batch", "_ingested_date").json(path)


def dead_records(bad: DataFrame, path: str, batch: str = "0") -> None:
    """Keep events that could not be read, with the reason and where they came from; a batch that is run again replaces its own."""
    bad.select(F.col("value").cast("string").alias("value"), "reason", "topic", "partition", "offset").write.mode("overwrite").json(f"{path}/_batch={batch}")


def dead_batch(rows: DataFrame, reason: str, path: str, batch: str = "0", sample: int = 5) -> None:
    """Keep a batch that its schema rejects, whole, beside a summary of its count and offsets with a few of its rows.

    A batch that is run again replaces its own. ``_row`` may hold the rows' JSON objects, which are kept as text.
    """
    text = rows.withColumn("_row", F.to_json("_row")) if "_row" in rows.columns else rows
    text.write.mode("overwrite").json(f"{path}/rows/_batch={batch}")
    kept = [r["v"] for r in text.select(F.to_json(F.struct("*")).alias("v")).orderBy("v").limit(sample).collect()]
    text.agg(F.count("*").alias("n"), F.min("_kafka_offset").alias("first_offset"), F.max("_kafka_offset").alias("last_offset")).withColumn("reason", F.lit(reason)).withColumn(
        "sample", F.array(*(F.lit(r) for r in kept)) if kept else F.lit(None).cast("array<string>")
    ).write.mode("overwrite").json(f"{path}/batches/_batch={batch}")
