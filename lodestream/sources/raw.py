"""Reading raw tables, seeds and audit files; counting and fingerprinting what lies in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.operators.incremental import exists
from lodestream.operators.schema_guard import AUDIT
from lodestream.schema import struct

FX_RATES = struct("rate_date date, currency_code string, rate_to_usd double, source string, is_month_close boolean")
HOLIDAYS = struct("holiday_date date, holiday_name string, country_code string, affects_volume boolean")


def raw_source(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every Parquet file under ``path``, columns united by name.

    With the registered schema, older narrower files are read into it; without one the files' schemas are merged, which
    fails if a column's types differ.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def raw_column(df: DataFrame, name: str, fallback=None) -> Column:
    """The column, or a literal where the raw table does not have it yet."""
    return F.col(name) if name in df.columns else F.lit(fallback)


def read_day(spark: SparkSession, path: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One ingestion day; other days' directories are not listed into the scan."""
    return raw_source(spark, path, schema).filter(F.col("_ingested_date") == F.lit(day).cast("date"))


def seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").csv(path, header=True)


def audit(spark: SparkSession, path: str) -> DataFrame:
    """The schema audit; empty with the right columns where nothing was ever written."""
    if not exists(spark, path):
        return spark.createDataFrame([], AUDIT)
    return spark.read.schema(AUDIT).json(path)


def lookup(df: DataFrame, column: str, value=None) -> DataFrame:
    """(n_rows, n_distinct, n_found) of a column, the last for one value."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(column).alias("n_distinct"), F.count_if(F.col(column) == F.lit(value)).alias("n_found"))


def manifest(df: DataFrame, day: str = "_ingested_date") -> DataFrame:
    """(day, objects, rows) of a raw table that is read from files."""
    files = df.select(day, F.input_file_name().alias("_file"))
    return files.groupBy(day, "_file").agg(F.count("*").alias("n")).groupBy(day).agg(F.count("*").alias("objects"), F.sum("n").alias("rows"))


def bulk_snapshot(df: DataFrame, key: str, taken_at, parts: int | None = None) -> DataFrame:
    """A consistent snapshot as change-log rows: op r, no sequence, partition -1, one time, offsets by key order.

    Offsets number ranges of the key one by one and add the sizes of the ranges before, so no task orders all rows.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    from pyspark.sql import Window

    ranged = df.repartitionByRange(n, key).withColumn("_range", F.spark_partition_id())
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).select("_range", "_before")
    numbered = ranged.withColumn("_own", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    return numbered.join(before, "_range").select(
        *df.columns,
        F.lit("r").alias("_op"),
        F.lit(None).cast("long").alias("_lsn"),
        (F.col("_before") + F.col("_own") - 1).cast("long").alias("_kafka_offset"),
        F.lit(-1).alias("_kafka_partition"),
        F.lit(taken_at).cast("timestamp").alias("_ingested_at"),
        F.lit(None).cast("timestamp").alias("_source_ts"),
    )


def snapshot_manifest(tables: dict[str, DataFrame], taken_at) -> DataFrame:
    """(table, rows, taken_at) of a bulk load."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(taken_at).cast("timestamp").alias("taken_at"))
        out = row if out is None else out.union(row)
    return out
