"""Registration of queries, each with its SQL twin where SQL can state it, and what they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.session import configured

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configured(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return run

    return register


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under ``spark.checkpoint.dir``, or in local mode, where it may be unset, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-lodestream-")
    return f"{root}/lodestream-{uuid.uuid4().hex}"
