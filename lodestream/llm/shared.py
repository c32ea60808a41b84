"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs without the ASCII white space of this pattern's complement.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. In local mode, where it may be unset, a temporary one."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get("spark.lodestream.scratch", None)
    if not own:
        own = tempfile.mkdtemp(prefix="spark-lodestream-")
        spark.conf.set("spark.lodestream.scratch", own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    This cuts the lineage: a lost executor costs a re-read of a file, not a recomputation, and a table that
    several jobs use is computed once. The files stay until the folder is cleared or :func:`drop_written` is called,
    as results are lazy and may read them at any time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestream-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove all tables that :func:`written` made in the shared folder. For callers that have stored their results and run nothing else there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/lodestream-*")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(at) or ():
        fs.delete(found.getPath(), True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def texts_in(batch: pa.RecordBatch, column: str = "text", mb: float = 4.0) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) for slices of about ``mb`` MB each, nulls as empty texts; one long text is a slice of its own."""
    values = batch.column(batch.schema.get_field_index(column))
    start, size, out = 0, 0, []
    for i in range(len(values)):
        text = values[i].as_py() or ""
        if out and size + len(text) > mb * 1e6:
            yield start, out
            start, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield start, out


def texts_of(values: pa.Array, mb: float = 4.0) -> Iterator[list[str]]:
    """The texts of a column in slices of about ``mb`` MB each, nulls as empty texts; one long text is a slice of its own."""
    for _, out in texts_in(pa.RecordBatch.from_arrays([values], names=["text"]), "text", mb):
        yield out


def arrow_column(run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str) -> Callable[..., Column]:
    """``run`` as a function of one column, over the batches of a task: the other columns of the rows stay in the JVM."""

    def over(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(run)(columns)

    return F.arrow_udf(over, kind)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, and when a task ends, what it freed goes back to the system: Python workers live on between tasks."""

    def over(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return over
