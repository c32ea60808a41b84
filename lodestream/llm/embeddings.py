"""Embedding near-duplicates by Euclidean p-stable hashing.

A normalised vector's projections on random normal directions, shifted and cut into steps, name its bucket in each of
several tables; vectors within the distance that the least cosine allows share one in some table with high
probability. Vectors that share a bucket are compared exactly, in double precision.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.components import chunk_pairs, components, forest, whole_runs
from lodestream.llm.shared import written


@dataclass(frozen=True)
class Tables:
    """Production parameters: at cosine 0.93 a pair shares a bucket of these tables with probability 0.93, from 0.95 on with 0.98 or more."""

    tables: int = 24
    projections: int = 10
    step: float = 1.5
    seed: int = 5
    #: Vectors of a bucket that one task compares.
    bucket: int = 2048


@functools.lru_cache(maxsize=8)
def _directions(dims: int, t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([t.seed, dims])
    n = t.tables * t.projections
    mix = rng.integers(1, 1 << 62, t.projections, dtype=np.int64) | 1
    return rng.standard_normal((dims, n)), rng.uniform(0, t.step, n), mix


def buckets(unit: np.ndarray, t: Tables) -> np.ndarray:
    """(n, tables) bucket numbers of unit vectors."""
    directions, shift, mix = _directions(unit.shape[1], t)
    steps = np.floor((unit @ directions + shift) / t.step).astype(np.int64).reshape(len(unit), t.tables, t.projections)
    with np.errstate(over="ignore"):
        return (steps * mix).sum(axis=2)


def _unit(flat: np.ndarray, dims: int) -> np.ndarray:
    v = flat.reshape(-1, dims).astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _links(unit: np.ndarray, number: np.ndarray, least: float, table: int, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, whether this table is the first that the two share) of pairs i < j with cosine at or above ``least``; with ``left``, only pairs of one row in it and one not."""
    i, j = [], []
    for k in range(0, len(unit), 1024):
        near = unit[k : k + 1024] @ unit.T >= least
        a, b = np.nonzero(near)
        a += k
        own = (a < b) if left is None else (left[a] & ~left[b])
        i.append(a[own])
        j.append(b[own])
    i, j = np.concatenate(i), np.concatenate(j)
    first = np.ones(len(i), dtype=bool)
    for t in range(table):
        first &= number[i, t] != number[j, t]
    return i, j, first


def near_duplicates(vectors: DataFrame, least: float = 0.93, t: Tables = Tables(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of each row.

    Two vectors link if their labels are equal and not null and their cosine is ``least`` or more. Vectors that are null,
    empty, zero, or hold a null, NaN or infinite component link with nothing; vectors of different lengths never link.
    n_links counts the other rows linked directly, component_id is the smallest key that links reach, and a row is kept
    if it has that key. Rows of equal label and vector are one class, whose copies link to each other; classes are
    compared, not copies. Rows with a null key take part in links and are kept only if alone. Repeated rows are copies.
    An empty table gives an empty result. Other columns are not read.
    """
    value = F.col(vector).cast("array<double>")
    square = F.aggregate(value, F.lit(0.0), lambda s, x: s + x * x)
    whole = F.col(label).isNotNull() & (F.size(value) > 0) & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), value.alias("vector"), F.coalesce(whole & (square > 0), F.lit(False)).alias("whole"))
    classes = written(
        rows.filter("whole").groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("first")).withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            size = lists.value_lengths().to_numpy()
            for dims in np.unique(size):
                own = np.flatnonzero(size == dims)
                part = batch.take(pa.array(own))
                unit = _unit(part.column("vector").flatten().to_numpy(), int(dims))
                number = buckets(unit, t)
                mark = part.column("label_hash").to_numpy() + dims
                for table in range(t.tables):
                    with np.errstate(over="ignore"):
                        bucket = (number[:, table] ^ mark) * np.int64(t.tables) + table
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(own), table, dtype=np.int32)), part.column("node")], names=["bucket", "tab", "node"])

    spots = written(
        classes.select("node", "vector", F.xxhash64("label").alias("label_hash")).mapInArrow(keyed, "bucket long, tab int, node long"), "vector-buckets"
    )
    # A bucket that holds one class gives no pair; what is left carries its vector.
    shared = spots.groupBy("bucket").count().filter("count > 1").select("bucket")
    full = spots.join(shared, "bucket").join(classes.select("node", "label", "vector", "copies"), "node")
    sorted_ = full.select("bucket", "tab", "node", F.xxhash64("label").alias("label_hash"), "copies", "vector").repartition("bucket").sortWithinPartitions("bucket")

    def counted(node: np.ndarray, copies: np.ndarray, i: np.ndarray, j: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, links counted here): pairs whose first common table this is."""
        n = np.bincount(i[first], weights=copies[j[first]], minlength=len(node)) + np.bincount(j[first], weights=copies[i[first]], minlength=len(node))
        some = np.flatnonzero(n)
        return node[some], n[some].astype(np.int64)

    def compared(node, label_hash, copies, lists, table, left=None):
        """(counts, links) of one bucket; a hash clash of label or length never makes a link."""
        counts, links = [], []
        size = lists.value_lengths().to_numpy()
        for mark in np.unique(np.stack([label_hash, size]), axis=1).T:
            own = np.flatnonzero((label_hash == mark[0]) & (size == mark[1]))
            if len(own) < 2:
                continue
            unit = _unit(lists.take(pa.array(own)).flatten().to_numpy(), int(mark[1]))
            i, j, first = _links(unit, buckets(unit, t), least, table, None if left is None else left[own])
            counts.append(counted(node[own], copies[own], i, j, first))
            links.append(forest(node[own], i, j))
        return counts, links

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "a", "b", "bucket", "chunk"]
        for rows, chunk in whole_runs(batches, "bucket", t.bucket):
            keys, node = rows.column("bucket").to_numpy(), rows.column("node").to_numpy()
            if chunk[0] >= 0:
                n = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, 2, np.int32)), rows.column("node"), pa.array(rows.column("tab").to_numpy().astype(np.int64)), rows.column("bucket"), pa.array(chunk)], names=names)
                continue
            tab, marks, copies = (rows.column(c).to_numpy() for c in ("tab", "label_hash", "copies"))
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts, links = [], []
            for b, e in zip(begins, np.append(begins[1:], len(keys)), strict=True):
                own = slice(b, e)
                c, x = compared(node[own], marks[own], copies[own], rows.column("vector").slice(b, e - b), int(tab[b]))
                counts += c
                links += x
            for kind, found in ((0, counts), (1, links)):
                a = np.concatenate([np.zeros(0, np.int64), *(x[0] for x in found)])
                v = np.concatenate([np.zeros(0, np.int64), *(x[1] for x in found)])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(v), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64())], names=names)

    found = written(sorted_.mapInArrow(compare, "kind int, a long, b long, bucket long, chunk long"), "vector-links")
    pairs = found.filter("kind < 2").select("kind", "a", "b")
    large = found.filter("kind = 2").select(F.col("a").alias("node"), F.col("b").alias("tab"), "bucket", "chunk")
    if not large.isEmpty():

        def cell(part: pd.DataFrame) -> pd.DataFrame:
            lo, hi = part["lo"].iat[0], part["hi"].iat[0]
            lists = pa.array(part["vector"].tolist(), pa.list_(pa.float64()))
            left = None if lo == hi else (part["chunk"] == lo).to_numpy()
            counts, links = compared(part["node"].to_numpy(), part["label_hash"].to_numpy(), part["copies"].to_numpy(), lists, int(part["tab"].iat[0]), left)
            return pd.DataFrame([(k, int(a), int(b)) for k, xs in ((0, counts), (1, links)) for x in xs for a, b in zip(*x, strict=True)], columns=["kind", "a", "b"])

        dealt = chunk_pairs(large, "bucket").join(classes.select("node", F.xxhash64("label").alias("label_hash"), "vector", "copies"), "node")
        pairs = pairs.union(dealt.groupBy("bucket", "lo", "hi").applyInPandas(cell, "kind int, a long, b long"))
        pairs = written(pairs, "vector-pairs")

    links = pairs.filter("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("others"))
    joined = written(components(pairs.filter("kind = 1").select("a", "b")), "vector-labels")
    joined = joined.withColumnRenamed("label", "component")
    named = written(joined.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least")), "vector-components")
    reached = joined.join(named, "component").select("node", "least")
    result = written(
        classes.join(links, "node", "left").join(reached, "node", "left").select(
            "label", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id")
        ),
        "vector-result",
    )
    alone = rows.filter("not whole").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (
        rows.filter("whole")
        .join(result, ["label", "vector"])
        .select("id", "n_links", "component_id")
        .union(alone)
        .select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
