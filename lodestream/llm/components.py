"""Buckets of candidates and connected components, for the near-duplicate operators.

A stream of rows sorted by bucket is cut into whole buckets; one that is larger than a limit is cut into chunks that a
later step pairs with each other, so that no task holds or compares an unbounded group. Components come from links by
alternating star operations on DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm.shared import written


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, chunk numbers) from batches sorted by ``key``: the rows of one or more whole runs, chunk -1, or rows of one
    run that is longer than ``limit``, numbered by chunks of ``limit`` rows. Holds one batch and ``limit`` rows at most."""
    held: pa.RecordBatch | None = None
    large, taken = None, 0

    def emit(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        keys = rows.column(key).to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(begins, len(keys)))
        big = np.repeat(sizes > limit, sizes)
        if not big.all():
            small = rows.filter(pa.array(~big))
            yield small, np.full(small.num_rows, -1)
        for b, n in zip(begins[sizes > limit], sizes[sizes > limit], strict=True):
            yield rows.slice(b, n), np.arange(n) // limit

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        held = None
        keys = rows.column(key).to_numpy()
        if large is not None:
            more = int(np.searchsorted(keys, large, side="right"))
            if more:
                yield rows.slice(0, more), (taken + np.arange(more)) // limit
                taken += more
                rows, keys = rows.slice(more), keys[more:]
            if not len(keys):
                continue
            large = None
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last:
            yield from emit(rows.slice(0, last))
        held = rows.slice(last)
        if held.num_rows > limit:
            large, taken = keys[-1], held.num_rows
            yield held, np.arange(taken) // limit
            held = None
    if held is not None:
        yield from emit(held)


def chunk_pairs(chunks: DataFrame, key: str) -> DataFrame:
    """Rows of large runs (with ``key`` and ``chunk``) dealt to the cells (key, lo, hi) of all pairs of their chunks."""
    count = chunks.groupBy(key).agg((F.max("chunk") + 1).alias("_chunks"))
    return (
        chunks.join(count, key)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
        .select("*", F.least("chunk", "_other").alias("lo"), F.greatest("chunk", "_other").alias("hi"))
        .drop("_other", "_chunks")
    )


def forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes that the links between positions ``left`` and ``right`` join to a smaller node: one row a node at most."""
    order = np.argsort(nodes, kind="stable")
    place = np.empty(len(nodes), dtype=np.int64)
    place[order] = np.arange(len(nodes))
    root, a, b = np.arange(len(nodes)), place[left], place[right]
    while True:
        low = np.minimum(root[a], root[b])
        if (low == root[a]).all() and (low == root[b]).all():
            break
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not (root[root] == root).all():
            root = root[root]
    joined = np.flatnonzero(root != np.arange(len(nodes)))
    ordered = nodes[order]
    return ordered[joined], ordered[root[joined]]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node in ``links`` (two columns of long): label is the smallest node of its component.

    Large-star joins each node's larger neighbours to its smallest one, small-star the smaller ones; the two alternate
    until nothing moves, in a number of rounds that grows with the logarithm of the component's size. Each round is
    written, so a lost executor costs one round at most. Links from a node to itself and repeated links are harmless;
    rows with a null are dropped; no links give an empty result.
    """
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m")).filter("v is not null and m is not null and v <> m").distinct()
    state, edges = None, written(edges, "links")
    while True:
        both = edges.union(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        # Written, the minima are joined by exchanges of their own, whose hot partitions Spark can split.
        lowest = written(both.groupBy("v").agg(F.least(F.col("v"), F.min("m")).alias("low")), "links")
        large = both.join(lowest, "v").filter("m > v").select(F.col("m").alias("v"), F.col("low").alias("m")).filter("v <> m").distinct()
        large = written(large, "links")
        low = written(large.groupBy("v").agg(F.min("m").alias("low")), "links")
        small = large.join(low, "v").select(F.explode(F.array(F.struct("v", F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e"))
        edges = written(small.select("e.*").filter("v <> m").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("v").alias("node"), F.col("m").alias("label")).union(edges.select("m", "m").distinct())
