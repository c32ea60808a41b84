"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

A shard's distinct directions become the nodes of a graph. Nodes are inserted in growing batches: a greedy search from the
entry node proposes neighbours, and relaxed pruning drops a candidate that lies much closer to a kept neighbour than to the
node itself, so the edges that stay point in different directions. Kept edges are offered back to their ends, which are
pruned in the same way. A query walks each shard's graph with a beam; the rows of the nodes that stay in its beam are
compared exactly, in double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lodestream.llm.shared import written


@dataclass(frozen=True)
class Graph:
    """Production parameters; ``shard`` and ``shard_bytes`` bound what a task holds, by the root of the rows and by their bytes."""

    degree: int = 24
    beam: int = 32
    #: Beam of a query, and so the least number of nodes whose rows are compared exactly.
    query_beam: int = 128
    #: Nodes that a step of a search expands at once.
    wide: int = 4
    relax: float = 1.2
    #: A shard has about this many times the root of the number of rows, so shards become larger and more.
    shard: int = 16
    shard_bytes: int = 64 << 20
    #: Queries that a task answers at once.
    block: int = 4096
    seed: int = 11

    def shards(self, rows: int, dims: int) -> int:
        most = max(1, self.shard_bytes // (8 * dims + 4 * self.degree + 64))
        return max(1, math.ceil(rows / min(most, self.shard * math.sqrt(max(rows, 1)))))


def directions(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def beam_search(unit: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, width: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, cosines, first nodes expanded) of each query's beam, nearest first; -1 where the graph has no more."""
    count, rows = len(queries), np.arange(len(queries))
    seen = np.zeros((count, len(unit)), dtype=bool)
    ids, near, closed = np.full((count, width), -1, np.int64), np.full((count, width), -np.inf, np.float32), np.ones((count, width), dtype=bool)
    ids[:, 0], near[:, 0], closed[:, 0] = entry, queries @ unit[entry], False
    seen[:, entry] = True
    path: list[np.ndarray] = []
    while len(rows):
        pick = ~closed[rows]
        pick &= pick.cumsum(axis=1) <= wide
        at = np.argsort(~pick, axis=1, kind="stable")[:, :wide]
        nodes = np.where(np.take_along_axis(pick, at, 1), np.take_along_axis(ids[rows], at, 1), -1)
        closed[rows] |= pick
        if len(path) < 4:
            step = np.full((count, wide), -1, np.int64)
            step[rows, : nodes.shape[1]] = nodes
            path.append(step)
        ends = np.where(nodes[:, :, None] >= 0, edges[nodes], -1).reshape(len(rows), -1)
        ends.sort(axis=1)
        fresh = ends >= 0
        fresh[:, 1:] &= ends[:, 1:] != ends[:, :-1]
        fresh &= ~seen[rows[:, None], ends]
        r, c = np.nonzero(fresh)
        node = ends[r, c]
        seen[rows[r], node] = True
        found = np.full(ends.shape, -np.inf, np.float32)
        found[r, c] = np.einsum("ij,ij->i", unit[node], queries[rows[r]])
        all_near = np.concatenate([near[rows], found], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
        near[rows] = np.take_along_axis(all_near, best, 1)
        ids[rows] = np.where(np.isneginf(near[rows]), -1, np.take_along_axis(np.concatenate([ids[rows], ends], axis=1), best, 1))
        closed[rows] = np.take_along_axis(np.concatenate([closed[rows], ~fresh], axis=1), best, 1)
        rows = rows[(~closed[rows]).any(axis=1)]
    return ids, near, np.concatenate(path, axis=1)


def pruned(unit: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, g: Graph) -> np.ndarray:
    """(n, degree) kept neighbours of each of ``nodes``, nearest first, -1 for none; candidates may repeat and hold -1 and the node itself."""
    candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
    valid = candidates >= 0
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    kept = np.full((len(nodes), g.degree), -1, np.int64)
    step = max(1, (1 << 22) // candidates.shape[1] ** 2)
    for k in range(0, len(nodes), step):
        own, some, alive = nodes[k : k + step], candidates[k : k + step], valid[k : k + step]
        vectors = unit[some]
        apart = 2 - 2 * np.einsum("ijk,ik->ij", vectors, unit[own])
        apart[~alive] = np.inf
        between = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
        rows = np.arange(len(own))
        for slot in range(g.degree):
            nearest = apart.argmin(axis=1)
            left = alive[rows, nearest]
            if not left.any():
                break
            kept[k + rows[left], slot] = some[rows, nearest][left]
            alive[rows, nearest] = False
            alive &= g.relax**2 * between[rows, nearest] > apart
            apart[~alive] = np.inf
    return kept


def back_linked(unit: np.ndarray, edges: np.ndarray, nodes: np.ndarray, g: Graph) -> None:
    """Offers each of ``nodes`` to the ends of its edges, which take it while they have room and are pruned beyond."""
    source, target = np.repeat(nodes, edges.shape[1]), edges[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    have = (edges[target] == source[:, None]).any(axis=1)
    source, target = source[~have], target[~have]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    ends, begins, counts = np.unique(target, return_index=True, return_counts=True)
    room = (edges[ends] < 0).sum(axis=1)
    for some in (counts <= room, counts > room):
        # By the number of offers, so that one node with very many does not widen the others' rows.
        for width in np.unique(1 << np.ceil(np.log2(counts[some])).astype(int)):
            own = np.flatnonzero(some & (counts <= width) & (2 * counts > width))
            at = begins[own][:, None] + np.arange(width)
            offers = np.where(np.arange(width) < counts[own][:, None], source[np.minimum(at, len(source) - 1)], -1)
            both = np.concatenate([edges[ends[own]], offers], axis=1)
            if counts[own[0]] <= room[own[0]]:
                edges[ends[own]] = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, : edges.shape[1]]
            else:
                edges[ends[own]] = pruned(unit, ends[own], both, g)


def reached(edges: np.ndarray, entry: int) -> np.ndarray:
    found = np.zeros(len(edges), dtype=bool)
    found[entry] = True
    last = np.array([entry])
    while len(last):
        ends = np.unique(edges[last])
        last = ends[(ends >= 0) & ~found[ends]]
        found[last] = True
    return found


def graph(unit: np.ndarray, g: Graph) -> tuple[np.ndarray, int]:
    """(edges, entry): directed edges of each node, -1 for none, such that the entry reaches every node."""
    n = len(unit)
    entry = int((unit @ unit.mean(axis=0)).argmax())
    edges = np.full((n, g.degree), -1, np.int64)
    rest = np.random.default_rng(g.seed).permutation(n)
    rest = rest[rest != entry]
    most = int(np.clip((64 << 20) // n, 16, max(64, n // 16)))
    for again in (False, True):
        done = 0
        while done < len(rest):
            batch = rest[done : done + (most if again else min(most, done + 1))]
            ids, _, path = beam_search(unit, edges, entry, unit[batch], g.beam, g.wide)
            edges[batch] = pruned(unit, batch, np.concatenate([ids, path, edges[batch]], axis=1), g)
            back_linked(unit, edges, batch, g)
            done += len(batch)
    while not (found := reached(edges, entry)).all():
        # One more edge from the nearest node that is reached, in a column of its own if need be.
        lost = np.flatnonzero(~found)[:256]
        ids, _, _ = beam_search(unit, edges, entry, unit[lost], g.beam, g.wide)
        for node, start in zip(lost, ids[:, 0], strict=True):
            if (edges[start] >= 0).all():
                edges = np.pad(edges, ((0, 0), (0, 1)), constant_values=-1)
            edges[start, int((edges[start] < 0).argmax())] = node
    return edges, entry


def taking_part(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector, dims), one row for each id whose vector has a direction."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    square = F.aggregate(value, F.lit(0.0), lambda s, x: s + x * x)
    # A null, NaN or infinite component, and an empty or zero vector, make no positive finite sum.
    whole = F.coalesce((square > 0) & (square < float("inf")) & ~F.isnan(square), F.lit(False))
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).filter(F.col("id").isNotNull() & whole)
    return rows.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))


def index(rows: DataFrame, g: Graph = Graph()) -> DataFrame:
    """The graphs of (id, vector, dims) rows: dims, shard, position, id, vector, node (the position that stands for this row's direction), edges (positions; null but for nodes), entry.

    Every row is in one shard by the hash of its id. Rows of one direction share a node, so copies neither fill a beam nor lengthen a search.
    """
    found = rows.agg(F.count("*"), F.max("dims")).first()
    shards = g.shards(found[0], found[1] or 1)

    def built(table: pa.Table) -> pa.Table:
        dims, shard = (table.column(c)[0].as_py() for c in ("dims", "shard"))
        values = np.array(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims)
        unit = directions(values)
        _, first, same = np.unique(np.round(unit, 5), axis=0, return_index=True, return_inverse=True)
        edges, entry = graph(unit[first], g)
        n, node = len(values), first[same.ravel()]
        lists: list[np.ndarray | None] = [None] * n
        for k, at in enumerate(first):
            lists[at] = first[edges[k][edges[k] >= 0]]
        return pa.table(
            {
                "dims": pa.array(np.full(n, dims), pa.int32()),
                "shard": pa.array(np.full(n, shard), pa.int64()),
                "position": pa.array(np.arange(n), pa.int64()),
                "id": table.column("id"),
                "vector": table.column("vector"),
                "node": pa.array(node, pa.int64()),
                "edges": pa.array(lists, pa.list_(pa.int64())),
                "entry": pa.array(np.arange(n) == first[entry]),
            }
        )

    kind = {f.name: f for f in rows.schema}
    schema = StructType.fromDDL("dims int, shard long, position long, node long, edges array<bigint>, entry boolean")
    schema = StructType([*schema[:3], StructField("id", kind["id"].dataType), StructField("vector", kind["vector"].dataType), *schema[3:]])
    return rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards))).groupBy("dims", "shard").applyInArrow(built, schema)


def search(graphs: DataFrame, queries: DataFrame, k: int = 5, g: Graph = Graph()) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` nearest found in all shards, itself left out; ties go to the smaller id.

    ``queries`` have the columns id, vector and dims. Blocks of queries meet each shard in a task of its own.
    """
    found = graphs.filter("entry").agg(F.max("shard")).first()[0]
    blocks = max(1, math.ceil(queries.count() / g.block))
    every = lambda n, kind: F.explode(F.sequence(F.lit(0).cast(kind), F.lit(n - 1).cast(kind)))
    left = graphs.withColumn("block", every(blocks, "int"))
    right = queries.select("id", "vector", "dims", F.pmod(F.xxhash64("id", F.lit(g.seed)), F.lit(blocks)).cast("int").alias("block"), every((found or 0) + 1, "long").alias("shard"))

    def nearest(shard: pa.Table, asked: pa.Table) -> pa.Table:
        ids, scores, names = [], [], []
        if shard.num_rows and asked.num_rows:
            shard = shard.sort_by("position")
            dims = shard.column("dims")[0].as_py()
            own, wanted = (np.array(t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims) for t in (shard, asked))
            node, lists = shard.column("node").to_numpy(), shard.column("edges").combine_chunks()
            first, same = np.unique(node, return_inverse=True)
            kept = lists.filter(lists.is_valid())
            width = kept.value_lengths().to_numpy()
            edges = np.full((len(first), max(1, int(width.max(initial=0)))), -1, np.int64)
            edges[np.arange(edges.shape[1]) < width[:, None]] = np.searchsorted(first, kept.flatten().to_numpy())
            entry = int(np.searchsorted(first, np.flatnonzero(shard.column("entry").to_numpy(zero_copy_only=False))[0]))
            members = np.argsort(same, kind="stable")
            begins = np.searchsorted(same[members], np.arange(len(first) + 1))
            names_of, norms = shard.column("id").to_numpy(), np.sqrt((own * own).sum(axis=1))
            unit, query_ids = directions(own[first]), asked.column("id").to_numpy()
            step = max(1, (64 << 20) // len(unit))
            for at in range(0, len(wanted), step):
                beams, _, _ = beam_search(unit, edges, entry, directions(wanted[at : at + step]), max(g.query_beam, k + 1), g.wide)
                for vector, name, beam in zip(wanted[at : at + step], query_ids[at : at + step], beams, strict=True):
                    near = np.concatenate([members[begins[b] : begins[b + 1]] for b in beam[beam >= 0]])
                    near = near[names_of[near] != name]
                    score = (own[near] * vector).sum(axis=1) / (norms[near] * np.sqrt((vector * vector).sum()))
                    best = np.lexsort([names_of[near], -score])[:k]
                    ids.append(names_of[near[best]])
                    scores.append(score[best])
                    names.append(np.full(len(best), name))
        empty = np.zeros(0)
        return pa.table({c: pa.array(np.concatenate(x) if x else empty, t) for c, x, t in (("query_id", names, id_type), ("id", ids, id_type), ("score", scores, pa.float64()))})

    id_kind = graphs.schema["id"].dataType
    id_type = pa.int64() if id_kind.simpleString() == "bigint" else pa.int32()
    schema = StructType([StructField("query_id", id_kind), StructField("id", id_kind), *StructType.fromDDL("score double")])
    near = left.groupBy("dims", "shard", "block").cogroup(right.groupBy("dims", "shard", "block")).applyInArrow(nearest, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, g: Graph = Graph(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest rows by cosine of each row whose key (a whole number) is divisible by ``every``.

    Vectors that are null, empty or zero, or hold a null, NaN or infinite component, take no part, nor do rows without a key.
    A key that repeats is one row, with the smallest of its vectors. Vectors of different lengths never meet. Ties go to
    the smaller key; a query with fewer than ``k`` others gets all. An empty table gives an empty result.
    """
    rows = written(taking_part(vectors, key, vector), "graph-rows")
    graphs = written(index(rows, g), "graph-index")
    return search(graphs, rows.filter(F.col("id") % every == 0), k, g).withColumnRenamed("id", key)


def recall(found: pd.DataFrame, rows: pd.DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> float:
    """Share of each query's ``k`` largest cosines that ``found`` has, by brute force over ``rows`` of one length; for tests and tuning on tables that fit the driver."""
    values = np.stack(rows[vector].to_numpy()).astype(np.float64)
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    names, hits, wanted = rows[key].to_numpy(), 0, 0
    for name, own in found.groupby("query_id"):
        score = unit @ unit[names == name][0]
        score[names == name] = -np.inf
        best = np.sort(score)[::-1][: min(k, len(rows) - 1)]
        hits += (np.sort(own["score"].to_numpy())[::-1][: len(best)] >= best[: len(own)] - 1e-9).sum()
        wanted += len(best)
    return hits / max(wanted, 1)
