"""Mixing sources to target weights.

Each source's rows are put into blocks by a hash of id and text, which orders them at random; a source's quota is a
number of block draws, whole passes first, then the leading blocks of one more pass, and of the last block the rows that
fill the rest. A splitting tree deals the exact quotas out to the shards: each node halves its shards and draws, by the
multivariate hypergeometric law, how many of its block draws of each source go left. So a shard owns a run of places in
each source's sequence of draws; a keyed permutation says which block stands at which place. Every node draws from a seed of its own,
so tasks walk only to the places they need, and no one holds the tree. What a row gives to the mix is what is dealt here.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm.shared import WORD, text_of, written

#: Blocks of one segment, and places of the draws that a task deals at once.
SEGMENT, PLACES = 1 << 10, 1 << 14
#: numpy's hypergeometric law takes fewer draws than this.
MOST_DRAWS = 10**9
#: Weights of the sources in code point order, over and over.
WEIGHTS = (5, 2, 1)


@dataclass(frozen=True)
class Sizes:
    """Words and rows that a block holds on average at most, and words of a shard.

    Small tables are cut finer: a source has at least ``least_blocks`` blocks, or one a row, and the mix ``least_shards`` shards,
    or one a draw.
    """

    block_words: int = 1 << 16
    block_rows: int = 1 << 12
    shard_words: int = 4_000_000
    least_blocks: int = 32
    least_shards: int = 16


@dataclass(frozen=True)
class SourcePlan:
    """What one source gives: ``full`` whole passes, then blocks below ``partial``, then of that block the rows in ``picked``."""

    source: str | None
    index: int
    size: int
    target: float
    blocks: int
    full: int
    partial: int
    picked: tuple[int, ...]

    @property
    def draws(self) -> int:
        return self.full * self.blocks + self.partial + bool(self.picked)


def targets(sizes: list[int], weights: list[float], cap: float = 3.0) -> list[float]:
    """Shares of the sum of all sizes by weight; none is above ``cap`` times its size, and what is cut off goes to the others by weight."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / whole > cap * sizes[k]]
        if not over:
            for k in open_:
                out[k] = left * weights[k] / whole
            break
        for k in over:
            out[k] = cap * sizes[k]
        left -= sum(out[k] for k in over)
        open_ = [k for k in open_ if k not in set(over)]
    return out


def _left(counts: np.ndarray, low: int, high: int, node: int, seed: int) -> np.ndarray:
    """How many draws of each source the lower half of a node's shards gets: each shard total // shards draws, the first total % shards one more."""
    share, more = divmod(int(counts.sum()), high - low)
    half = (low + high) // 2 - low
    return np.random.default_rng([seed, node]).multivariate_hypergeometric(counts, share * half + min(more, half), method="marginals")


def shards_at(quotas: np.ndarray, shards: int, k: int, first: int, last: int, seed: int) -> np.ndarray:
    """The shard of each place from ``first`` up to ``last`` of source ``k``'s draws, by the part of the splitting tree above them."""
    out = np.empty(max(0, last - first), dtype=np.int64)

    def walk(counts: np.ndarray, low: int, high: int, node: int, a: int, b: int, at: int) -> None:
        if a >= b:
            return
        if high - low == 1:
            out[at : at + b - a] = low
            return
        left, middle = _left(counts, low, high, node, seed), (low + high) // 2
        cut = int(left[k])
        walk(left, low, middle, 2 * node, a, min(b, cut), at)
        walk(counts - left, middle, high, 2 * node + 1, max(a - cut, 0), b - cut, at + max(0, min(b, cut) - a))

    walk(np.asarray(quotas, dtype=np.int64), 0, shards, 1, first, last, 0)
    return out


def permuted(places: np.ndarray, n: int, seed: tuple[int, ...]) -> np.ndarray:
    """A keyed permutation of 0 to n - 1: four rounds of a balanced Feistel network, walked again where they leave the range."""
    half = np.uint64(max(1, (max(1, (n - 1).bit_length()) + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(list(seed)).integers(0, 1 << 63, 4, dtype=np.uint64)

    def rounds(v: np.ndarray) -> np.ndarray:
        a, b = v >> half, v & mask
        for key in keys:
            h = b * np.uint64(0x9E3779B97F4A7C15) + key
            h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
            a, b = b, a ^ ((h ^ h >> np.uint64(29)) & mask)
        return a << half | b

    with np.errstate(over="ignore"):
        out = rounds(places.astype(np.uint64))
        while len(beyond := np.flatnonzero(out >= n)):
            out[beyond] = rounds(out[beyond])
    return out.astype(np.int64)


def _sized(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """Each row as one struct, with its source, number of words and place in the random order: no column of ``docs`` can clash with ours."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col(source).alias("_source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("_order"),
    )


def _block(blocks: Column) -> Column:
    """The number of the block that a row's place falls into."""
    return F.floor(F.shiftrightunsigned("_order", 11) / F.lit(float(1 << 53)) * blocks).cast("long")


def _local(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """Rows of the driver as a relation whose size Spark knows, so it broadcasts or shuffles by that size."""
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema))


def _plan(slim: DataFrame, weight: Callable[[int], float], cap: float, sizes: Sizes) -> list[SourcePlan]:
    """One plan a source. Reads sums only: of sources, of segments, of the blocks of one segment and the rows of one block a source."""
    spark = slim.sparkSession
    found = slim.groupBy("_source").agg(F.sum("_size").alias("size"), F.count("*").alias("rows")).collect()
    found.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    wanted = targets([r["size"] for r in found], [weight(k) for k in range(len(found))], cap)
    blocks = [max(1, -(-r["size"] // sizes.block_words), -(-r["rows"] // sizes.block_rows), min(sizes.least_blocks, r["rows"])) for r in found]
    full = [int(t // r["size"]) if r["size"] else 0 for r, t in zip(found, wanted, strict=True)]
    rest = [round(t - f * r["size"]) for r, t, f in zip(found, wanted, full, strict=True)]
    names = _local(spark, [(r["_source"], k, b) for k, (r, b) in enumerate(zip(found, blocks, strict=True))], pa.schema([("_source", pa.string()), ("index", pa.int32()), ("blocks", pa.int64())]))
    placed = (
        slim.join(names, slim["_source"].eqNullSafe(names["_source"]))
        .select("index", "_size", "_order", _block(F.col("blocks")).alias("block"))
        .withColumn("segment", F.floor(F.col("block") / SEGMENT).cast("long"))
    )

    def boundary(level: str, frame: DataFrame, begin: list[int]) -> tuple[list[int], list[int]]:
        """The first value of ``level`` of each source that its rest does not hold whole, and the rest from there on."""
        where, left = list(begin), list(rest)
        sums = frame.groupBy("index", level).agg(F.sum("_size").alias("size")).orderBy("index", level).collect()
        stopped: set[int] = set()
        for r in sums:
            k = r["index"]
            if k not in stopped and left[k] >= r["size"]:
                left[k] -= r["size"]
                where[k] = r[level] + 1
            elif k not in stopped:
                where[k] = r[level]
                stopped.add(k)
        return where, left

    def at(frame: DataFrame, column: str, values: list[int]) -> DataFrame:
        """The rows of ``frame`` whose ``column`` has its source's value; sources without a rest have none."""
        wanted_ = _local(spark, [(k, v) for k, v in enumerate(values) if rest[k] > 0], pa.schema([("index", pa.int32()), ("_at", pa.int64())]))
        return frame.join(wanted_, "index").filter(F.col(column) == F.col("_at")).drop("_at")

    picked: list[tuple[int, ...]] = [() for _ in found]
    partial, open_ = [0] * len(found), [r > 0 for r in rest]
    if any(open_):
        segments, rest = boundary("segment", placed, [0] * len(found))
        inner = at(placed, "segment", segments)
        partial, rest = boundary("block", inner, [s * SEGMENT for s in segments])
        units = at(inner.filter("_size > 0"), "block", partial).groupBy("index", "_order").agg(F.sum("_size").alias("size")).orderBy("index", "_order").collect()
        nearest: dict[int, tuple[int, int]] = {}
        for r in units:
            k = r["index"]
            if r["size"] <= rest[k]:
                rest[k] -= r["size"]
                picked[k] += (r["_order"],)
            else:
                nearest[k] = min(nearest.get(k, (r["size"], r["_order"])), (r["size"], r["_order"]))
        for k, (size, order) in nearest.items():
            if size - rest[k] < rest[k]:
                picked[k] += (order,)
    return [
        # Without a rest no pass is begun, not even over blocks that hold no word.
        SourcePlan(r["_source"], k, r["size"], wanted[k], blocks[k], full[k], min(partial[k], blocks[k]) if open_[k] else 0, picked[k])
        for k, r in enumerate(found)
    ]


def dealt(spark: SparkSession, plans: list[SourcePlan], shards: int, seed: int) -> DataFrame:
    """(index, block, shards) of every block that is drawn: the shard of its first draw, its second and so on."""
    quotas, blocks = np.array([p.draws for p in plans], dtype=np.int64), [p.blocks for p in plans]
    # Chunk number to source and first place.
    chunks = np.concatenate([[0], np.cumsum(-(-quotas // PLACES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column("id").to_pylist():
                k = int(np.searchsorted(chunks, chunk, side="right")) - 1
                first = (chunk - int(chunks[k])) * PLACES
                last = min(first + PLACES, int(quotas[k]))
                draw = permuted(np.arange(first, last), int(quotas[k]), (seed, 0, k))
                shard = shards_at(quotas, shards, k, first, last, seed)
                columns = [np.full(last - first, k, np.int32), draw % blocks[k], draw // blocks[k], shard.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["index", "block", "draw", "shard"])

    drawn = spark.range(int(chunks[-1])).mapInArrow(run, "index int, block long, draw long, shard int")
    # A block is drawn as often as the cap lets it, so its list is short.
    lists = drawn.groupBy("index", "block").agg(F.sort_array(F.collect_list(F.struct("draw", "shard"))).alias("d"))
    return lists.select("index", "block", F.col("d.shard").alias("shards"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = 3.0, seed: int = 11, key: str = "doc_id", text: str = "text", source: str = "source", sizes: Sizes = Sizes()) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (its source's words in the mix), ``copies`` and ``shards``.

    Sources stand in code point order, a null source last, and weigh ``weights`` over and over; they share as many words
    as ``docs`` has. A source gives at most ``cap`` times its own words, and what that cuts off goes to the others by
    weight. ``shards`` names the shard of each copy of the row that the mix takes, whole each time, and ``copies`` is their number.
    A source's taken words miss its target by
    at most half the smallest row of its last block that fits no more. The same input and seed give the same mix.

    A null text has no words. Rows that are equal in id and text stand or fall together; null ids are allowed. Rows
    without words follow their block, and never come more often than ``cap``. An empty table gives an empty result. Columns of ``docs`` that are named as one of
    the new columns are replaced. One row a source reaches the driver, with the running sums of the blocks at its end.
    Blocks meet their shards in a join whose other side is written first, so Spark knows its size: one row a block of ``sizes.block_words`` words.
    """
    sized = _sized(docs, key, text, source, seed)
    slim = written(sized.select("_source", "_size", "_order"), "mix-sizes")
    plans = _plan(slim, lambda k: weights[k % len(weights)], cap, sizes)
    spark = docs.sparkSession
    fields = [("_plan_source", pa.string()), ("_index", pa.int32()), ("_source_size", pa.int64()), ("_target", pa.float64()), ("_blocks", pa.int64()), ("_full", pa.int32()), ("_partial", pa.int64()), ("_picked", pa.list_(pa.int64()))]
    plan = _local(spark, [(p.source, p.index, p.size, p.target, p.blocks, p.full, p.partial, list(p.picked)) for p in plans], pa.schema(fields))
    draws = sum(p.draws for p in plans)
    if draws >= MOST_DRAWS:
        raise ValueError(f"{draws} block draws, and the hypergeometric law takes fewer than {MOST_DRAWS}: set larger sizes.block_words and sizes.block_rows")
    shards = max(1, math.ceil(sum(p.size for p in plans) / sizes.shard_words), min(sizes.least_shards, draws))
    deal = written(dealt(spark, plans, shards, seed), "mix-shards").select(F.col("index").alias("_index"), F.col("block").alias("_block"), F.col("shards").alias("_shards"))
    # Of the block in which a pass ends, all draws but the last are for every row.
    own = (F.col("_block") != F.col("_partial")) | F.array_contains("_picked", F.col("_order"))
    taken = F.when(own, F.col("_shards")).otherwise(F.slice("_shards", 1, F.col("_full")))
    new = ["size", "source_size", "target", "copies", "shards"]
    shards_ = F.coalesce(taken, F.array().cast("array<int>"))
    return (
        sized.join(plan, F.col("_source").eqNullSafe(F.col("_plan_source")))
        .withColumn("_block", _block(F.col("_blocks")))
        .join(deal, ["_index", "_block"], "left")
        .select(
            *(F.col(f"_row.`{c}`") for c in docs.columns if c not in new),
            F.col("_size").alias("size"),
            F.col("_source_size").alias("source_size"),
            F.col("_target").alias("target"),
            F.size(shards_).alias("copies"),
            shards_.alias("shards"),
        )
    )


def mixed_rows(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The rows of the mix, a row as often as it is taken, with the columns of ``docs``; each shard's rows are together and shuffled.

    Nulls, repeats and empty tables as in :func:`mix`.
    """
    kept = docs.columns
    key, text, source = (options.pop(c, d) for c, d in (("key", "doc_id"), ("text", "text"), ("source", "source")))
    # Columns that the mix adds may clash with those of docs: these travel as one.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col(key).alias("_id"), F.col(text).alias("_text"), F.col(source).alias("_from"))
    taken = mix(packed, seed=seed, key="_id", text="_text", source="_from", **options).select(
        "_row", F.xxhash64("_id", "_text").alias("_order"), F.posexplode("shards").alias("_copy", "_shard")
    )
    return (
        taken.repartition("_shard")
        .withColumn("_place", F.xxhash64(F.lit(seed + 1), "_order", "_copy"))
        .sortWithinPartitions("_shard", "_place")
        .select("_row.*")
    )
