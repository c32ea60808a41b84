"""Cutting a table into shards of near-equal bytes without parting rows of equal text.

Rows are ordered by a hash of their text, so equal texts are neighbours. The atoms of the partition are ``ATOMS``
ranges of that order, each a set of whole groups; only their sizes, a bounded number, reach the driver. There the
smallest capacity for which a greedy pass needs no more than the given shards is found by binary search, and the order
is cut so that no shard exceeds it. A group larger than an even share makes a shard of its own size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import text_of, written

#: Ranges of the hash order whose sizes the driver holds: a fixed number, whatever the input's size.
ATOMS_BITS = 16
#: Slots are numbered in cells of about so many rows, at least ``LEAST_CELLS`` a shard.
CELL_ROWS, LEAST_CELLS = 200_000, 32


def _reach(total: np.ndarray, start: int, capacity: int) -> int:
    """The furthest cut after ``start`` such that the atoms between hold at most ``capacity``; ``total``: running sums from 0."""
    return int(np.searchsorted(total, total[start] + capacity, side="right")) - 1


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity with which ``shards`` contiguous runs hold all atoms, by binary search over greedy checks."""
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(shards):
            at = _reach(total, at, capacity)
        return at == len(sizes)

    low, high = int(max(sizes, default=0)), int(total[-1])
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def minimax_cuts(sizes: np.ndarray, shards: int) -> list[int]:
    """``shards + 1`` cuts over the ordered atoms: no run is above the smallest feasible capacity, and each cut is as near to its even share as that allows."""
    capacity = smallest_capacity(sizes, shards)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    earliest = [len(sizes)]
    for _ in range(shards):
        earliest.append(int(np.searchsorted(total, total[earliest[-1]] - capacity, side="left")))
    earliest.reverse()
    cuts = [0]
    for k in range(1, shards):
        even = total[-1] * k / shards
        near = int(np.searchsorted(total, even))
        near -= near > 0 and even - total[near - 1] <= total[near] - even
        cuts.append(max(earliest[k], cuts[-1], min(near, _reach(total, cuts[-1], capacity))))
    return [*cuts, len(sizes)]


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", overhead: int = 8) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of each row.

    A row's size is its text's UTF-8 bytes plus ``overhead``; a null text has none, as an empty one, and both belong to
    one group. Rows of equal text share a shard; shard sizes are near equal, as far as atoms allow. Slots number each
    shard's rows from 0 without gaps, in an order fixed by key and text; repeated rows get slots of their own, in any
    order. Null keys are allowed. An empty table gives an empty result. Other columns are not read.
    """
    body = text_of(text)
    order = F.xxhash64(body)
    slim = written(
        docs.select(
            F.col(key),
            (F.octet_length(body) + overhead).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            order.alias("_order"),
        ),
        "shard-sizes",
    )
    atom = F.shiftrightunsigned("_order", 64 - ATOMS_BITS).cast("int")
    sums = slim.groupBy(atom.alias("atom")).agg(F.sum("size").alias("size"), F.count("*").alias("rows")).orderBy("atom").collect()
    cuts = minimax_cuts(np.array([r["size"] for r in sums], dtype=np.int64), shards)
    rows = sum(r["rows"] for r in sums)
    # The first atom of each shard; shards that hold nothing begin beyond the last atom.
    begins = [sums[c]["atom"] if c < len(sums) else 1 << ATOMS_BITS for c in cuts[1:-1]]
    number = sum((F.when(atom >= b, 1).otherwise(0) for b in begins), F.lit(0))
    cells = max(LEAST_CELLS, -(-rows // (shards * CELL_ROWS)))
    placed = slim.withColumn("shard", number.cast("int")).withColumn("_cell", F.pmod(F.xxhash64(F.col(key), F.lit(7), "_order"), F.lit(cells)).cast("int"))
    before = (
        placed.groupBy("shard", "_cell")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_first", F.sum("_rows").over(Window.partitionBy("shard").orderBy("_cell")) - F.col("_rows"))
        .select("shard", "_cell", "_first")
    )
    own = Window.partitionBy("shard", "_cell").orderBy(F.col(key), "_order")
    return (
        placed.withColumn("_own", F.row_number().over(own))
        .join(before, ["shard", "_cell"])
        .select(
            key,
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_first") + F.col("_own") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
