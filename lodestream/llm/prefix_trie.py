"""The prefix trie of conversations, by range minima over sorted common prefixes.

Conversations are sequences of turn digests, sorted by range into pieces of bounded size. Within a piece, the lengths of
the prefixes that neighbours share go into a sparse table of range minima; every prefix of every conversation searches how
far to the left, and then to the right, all neighbours share it. The interval between is the node's members. Sums over
subtrees are differences of running sums over intervals. A node that reaches over the edge of a piece is a row of partial
sums in each piece that it touches, keyed by its prefix; these few rows are added up afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import written

#: Bytes of a turn's digest.
UNIT = 16


def rebuilt(conversations: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, path, sizes): each conversation after its head is taken from its family's first conversation.

    The first h turns come from conversation c - c % ``family`` (all if it has fewer, none if there is none), the others are
    c's own beyond its first h, for h = crc32(decimal c) % ``heads``. ``path`` holds the turns' digests one after another,
    ``sizes`` the code points of their texts. Turns go by ``turn`` (null first), equal ones by role and digest; null roles
    and texts are empty; rows without conv_id belong to no conversation. Repeated rows are turns of their own.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * UNIT)
    turns = conversations.filter("conv_id is not null").select("conv_id", F.struct("turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("size")).alias("t"))
    ordered = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    own = written(ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")), "trie-turns")
    first = own.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("base"), "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    whole = both.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def shared_units(a: bytes | None, b: bytes | None) -> int:
    """Turns that two paths share from the start; -1 if one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b)) // UNIT
    return next((k for k in range(n) if a[k * UNIT : (k + 1) * UNIT] != b[k * UNIT : (k + 1) * UNIT]), n)


def prefix_keys(path: bytes, depth: int) -> list[bytes]:
    """Digests of a path's prefixes of 0 to ``depth`` turns."""
    spine, keys = hashlib.sha256(), []
    for k in range(depth + 1):
        spine.update(path[(k - 1) * UNIT : k * UNIT] if k else b"")
        keys.append(spine.digest())
    return keys


def minima(values: np.ndarray) -> np.ndarray:
    """Sparse table: [k, i] is the least of values[i : i + 2**k]; places beyond the end repeat the last whole one."""
    levels = [values]
    while (1 << len(levels)) <= len(values):
        half, last = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(last, np.append(last[half:], last[-half:])))
    return np.stack(levels)


def extents(low: np.ndarray, row: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(left, a function of some places for right): how far from ``row`` neighbours share ``depth`` turns, each side by binary search over the sparse table ``low``."""
    levels = range(len(low) - 1, -1, -1) if n > 1 else ()
    left = row.copy()
    for k in levels:
        at = left - (1 << k)
        left = np.where((at >= 0) & (low[k, np.maximum(at, 0)] >= depth), at, left)

    def right_of(places: np.ndarray) -> np.ndarray:
        right, least = row[places].copy(), depth[places]
        for k in levels:
            fits = right + (1 << k) <= n - 1
            right = np.where(fits & (low[k, np.minimum(right, n - 2)] >= least), right + (1 << k), right)
        return right

    return left, right_of


def range_least(table: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    k = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    return np.minimum(table[k, left], table[k, right - (1 << k) + 1])


NODE = (
    "piece long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, ends string"
)


def piece_nodes(rows: pa.Table, before: bytes | None, after: bytes | None) -> pa.Table:
    """The nodes that one piece's conversations (conv_id, path, sizes) lie below; ``before`` and ``after`` are the paths next to the piece."""
    rows = rows.sort_by([("path", "ascending"), ("conv_id", "ascending")])
    piece, ids = rows.column("piece")[0].as_py(), rows.column("conv_id").to_numpy()
    path = rows.column("path").cast(pa.large_binary()).combine_chunks()
    n = len(ids)
    ends_at = np.frombuffer(path.buffers()[1], np.int64, n + 1 + path.offset)[path.offset :]
    data = np.frombuffer(path.buffers()[2] or b"", np.uint8)[ends_at[0] : ends_at[-1]]
    units = data.view(np.uint64).reshape(-1, UNIT // 8)
    starts = (ends_at - ends_at[0]) // UNIT
    length = np.diff(starts)
    row = np.repeat(np.arange(n), length)
    depth = np.arange(len(row)) - starts[row] + 1

    # near[i]: turns shared by rows i - 1 and i, also across the piece's edges.
    near = np.empty(n + 1, dtype=np.int64)
    near[0], near[n] = shared_units(before, path[0].as_py()), shared_units(path[n - 1].as_py(), after)
    both = np.flatnonzero(row > 0)
    both = both[depth[both] <= length[row[both] - 1]]
    apart = both[(units[both] != units[starts[row[both] - 1] + depth[both] - 1]).any(axis=1)]
    near[1:n] = np.minimum(length[:-1], length[1:])
    np.minimum.at(near, row[apart], depth[apart] - 1)

    low = minima(near[1:n]) if n > 1 else np.zeros((1, 1), dtype=np.int64)
    left, right_of = extents(low, row, depth, n)
    own = np.flatnonzero(left == row)
    number = np.full(len(row), -1)
    number[own] = np.arange(len(own)) + 1
    # Node 0 is the root.
    first, deep, last = np.append(0, row[own]), np.append(0, depth[own]), np.append(n - 1, right_of(own))
    parent = np.zeros(len(first), dtype=np.int64)
    below = np.flatnonzero(deep > 1)
    upper = own[below - 1] - 1
    parent[below] = number[starts[left[upper]] + depth[upper] - 1]
    earlier = (first == 0) & (deep <= near[0])
    crossing = earlier | ((last == n - 1) & (deep <= near[n]))

    size = np.concatenate([[0], np.cumsum(rows.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False))]).astype(np.int64)
    whole = size[starts[1:]] - size[starts[:-1]]
    known = np.maximum(near[:n], 0)
    new = whole - (size[starts[:-1] + known] - size[starts[:-1]])
    run = lambda x: np.concatenate([[0], np.cumsum(x)])
    all_sizes, new_sizes, leaf = run(whole), run(new), run(near[1:] < length)
    above = np.maximum(deep - 1, 0)
    n_convs = last - first + 1
    begun = np.maximum(known[first], above)
    distinct = new_sizes[last + 1] - new_sizes[first + 1] + size[starts[first + 1]] - size[starts[first] + begun]
    saved = all_sizes[last + 1] - all_sizes[first] - n_convs * (size[starts[first] + above] - size[starts[first]]) - distinct
    n_children = np.bincount(parent[1:][~earlier[1:]], minlength=len(first))
    conv = range_least(minima(ids), first, last)

    same = np.append((length[1:] == length[:-1]) & (near[1:n] == length[1:]), False)
    stop = np.flatnonzero(~same)
    left_keys, right_keys = prefix_keys(path[0].as_py(), int(near[0])), prefix_keys(path[n - 1].as_py(), int(near[n]))
    key: list[bytes | None] = [None] * len(first)
    for i in np.flatnonzero(crossing):
        key[i] = (left_keys if earlier[i] else right_keys)[deep[i]]
    nothing = hashlib.sha256(b"").hexdigest()
    digests: list[str | None] = [None if c else nothing for c in crossing]
    texts: list[str | None] = [None] * len(first)
    for i in np.flatnonzero(length[first] == deep):
        text = ",".join(map(str, ids[first[i] : stop[np.searchsorted(stop, first[i])] + 1].tolist()))
        if crossing[i]:
            texts[i] = text
        else:
            digests[i] = hashlib.sha256(text.encode()).hexdigest()
    top = np.arange(len(first)) > 0
    return pa.table(
        {
            "piece": np.full(len(first), piece),
            "key": pa.array(key, pa.binary()),
            "parent_key": pa.array([key[p] if t else None for p, t in zip(parent, top, strict=True)], pa.binary()),
            "conv_id": conv,
            "depth": deep.astype(np.int64),
            "parent_conv_id": pa.array(conv[parent], mask=~(top & ~crossing[parent])),
            "n_convs": n_convs.astype(np.int64),
            "n_children": n_children.astype(np.int64),
            "n_leaves": (leaf[last + 1] - leaf[first]).astype(np.int64),
            "saved_tokens": saved.astype(np.int64),
            "ends_sha256": pa.array(digests, pa.string()),
            "ends": pa.array(texts, pa.string()),
        }
    )


def joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, sha256 of its texts joined by commas) of rows sorted by key and piece, one text at a time."""
    key, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "sha"])

    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends"), strict=True):
            if k == key:
                digest.update(b"," + text.as_py().encode())
                continue
            if digest is not None:
                yield done()
            key, digest = k, hashlib.sha256(text.as_py().encode())
    if digest is not None:
        yield done()


def trie(conversations: DataFrame, piece_turns: int = 1 << 17) -> DataFrame:
    """Every node of the trie over the rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The rules of :func:`rebuilt` hold for nulls, ties and repeated rows. The root has depth 0 and a null parent; a
    conversation without turns ends there. An empty table has no nodes. Other columns are not read. A piece holds about
    ``piece_turns`` turns and at least one conversation: one conversation's digests are what a task must hold.
    """
    spark = conversations.sparkSession
    paths = written(rebuilt(conversations), "trie-paths")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, base = 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            if batch.num_rows:
                run = turns + np.cumsum(batch.column("sizes").value_lengths().to_numpy().astype(np.int64) + 1)
                yield pa.RecordBatch.from_arrays([pa.array(base + (run - 1) // piece_turns), *batch.columns], names=["piece", *batch.schema.names])
                turns = int(run[-1])

    in_order = paths.repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = written(in_order.mapInArrow(numbered, "piece long, conv_id long, path binary, sizes array<bigint>"), "trie-pieces")
    edges = pieces.groupBy("piece").agg(F.min("path").alias("least"), F.max("path").alias("most"))
    # One row for each piece of about 2**17 turns.
    order = Window.orderBy("piece")
    edges = edges.select("piece", F.lag("most").over(order).alias("before"), F.lead("least").over(order).alias("after"))

    def nodes(rows: pa.Table, edge: pa.Table) -> pa.Table:
        return piece_nodes(rows, edge.column("before")[0].as_py(), edge.column("after")[0].as_py())

    found = written(pieces.groupBy("piece").cogroup(edges.groupBy("piece")).applyInArrow(nodes, NODE), "trie-nodes")
    spine = found.filter("key is not null")
    sums: list[Column] = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = written(spine.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), *sums), "trie-spine")
    ends = spine.filter("ends is not null").select("key", "piece", "ends").repartition("key").sortWithinPartitions("key", "piece").mapInArrow(joined_digests, "key binary, sha string")
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named"))
    across = merged.join(named, "parent_key", "left").join(ends, "key", "left")
    across = across.withColumns({"parent_conv_id": F.col("named"), "ends_sha256": F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest()))})
    # By piece as well, so that the many children of a node that all share are not one key.
    seen = spine.select("piece", F.col("key").alias("parent_key")).join(named, "parent_key")
    inner = found.filter("key is null").join(seen, ["piece", "parent_key"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "named"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return inner.select(columns).unionByName(across.select(columns))


#: The same rows as :func:`trie` of ``conversations``, in DuckDB; crc32 bit by bit over the digits of a non-negative id.
TRIE_SQL = """
WITH ordered AS (
    SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), digits AS (
    SELECT DISTINCT c, length(c::VARCHAR) AS n FROM ordered
), crc AS (
    WITH RECURSIVE step(c, k, x) AS (
        SELECT c, 0, 4294967295::BIGINT FROM digits
        UNION ALL
        SELECT c, k + 1, CASE WHEN k % 9 = 0 THEN xor(x, ascii(substr(c::VARCHAR, k // 9 + 1, 1))::BIGINT)
                              WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END
        FROM step WHERE k < 9 * length(c::VARCHAR)
    )
    SELECT c, xor(x, 4294967295::BIGINT) % 6 AS h FROM step WHERE k = 9 * length(c::VARCHAR)
), whole AS (
    SELECT o.c, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(o.turns, h + 1, len(o.turns))) AS turns
    FROM ordered o JOIN crc USING (c) LEFT JOIN ordered b ON b.c = o.c - o.c % 100
), prefixes AS (
    SELECT c, len(turns) AS n, d, list_slice(turns, 1, d)::VARCHAR AS own, list_slice(turns, 1, d - 1)::VARCHAR AS up,
           CASE WHEN d = 0 THEN 0 ELSE length(turns[d].text) END AS size
    FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM whole)
), nodes AS (
    SELECT own, d, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY own, d
), children AS (
    SELECT up, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), marked AS (
    SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.up = n.own AND k.d = n.d
), lines AS (
    SELECT m.own AS low, m.d AS low_d, m.saved, m.n_children, p.own, p.d
    FROM marked m JOIN prefixes x ON x.c = m.conv_id AND x.d <= m.d JOIN nodes p ON p.own = x.own AND p.d = x.d AND m.d >= p.d
), sums AS (
    SELECT own, d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM lines GROUP BY own, d
)
SELECT m.conv_id::BIGINT AS conv_id, m.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, m.n_convs::BIGINT AS n_convs, m.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums s USING (own, d) LEFT JOIN nodes p ON m.d > 0 AND p.own = m.up AND p.d = m.d - 1
"""
