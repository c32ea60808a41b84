"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. The perfect Golay code of length 23 puts every
segment within three bits of one codeword; its keys are the 12-bit indices of all codewords within four bits, one or
six of them. Two segments that differ in two bits or fewer have a word between them that is a bit at most from either,
so its codeword is among the keys of both. Of four differing bits, two segments of the three hold two at most: each
pair of segments gives keys of 24 bits, and every pair of fingerprints to be linked shares one. Rows that share a key
are compared exactly.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.llm.components import chunk_pairs, components, forest, whole_runs
from lodestream.llm.shared import arrow_column, texts_of, written

#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fixed value: the seed of the shingles' XXH64.
SEED = 42
#: Bits in which linked fingerprints differ at most; the keys above hold for no more.
RADIUS = 4
#: Rows with one key that a task compares itself.
BUCKET = 16_384


def fingerprint(text: str, shingle: int = 4) -> int:
    """The fingerprint of one text: of its lower-cased words' shingles, each bit by majority."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    digest, stops, set_bits = xxhash.xxh64_intdigest, ends[width - 1 :].tolist(), np.zeros(64, dtype=np.int64)
    for k in range(0, len(begins), 1 << 17):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins[k : k + (1 << 17)], stops[k : k + (1 << 17)], strict=True)], dtype="<u8")
        octets = hashes.view(np.uint8).reshape(-1, 8)
        set_bits += np.concatenate([np.bincount(octets[:, j], minlength=256) @ _octet_bits() for j in range(8)])
    return int(np.packbits(2 * set_bits > len(begins), bitorder="little").view("<u8")[0])


@functools.cache
def _octet_bits() -> np.ndarray:
    """(256, 8): the bits of each octet, lowest first."""
    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


@functools.cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Quotient and remainder of each high half by the generator; for each remainder the index offsets of the codewords within four bits, and which of the six are in use."""
    product = np.zeros(4096, dtype=np.int64)
    for k in range(12):
        product ^= np.where(np.arange(4096) >> k & 1, GENERATOR << k, 0)
    quotient, remainder = np.zeros(4096, dtype=np.int64), np.zeros(4096, dtype=np.int64)
    quotient[product >> 11] = np.arange(4096)
    remainder[product >> 11] = product & 2047
    offsets, used = np.zeros((2048, 6), dtype=np.int64), np.zeros((2048, 6), dtype=bool)
    words = np.array([0, *product[np.bitwise_count(product) == 7]])
    single = 1 << np.arange(23)
    errors = {0}
    for _ in range(3):
        errors |= {e ^ int(s) for e in errors for s in single}
    for e in sorted(errors, key=lambda e: (e.bit_count(), e)):
        syndrome = int(remainder[e >> 11] ^ e & 2047)
        near = words[np.bitwise_count(words ^ e) <= 4]
        # e = q * g + r, so the codeword that e is off from a word w lies at index q + (index of w).
        offsets[syndrome, : len(near)] = quotient[e >> 11] ^ quotient[near >> 11]
        used[syndrome, : len(near)] = True
    return quotient, remainder, offsets, used


def segment_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices of the codewords within four bits of each 23-bit word, and which of them are in use."""
    quotient, remainder, offsets, used = _golay()
    high = segment >> 11
    syndrome = remainder[high] ^ (segment & 2047)
    return quotient[high][:, None] ^ offsets[syndrome], used[syndrome]


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in ``prints``) of all keys of unsigned 64-bit fingerprints."""
    keys, used = zip(*(segment_keys((prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS), strict=True)
    out, rows = [], []
    for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        pair = (k << 24 | keys[i][:, :, None] << 12 | keys[j][:, None, :]).reshape(len(prints), -1)
        row, column = np.nonzero((used[i][:, :, None] & used[j][:, None, :]).reshape(len(prints), -1))
        out.append(pair[row, column])
        rows.append(row)
    return np.concatenate(out), np.concatenate(rows)


def _linked(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of one bucket: breadth first, each fingerprint against those not reached yet."""
    left, right = [], []
    open_ = np.arange(len(prints))
    while len(open_):
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            at = queue.pop()
            near = np.bitwise_count(prints[open_] ^ prints[at]) <= RADIUS
            if near.any():
                found, open_ = open_[near], open_[~near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found.tolist())
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, dtype=np.int64),) * 2


def _bucket_links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(print, root) over whole buckets sorted by key."""
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(begins, len(keys)))
    left, right = [], []
    for b, n in zip(begins[sizes > 32], sizes[sizes > 32], strict=True):
        x, y = _linked(prints[b : b + n])
        left.append(x + b)
        right.append(y + b)
    small = np.repeat(sizes <= 32, sizes)
    until = np.repeat(begins + sizes, sizes)
    at = np.flatnonzero(small)
    for step in range(1, 32):
        at = at[at + step < until[at]]
        if not len(at):
            break
        near = np.bitwise_count(prints[at] ^ prints[at + step]) <= RADIUS
        left.append(at[near])
        right.append(at[near] + step)
    if not left:
        return (np.zeros(0, dtype=np.int64),) * 2
    distinct, place = np.unique(prints.view(np.int64), return_inverse=True)
    return forest(distinct, place[np.concatenate(left)], place[np.concatenate(right)])


#: Six pieces of a fingerprint: of four differing bits, two pieces at least hold none, so linked fingerprints agree in one of the fifteen pairs.
PIECES = tuple((k * 64 // 6, (k + 1) * 64 // 6 - k * 64 // 6) for k in range(6))


def piece_keys(key: np.ndarray, prints: np.ndarray) -> Iterator[np.ndarray]:
    """For each pair of pieces, a number of the bucket ``key`` and what the fingerprints hold in the pair; unlike ones may share a number."""
    parts = [prints >> np.uint64(at) & np.uint64((1 << n) - 1) for at, n in PIECES]
    for number, (i, j) in enumerate(itertools.combinations(range(len(PIECES)), 2)):
        with np.errstate(over="ignore"):
            h = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (parts[i] << np.uint64(32) | parts[j] << np.uint64(8) | np.uint64(number))) * np.uint64(0xD6E8FEB86659FD93)
            yield (h ^ h >> np.uint64(31)).view(np.int64)


def print_links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links that span the components of the distinct fingerprints in ``distinct.print`` (long, read as unsigned).

    Keys hold 24 bits, so their buckets grow with the table. One with more than ``bucket`` fingerprints is dealt out again by
    pairs of pieces, which is exact too; what is still larger is compared chunk by chunk.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy()
            for k in range(0, len(prints), 4096):
                part = prints[k : k + 4096]
                keys, rows = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(part[rows])], names=["key", "print"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints = batch.column("key").to_numpy(), batch.column("print").to_numpy()
            for k in range(0, len(prints), 1 << 16):
                part = prints[k : k + (1 << 16)]
                for own in piece_keys(keys[k : k + (1 << 16)], part.view(np.uint64)):
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(part)], names=["key", "print"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, chunk in whole_runs(batches, "key", bucket):
            keys, prints = rows.column("key").to_numpy(), rows.column("print").to_numpy()
            if chunk[0] >= 0:
                yield pa.RecordBatch.from_arrays([pa.array(prints), pa.nulls(len(prints), pa.int64()), rows.column("key"), pa.array(chunk)], names=["a", "b", "key", "chunk"])
                continue
            a, b = _bucket_links(keys, prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64())], names=["a", "b", "key", "chunk"])

    def compared(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links within the buckets of (key, print), and the rows of those that are too large."""
        sorted_ = keys.repartition("key").sortWithinPartitions("key")
        found = written(sorted_.mapInArrow(compare, "a long, b long, key long, chunk long"), "print-links")
        return found.filter("b is not null").select("a", "b"), found.filter("b is null").select("key", F.col("a").alias("print"), "chunk")

    links, large = compared(distinct.select("print").mapInArrow(keyed, "key long, print long"))
    if large.isEmpty():
        return links
    more, crowded = compared(large.select("key", "print").mapInArrow(again, "key long, print long"))
    links = links.union(more)
    if crowded.isEmpty():
        return links

    def cell(rows: pd.DataFrame) -> pd.DataFrame:
        prints = np.unique(rows["print"].to_numpy())
        a, b = forest(prints, *_linked(prints.view(np.uint64)))
        return pd.DataFrame({"a": a, "b": b})

    return links.union(chunk_pairs(crowded, "key").groupBy("key", "lo", "hi").applyInPandas(cell, "a long, b long"))


def _printed(docs: DataFrame, shingle: int, text: str) -> Column:
    """The fingerprint of ``docs[text]`` as a long; only the text goes to Python."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            prints = [fingerprint(t, shingle) for texts in texts_of(column) for t in texts]
            yield pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return arrow_column(run, "long")(docs[text])


def _groups(prints: DataFrame, bucket: int) -> DataFrame:
    """(print, group) of all distinct fingerprints: group is the smallest fingerprint, as a signed number, that links reach."""
    distinct = written(prints.select("print").distinct(), "distinct-prints")
    label = written(components(print_links(distinct, bucket)), "print-labels").select(F.col("node").alias("print"), F.col("label").alias("_label"))
    return written(distinct.join(label, "print", "left").select("print", F.coalesce("_label", "print").alias("group")), "print-groups")


def near_duplicates(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(key, fingerprint, component_id) of each row: 16 hexadecimal digits, and the smallest key that links reach.

    Fingerprints link at ``RADIUS`` or fewer differing bits. A null or wordless text has fingerprint zero and is linked
    like any other; a text of fewer words than a shingle is one shingle. Rows with a null key take part in links;
    component_id is null only where no row of the component has a key. Repeated rows give repeated results; an empty
    table gives an empty one. Other columns are not read. Rows of equal fingerprint are one node, so copies are not paired.
    """
    prints = written(docs.select(F.col(key), _printed(docs, shingle, text).alias("print")), "prints")
    groups = _groups(prints, bucket)
    # The least key of each fingerprint first, so that copies are reduced before they meet their group.
    first = prints.groupBy("print").agg(F.min(key).alias("_first")).join(groups, "print")
    least = written(first.groupBy("group").agg(F.min("_first").alias("component_id")), "print-components")
    component = written(groups.join(least, "group").select("print", "component_id"), "print-component")
    return prints.join(component, "print").select(key, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest key, once; a row with a key comes before one without.

    Of rows with one key, or none, the smallest hash of the text decides, then that of the whole row; rows that are equal in
    all columns are one. So two unlike texts under one key both stay, if nothing else stands for them. Null and wordless
    texts are one component. Columns of any names are kept; an empty table gives an empty one.
    """
    flat = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f"`{f.name}`") for f in docs.schema]
    # Hashes tell a null from an empty value by place, so a row's own hash stands for all its columns.
    marks = [F.xxhash64(text).alias("_text_hash"), F.xxhash64(*flat, *(c.isNull() for c in flat)).alias("_row_hash")]
    rows = written(docs.select(F.col(key).alias("_key"), *marks, _printed(docs, shingle, text).alias("print")), "prints")
    order = F.struct(F.col("_key").isNull(), F.col("_key"), F.col("_text_hash"), F.col("_row_hash"))
    best = rows.groupBy("print").agg(F.min(order).alias("_best")).join(_groups(rows, bucket), "print").groupBy("group").agg(F.min("_best").alias("_best"))
    stay = best.select(F.col("_best._key").alias("_key"), F.col("_best._text_hash").alias("_text_hash"), F.col("_best._row_hash").alias("_row_hash"))
    met = rows.join(stay.withColumnsRenamed({"_key": "_k", "_text_hash": "_t", "_row_hash": "_r"}), (F.col("_text_hash") == F.col("_t")) & (F.col("_row_hash") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_k")))
    stay = written(met.groupBy("_k", "_t", "_r").agg((F.count("*") > 1).alias("_repeats")), "prints-that-stay")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(key).alias("_key"), *marks)
    same = (F.col("_text_hash") == F.col("_t")) & (F.col("_row_hash") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_k"))
    of = lambda repeats: packed.join(stay.filter("_repeats" if repeats else "not _repeats"), same, "left_semi")
    # Only rows that are there more than once must meet to become one.
    once = of(True).groupBy("_key", "_text_hash", "_row_hash").agg(F.first("_row").alias("_row")).select("_row.*")
    return of(False).select("_row.*").union(once)
