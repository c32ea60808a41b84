"""Media columns: chroma fingerprints of recordings, and their alignment.

A recording's spectrum is folded into pitch classes frame by frame. Sixteen filters, differences of rectangles over the
frames by pitch classes, are read off an integral image; each answer becomes two bits of a Gray code, so every window of
frames gives one packed 32-bit integer. Two recordings are aligned by a histogram of offsets, into which every equal run of
six filters' codes votes: where a quarter of the bits differ, whole integers seldom agree, while such runs do. The share of
differing bits is taken at every offset whose bar is high enough for its overlap, and the offset of the least one counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.llm.shared import written

CLASSES, SPAN = 12, 16
#: Numbers of one array while recordings are aligned.
TILE = 1 << 21
#: Runs of six filters in a print.
RUNS = 4


@dataclass(frozen=True)
class Print:
    """Production parameters of fingerprints and matches."""

    rate: int = 4000
    frame: int = 1024
    hop: int = 256
    lowest: float = 60.0
    highest: float = 1800.0
    #: Answers beyond this log ratio take the outer codes.
    step: float = 0.25
    #: Largest share of differing bits, and least overlap as a share of the shorter recording.
    most_errors: float = 0.25
    least_overlap: float = 0.5
    #: Equal runs for each overlapping integer, of four, that a bar needs for its offset to be judged.
    votes: float = 0.08
    #: Different queries, and their integers, that go to the tasks at once.
    block: int = 2000
    block_prints: int = 1 << 22


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, frames) of the sixteen filters, by rule: four shapes of difference at four scales."""
    return [(kind, (5 * kind + 3 * scale) % (CLASSES - height + 1), height, SPAN >> shift) for kind in range(4) for scale, (height, shift) in enumerate(((2, 2), (3, 1), (4, 0), (6, 0)))]


def chroma(pcm: np.ndarray, p: Print) -> np.ndarray:
    """(frames, 12) energy by pitch class, each frame of unit length; frames of silence are zero."""
    if len(pcm) < p.frame:
        return np.zeros((0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(pcm.astype(np.float32), p.frame)[:: p.hop]
    energy = np.abs(np.fft.rfft(frames * np.hanning(p.frame).astype(np.float32), axis=1)) ** 2
    hz = np.fft.rfftfreq(p.frame, 1 / p.rate)
    use = (hz >= p.lowest) & (hz <= p.highest)
    fold = np.zeros((len(hz), CLASSES))
    fold[np.flatnonzero(use), np.round(CLASSES * np.log2(hz[use] / 440.0)).astype(int) % CLASSES] = 1
    folded = energy @ fold
    size = np.linalg.norm(folded, axis=1, keepdims=True)
    return np.divide(folded, size, out=np.zeros_like(folded), where=size > 1e-6)


def packed(image: np.ndarray, p: Print) -> np.ndarray:
    """One unsigned 32-bit integer for each window of SPAN frames."""
    n = len(image) - SPAN + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    total = np.zeros((len(image) + 1, CLASSES + 1))
    total[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return total[at + t1, c1] - total[at + t0, c1] - total[at + t1, c0] + total[at + t0, c0]

    out = np.zeros(n, dtype=np.uint32)
    for k, (kind, c, height, width) in enumerate(_filters()):
        whole = area(0, width, c, c + height)
        if kind == 0:  # later against earlier
            part = area(width // 2, width, c, c + height)
        elif kind == 1:  # upper classes against lower ones
            part = area(0, width, c + height // 2, c + height)
        elif kind == 2:  # two corners against the other two
            part = area(0, width // 2, c, c + height // 2) + area(width // 2, width, c + height // 2, c + height)
        else:  # the middle against both ends
            part = area(width // 4, width - width // 4, c, c + height)
        answer = np.log((part + 0.01) / (whole - part + 0.01))
        level = (answer > -p.step).astype(np.uint32) + (answer > 0) + (answer > p.step)
        out |= (level ^ level >> 1).astype(np.uint32) << np.uint32(2 * k)
    return out


def fingerprints(recordings: DataFrame, p: Print = Print(), key: str = "id", pcm: str = "pcm") -> DataFrame:
    """(key, prints) of each recording: ``pcm`` holds signed 16-bit little-endian samples, one channel, at ``p.rate``.

    Null, empty and too short recordings have an empty array, as silence has equal numbers; an odd last byte is left
    out. Repeated rows give repeated results, an empty table an empty one; other columns are not read. Needs no shuffle.
    """
    schema = T.StructType([recordings.schema[key], T.StructField("prints", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = []
            for sound in batch.column(pcm):
                raw = sound.as_py() or b""
                prints.append(packed(chroma(np.frombuffer(raw[: len(raw) // 2 * 2], "<i2"), p), p).view(np.int32))
            ends = pa.array(np.cumsum([0, *map(len, prints)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *prints])))], names=schema.names)

    return recordings.select(key, pcm).mapInArrow(run, schema)


@dataclass
class _Runs:
    """An index of some queries' runs: for each of ``RUNS`` times 4096 codes, a run at its place, where the queries have it."""

    numbers: np.ndarray
    flat: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    #: The query of each run, by code, and the bar that a vote of a row's first place goes to, over rows of one integer.
    owner: np.ndarray
    bar: np.ndarray
    first: np.ndarray
    #: Over rows of ``width`` integers: the bar of each run, and of each bar its query, its offset, and the votes that it needs.
    width: int = 0
    wide: np.ndarray | None = None
    query: np.ndarray | None = None
    offset: np.ndarray | None = None
    needed: np.ndarray | None = None

    @staticmethod
    def of(numbers: np.ndarray, queries: list[np.ndarray]) -> _Runs:
        own = [queries[k] for k in numbers]
        lengths = np.array([len(x) for x in own])
        begins = np.cumsum(lengths) - lengths
        owner, flat = np.repeat(np.arange(len(own)), lengths), np.concatenate(own).view(np.uint32)
        bar = 2 * begins[owner] + lengths[owner] - 1 - np.arange(len(flat))
        codes = _codes(flat)
        order = np.argsort(codes, kind="stable")
        return _Runs(numbers, flat, begins, lengths, owner[order // RUNS], bar[order // RUNS], np.searchsorted(codes[order], np.arange(RUNS * 4096 + 1)))

    def widen(self, n: int, p: Print) -> None:
        """Make ready for rows of ``n`` integers; offsets with too little overlap need more votes than there are."""
        if self.width == n:
            return
        self.width, self.wide = n, self.bar + self.owner * (n - 1)
        bars = self.lengths + n - 1
        self.query = np.repeat(np.arange(len(bars)), bars)
        length = self.lengths[self.query]
        self.offset = np.arange(bars.sum()) - np.repeat(np.cumsum(bars) - bars, bars) - length + 1
        both = np.minimum(n - np.maximum(0, self.offset), length - np.maximum(0, -self.offset))
        enough = both >= np.maximum(1, p.least_overlap * np.minimum(n, length))
        self.needed = np.where(enough, np.maximum(1, np.ceil(p.votes * both)), RUNS * n + 1).astype(np.int64)

    def bars(self, x: np.ndarray) -> np.ndarray:
        """Equal runs of a row of ``width`` integers and each query by offset; query ``q`` has ``lengths[q] + width - 1`` bars, one after the other."""
        codes = _codes(x)
        counts = self.first[codes + 1] - self.first[codes]
        ends, place = np.cumsum(counts), np.arange(len(codes)) // RUNS
        out, start = None, 0
        while start < len(codes):
            before = ends[start - 1] if start else 0
            own = slice(start, max(start + 1, int(np.searchsorted(ends, TILE + before, side="right"))))
            at = np.repeat(self.first[codes[own]] - (ends[own] - counts[own] - before), counts[own]) + np.arange(counts[own].sum())
            part = np.bincount(self.wide[at] + np.repeat(place[own], counts[own]), minlength=len(self.query))
            out, start = part if out is None else out + part, own.stop
        return out


def _codes(prints: np.ndarray) -> np.ndarray:
    """The runs of each integer: twelve bits, six filters, from every eighth bit on, around the end, each told from the others by its place."""
    turned = [(prints >> np.uint32(8 * k) | prints << np.uint32(32 - 8 * k) if k else prints) & np.uint32(4095) for k in range(RUNS)]
    return (np.stack(turned, axis=1).astype(np.int64) + np.arange(RUNS) * 4096).ravel()


class Histograms:
    """Alignment of rows with a block of queries by histograms of offsets. No recording may be empty."""

    def __init__(self, queries: list[np.ndarray], p: Print = Print()):
        self.queries, self.p = queries, p
        self.lengths = np.array([len(q) for q in queries], dtype=np.int64)
        self.parts: dict[int, list[_Runs]] = {}

    def _parts(self, n: int) -> list[_Runs]:
        """The queries in parts, so that histograms and votes of a row of up to ``n`` integers stay small: long rows meet few queries at once."""
        if n not in self.parts and len(self.lengths):
            heavy = np.cumsum(np.maximum(self.lengths, 1) * n // 32 + self.lengths + n) // TILE
            self.parts[n] = [_Runs.of(own, self.queries) for own in np.split(np.arange(len(self.lengths)), np.flatnonzero(np.diff(heavy)) + 1)]
        return self.parts.get(n, [])

    def aligned(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, query, share of differing bits, offset) of every pair that fits at an offset with enough votes, by number.

        Of a pair's offsets the one of the least share counts, of equal shares the one nearest to zero.
        """
        out = [[np.zeros(0, np.int64)] * 2 + [np.zeros(0)] + [np.zeros(0, np.int64)]]
        for k in sorted(range(len(rows)), key=lambda k: len(rows[k])):
            for part in self._parts(1 << (len(rows[k]) - 1).bit_length()):
                query, share, offset = self._judged(np.ascontiguousarray(rows[k]).view(np.uint32), part)
                out.append([np.full(len(query), k), query, share, offset])
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _judged(self, x: np.ndarray, part: _Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, n = self.p, len(x)
        part.widen(n, p)
        hit = np.flatnonzero(part.bars(x) >= part.needed)
        q, offset = part.query[hit], part.offset[hit]
        both = np.minimum(n - np.maximum(0, offset), part.lengths[q] - np.maximum(0, -offset))
        share, cuts = np.zeros(len(q)), np.flatnonzero(np.diff(np.cumsum(both) // TILE)) + 1
        for own in np.split(np.arange(len(q)), cuts):
            if len(own):
                ends = np.cumsum(both[own])
                within = np.arange(ends[-1]) - np.repeat(ends - both[own], both[own])
                mine = x[np.repeat(np.maximum(0, offset[own]), both[own]) + within]
                theirs = part.flat[np.repeat(part.begins[q[own]] + np.maximum(0, -offset[own]), both[own]) + within]
                share[own] = np.add.reduceat(np.bitwise_count(mine ^ theirs).astype(np.int64), ends - both[own]) / (32 * both[own])
        fits = share <= p.most_errors
        q, offset, share = q[fits], offset[fits], share[fits]
        order = np.lexsort((offset, np.abs(offset), share, q))
        best = order[np.flatnonzero(np.diff(q[order], prepend=-1))]
        return part.numbers[q[best]], share[best], offset[best]


def _spectra(prints: list[np.ndarray], n: int, kind: type) -> np.ndarray:
    """(frequencies, recordings, 32): spectra of each bit as a signal of ones and minus ones, zeros after its end."""
    signal = np.zeros((len(prints), 32, n), dtype=kind)
    for k, x in enumerate(prints):
        bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), 4), axis=1)
        signal[k, :, : len(x)] = bits.T.astype(np.int8) * 2 - 1
    return np.ascontiguousarray(np.fft.rfft(signal, axis=2).transpose(2, 0, 1))


def alignments(rows: list[np.ndarray], queries: list[np.ndarray], p: Print) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, query, share of differing bits, offset) of every pair that fits, by number, at its best offset: the exhaustive search, by which :class:`Histograms` is measured.

    All offsets of all pairs are judged: the sum over the bits of their cross-correlations, taken by way of the spectra,
    is the count of equal bits less that of differing ones. Of equal shares the offset nearest to zero counts. No recording may be empty.
    """
    out = [[np.zeros(0, np.int64)] * 2 + [np.zeros(0)] + [np.zeros(0, np.int64)]]
    by_row, by_query = (sorted(range(len(x)), key=lambda k: len(x[k])) for x in (rows, queries))
    longest = max(map(len, rows), default=1) + max(map(len, queries), default=1)
    at_once = max(1, min(256, TILE // (64 * longest)))
    for i in range(0, len(by_row), at_once):
        own = by_row[i : i + at_once]
        left = {}
        for j in range(0, len(by_query), at_once):
            theirs = by_query[j : j + at_once]
            mine, other = np.array([len(rows[k]) for k in own]), np.array([len(queries[k]) for k in theirs])
            n = 1 << int(mine.max() + other.max() - 1).bit_length()
            # Sums stay so small that rounding gives the exact integers.
            kind = np.float32 if n <= 1 << 14 else np.float64
            if n not in left:
                left = {n: _spectra([rows[k] for k in own], n, kind)}
            right = _spectra([queries[k] for k in theirs], n, kind).conj().transpose(0, 2, 1)
            step = max(1, TILE // (len(theirs) * n))
            shift = np.arange(n)
            shift[shift >= mine.max()] -= n
            late = other[:, None] - np.maximum(0, -shift)
            for k in range(0, len(own), step):
                part = mine[k : k + step]
                agree = np.fft.irfft((left[n][:, k : k + step] @ right).transpose(1, 2, 0), n, axis=2)
                both = np.minimum((part[:, None] - np.maximum(0, shift))[:, None], late[None]).astype(kind)
                least = np.maximum(1, p.least_overlap * np.minimum(part[:, None], other[None]))[:, :, None]
                hit = np.flatnonzero((agree >= both * kind(32 * (1 - 2 * p.most_errors)) - kind(0.5)) & (both >= least))
                if not len(hit):
                    continue
                at, offset = hit // n, shift[hit % n]
                overlap = 32 * both.ravel()[hit].astype(np.int64)
                share = (overlap - np.rint(agree.ravel()[hit]).astype(np.int64)) // 2 / overlap
                fits = share <= p.most_errors
                at, offset, share = at[fits], offset[fits], share[fits]
                order = np.lexsort((offset, np.abs(offset), share, at))
                best = order[np.flatnonzero(np.diff(at[order], prepend=-1))]
                r, q = np.array(own)[k + at[best] // len(theirs)], np.array(theirs)[at[best] % len(theirs)]
                out.append([r, q, share[best], offset[best]])
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def align(prints: DataFrame, p: Print = Print(), key: str = "id", every: int = 100) -> DataFrame:
    """(key, n_prints, prints_sha256, match_id, match_offset, bit_errors, matches) of each recording.

    Queries are the rows whose key is divisible by ``every``; all rows are searched for them, in blocks of ``p.block``
    different recordings by histograms of offsets. ``matches`` lists every other query found to fit the row as (bit_errors, match_id, match_offset), the
    best one first: match_offset says by how many prints the row starts earlier. Queries with equal prints are one entry,
    under the smallest id that is not the row's own; they share prints_sha256. The three columns before repeat the first
    entry; they are null, and the list is empty, where no query fits. A row without prints or with a null key is no query; a
    row without prints matches nothing. Repeated rows give repeated results; an empty table gives an empty one.
    """
    numbered = prints.select(F.col(key).alias("_id"), "prints").withColumn("_row", F.monotonically_increasing_id())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [hashlib.sha256(x.values.to_numpy().astype("<i4").tobytes()).hexdigest() for x in batch.column("prints")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], names=[*batch.schema.names, "prints_sha256"])

    numbered = written(numbered.mapInArrow(digest, T.StructType([*numbered.schema, T.StructField("prints_sha256", T.StringType())])), "audio-prints")
    asked = numbered.filter((F.col("_id") % every == 0) & (F.size("prints") > 0)).select("_id", "prints", "prints_sha256")
    # The smallest id of each different recording, and the next one for the row that has the smallest.
    first = asked.groupBy("prints_sha256").agg(F.min("_id").alias("_first"), F.min("prints").alias("prints"))
    second = asked.join(first.select("prints_sha256", "_first"), "prints_sha256").filter("_id > _first").groupBy("prints_sha256").agg(F.min("_id").alias("_second"))
    queries = first.join(second, "prints_sha256", "left").select("_first", "_second", "prints").orderBy("_first", "prints")
    fit = T.StructType.fromDDL("_row long, bit_errors double, match_id long, match_offset int")

    def search(block: list) -> DataFrame:
        sent = prints.sparkSession.sparkContext.broadcast(([(r["_first"], r["_second"]) for r in block], [np.array(r["prints"], dtype=np.int32) for r in block]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, theirs = sent.value
            histograms = Histograms(theirs, p)
            for batch in batches:
                own, mine = batch.column("_id").to_pylist(), [x.values.to_numpy() for x in batch.column("prints")]
                full = [k for k, x in enumerate(mine) if len(x)]
                row, query, share, offset = histograms.aligned([mine[k] for k in full])
                row = np.array(full, dtype=np.int64)[row]
                other = [ids[q][own[r] == ids[q][0]] for r, q in zip(row.tolist(), query.tolist(), strict=True)]
                cols = [batch.column("_row").take(pa.array(row)), pa.array(share), pa.array(other, pa.int64()), pa.array(offset, pa.int32())]
                found = pa.RecordBatch.from_arrays(cols, names=fit.names)
                yield found.filter(found.column("match_id").is_valid())

        return numbered.select("_row", "_id", "prints").mapInArrow(run, fit)

    found, block, held = None, [], 0
    for r in queries.toLocalIterator():
        block.append(r)
        held += len(r["prints"])
        if len(block) == p.block or held >= p.block_prints:
            part = search(block)
            found, block, held = part if found is None else found.union(part), [], 0
    if block or found is None:
        part = search(block)
        found = part if found is None else found.union(part)
    matches = found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("bit_errors", "match_id", "match_offset"))).alias("m"))
    best = F.get("m", F.lit(0))
    return (
        numbered.select("_row", F.col("_id").alias(key), F.size("prints").cast("long").alias("n_prints"), "prints_sha256")
        .join(matches, "_row", "left")
        .select(key, "n_prints", "prints_sha256", best["match_id"].alias("match_id"), best["match_offset"].alias("match_offset"), best["bit_errors"].alias("bit_errors"), F.coalesce("m", F.array().cast(matches.schema["m"].dataType)).alias("matches"))
    )


def sonified(vectors: DataFrame, p: Print = Print(), key: str = "vec_id", vector: str = "embedding", note: int = 512) -> DataFrame:
    """(key, pcm): each vector as a melody, one note a component, whose pitch is the component's place among its peers.

    It turns a table without sound into recordings: near-equal vectors give near-equal melodies. Recordings begin
    key modulo 8 notes late, so equal melodies lie at an offset. Null components count as zero; a null vector is a null recording.
    """
    schema = T.StructType([vectors.schema[key], T.StructField("pcm", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        time = np.arange(note) / p.rate
        fade = np.minimum(1, np.minimum(np.arange(note), np.arange(note)[::-1]) / 40)
        tone = [(np.sin(2 * np.pi * 220 * 2 ** (k / 12) * time) * fade * 8000).astype("<i2") for k in range(24)]
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part, sounds = batch.slice(k, 256), []
                for i, v in zip(part.column(key).to_pylist(), part.column(vector).to_pylist(), strict=True):
                    if v is None:
                        sounds.append(None)
                        continue
                    x = np.nan_to_num(np.array([c or 0.0 for c in v], dtype=np.float64))
                    level = np.clip(np.floor(12 + 3 * x / max(1e-9, np.sqrt((x * x).mean()))), 0, 23).astype(int) if len(x) else []
                    sounds.append(b"".join(tone[c].tobytes() for c in level[(i or 0) % 8 :]))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(sounds, pa.binary())], names=schema.names)

    return vectors.select(key, vector).mapInArrow(run, schema)
