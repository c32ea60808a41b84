"""Language-model scores from a lattice of subword pieces.

A text is a run of words and one end. A word, with its mark of beginning, can be cut into pieces of an existing
vocabulary in many ways; its probability is the sum over all of them of the product of the pieces' probabilities, which a
forward recursion in log space gives. The pieces' probabilities start from the vocabulary's ranks and are fitted to the
training rows' words by expectation and maximisation, over all distinct words with their counts.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.llm.shared import id_remainder, text_of, texts_in, written

#: The most words that every task knows without a join, the most frequent ones. All others are joined.
HEAD_WORDS = 200_000
#: Rounds of fitting, and the count that each piece has before any.
ROUNDS, PRIOR = 2, 0.01
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
_BEGIN = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A ``sentencepiece`` vocabulary as a lattice: pieces by length and hash, and bytes for characters that are no piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = np.full(256, -1, dtype=np.int64)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                by_length.setdefault(len(piece), []).append((int(self._prefix(np.array([[ord(c) for c in piece]]))[0, -1]), i))
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary has no piece for some byte")
        #: The end of a text is one more piece.
        self.end, self.size = n, n + 1
        self.longest = max(by_length)
        self.tables = {}
        for k, found in by_length.items():
            found.sort()
            self.tables[k] = (np.array([h for h, _ in found], dtype=np.uint64), np.array([i for _, i in found], dtype=np.int64))
        usable = np.array(sorted([i for _, ids in self.tables.values() for i in ids] + self.bytes.tolist() + [self.end]))
        weights = np.zeros(self.size)
        weights[usable] = 1 / (10.0 + np.arange(len(usable)))
        self.usable = usable
        self.start = np.log(weights / weights.sum(), out=np.full(self.size, -np.inf), where=weights > 0)

    @staticmethod
    def _prefix(codes: np.ndarray) -> np.ndarray:
        """(n, L + 1) hashes of the prefixes of each row of characters."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(codes.shape[1]):
                out[:, j + 1] = out[:, j] * _BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
        return out

    @functools.cached_property
    def powers(self) -> np.ndarray:
        out = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(self.longest):
                out.append(out[-1] * _BASE)
        return np.array(out, dtype=np.uint64)

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, int]]:
        """(numbers of words, their length with the mark of beginning): words of one length, in parts of bounded size."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(cuts, cuts[1:], strict=False):
            size = int(lengths[order[a]])
            step = max(1, 4_000_000 // (size * 8))
            for k in range(a, b, step):
                yield order[k : min(k + step, b)], size

    def edges(self, words: list[str], size: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, rows, ids) of all pieces in words of one length (with the mark of beginning); ids is 2-d for runs of byte pieces."""
        codes = np.frombuffer("".join(_BEGIN + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), size)
        prefix, out = self._prefix(codes), []
        for j in range(1, size + 1):
            spelled = np.ones(len(words), dtype=bool)
            with np.errstate(over="ignore"):
                for n in range(1, min(self.longest, j) + 1):
                    if n not in self.tables:
                        continue
                    hashes, ids = self.tables[n]
                    own = prefix[:, j] - prefix[:, j - n] * self.powers[n]
                    at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                    hit = np.flatnonzero(hashes[at] == own)
                    if n == 1:
                        spelled[hit] = False
                    if len(hit):
                        out.append((j - n, j, hit, ids[at[hit]]))
            rest = np.flatnonzero(spelled)
            if len(rest):
                spelling: dict[int, list[int]] = {}
                for r in rest:
                    spelling.setdefault(int(codes[r, j - 1]), []).append(int(r))
                for code, rows in spelling.items():
                    run = self.bytes[list(chr(code).encode("utf-8", "surrogatepass"))]
                    out.append((j - 1, j, np.array(rows), np.tile(run, (len(rows), 1))))
        return out

    def _forward(self, edges: list, n: int, size: int, score: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        alpha = np.full((size + 1, n), -np.inf)
        alpha[0] = 0
        weights = [score[ids] if ids.ndim == 1 else score[ids].sum(axis=1) for *_, ids in edges]
        for (i, j, rows, _), w in zip(edges, weights, strict=True):
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + w)
        return alpha, weights

    def score(self, words: list[str], score: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability over all its segmentations."""
        out = np.zeros(len(words))
        for own, size in self.groups(words):
            part = [words[k] for k in own]
            alpha, _ = self._forward(self.edges(part, size), len(part), size, score)
            out[own] = alpha[size]
        return out

    def expect(self, words: list[str], counts: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Expected count of each piece in the words, under ``score``."""
        total = np.zeros(self.size)
        for own, size in self.groups(words):
            part = [words[k] for k in own]
            edges = self.edges(part, size)
            alpha, weights = self._forward(edges, len(part), size, score)
            beta = np.full((size + 1, len(part)), -np.inf)
            beta[size] = np.log(counts[own]) - alpha[size]
            for (i, j, rows, ids), w in zip(reversed(edges), reversed(weights), strict=True):
                onward = beta[j, rows] + w
                beta[i, rows] = np.logaddexp(beta[i, rows], onward)
                share = np.exp(alpha[i, rows] + onward)
                if ids.ndim == 1:
                    total += np.bincount(ids, weights=share, minlength=self.size)
                else:
                    total += np.bincount(ids.ravel(), weights=np.repeat(share, ids.shape[1]), minlength=self.size)
        return total


@functools.cache
def pieces_at(path: str) -> Pieces:
    """The vocabulary at ``path``, read once in each worker process."""
    return Pieces(path)


def _split(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def word_counts(docs: DataFrame, key: str, text: str, training: int = 2) -> DataFrame:
    """(word, train, total) over all rows of ``docs``; the row with a null word counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            for c, learnt in zip(held, (False, True), strict=True):
                n = pa.array(list(c.values()), pa.int64())
                none = pa.array(np.zeros(len(c), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), n if learnt else none, n], names=["word", "train", "total"])
                c.clear()

        for batch in batches:
            learn = batch.column("learn").to_pylist()
            for start, texts in texts_in(batch):
                for k, t in enumerate(texts, start):
                    held[learn[k]].update(_split(t))
                    held[learn[k]][None] += 1
                if len(held[0]) + len(held[1]) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    learn = F.coalesce(id_remainder(key, 7) != training, F.lit(True)).alias("learn")
    rows = docs.select(text_of(text).alias("text"), learn).mapInArrow(run, "word binary, train long, total long")
    return rows.groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total"))


def fit(words: DataFrame, ends: int, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Natural logs of the pieces' probabilities, from the training counts of all distinct words. Expected counts, one for each piece, reach the driver."""
    pieces = pieces_at(path)
    score = pieces.start
    for _ in range(rounds):
        sent = score

        def expect(batches: Iterator[pa.RecordBatch], score: np.ndarray = sent) -> Iterator[pa.RecordBatch]:
            own, total = pieces_at(path), 0
            for batch in batches:
                words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
                total = total + own.expect(words, batch.column("train").to_numpy().astype(float), score)
            if np.ndim(total):
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["piece", "n"])

        found = words.filter("train > 0").select("word", "train").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(pieces.size, -np.inf)
        counts[pieces.usable] = PRIOR
        for r in found:
            counts[r["piece"]] = PRIOR + r["n"]
        counts[pieces.end] = PRIOR + ends
        total = counts[pieces.usable].sum()
        score = np.log(counts / total, out=np.full(pieces.size, -np.inf), where=counts > 0)
    return score


def score_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", held_remainder: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each whole text.

    Rows are held out of the training if crc32 of the key as text modulo 7 is ``held_remainder``; a null key has no such
    remainder, so held_out is null and the row trains. A null text counts as an empty one: its only token is the end.
    base_score is the add-one unigram log10 over words, score the lattice's log10 over pieces. Repeated rows count and
    are scored as often as they occur; an empty table gives an empty result. Other columns are not read.

    Word counts cover all rows and are combined before they are shuffled. The ``HEAD_WORDS`` most frequent words go to
    every task; a text's other words are joined to their counts, each word once a text, so no common word gathers rows.
    """
    spark = docs.sparkSession
    counted = written(word_counts(docs, key, text, held_remainder), "lm-counts")
    words = counted.filter("word is not null")
    ends = counted.filter("word is null").agg(F.coalesce(F.sum("train"), F.lit(0))).first()[0]
    sums = words.agg(F.coalesce(F.sum("train"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("train") > 0).cast("long")), F.lit(0)).alias("v")).first()
    n, v = sums["n"] + ends, sums["v"] + (ends > 0)
    piece_score = fit(words, ends, path)
    per_ten = 1 / math.log(10)
    base_of = F.log10((F.col("train") + 1) / F.lit(float(n + v + 1)))

    def lattice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces_at(path)
        for batch in batches:
            score = own.score([w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()], piece_score) * per_ten
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=["word", "train", "total", "score"])

    scored = written(
        words.mapInArrow(lattice, "word binary, train long, total long, score double").select("word", "total", (F.col("train") > 0).cast("long").alias("known"), base_of.alias("base"), "score"),
        "lm-words",
    )
    # The rank of the last head word comes from a histogram of counts on a log scale, a few hundred rows at any size.
    level = F.floor(F.log2("total") * 16).cast("long")
    histogram = scored.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    held, lowest = 0, 1 << 40
    for r in histogram:
        held += r["n"]
        if held > HEAD_WORDS:
            break
        lowest = r["level"]
    head = scored.filter(level >= lowest).select("word", "known", "base", "score").toArrow()
    values = np.stack([head.column(c).to_numpy().astype(np.float64) for c in ("known", "base", "score")], axis=1)
    sent = spark.sparkContext.broadcast(pickle.dumps((head.column("word").to_pylist(), values), protocol=5))
    del head, values
    end_base, end_score = math.log10((ends + 1) / (n + v + 1)), float(piece_score[pieces_at(path).end]) * per_ten

    tail_type = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]))
    schema = T.StructType(
        [docs.schema[key]]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
        + [T.StructField(c, T.DoubleType()) for c in ("base", "score")]
        + [T.StructField("tail", tail_type)]
    )
    arrow_tail = pa.struct([("word", pa.binary()), ("n", pa.int64())])

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, values = pickle.loads(sent.value)
        number = {w: k for k, w in enumerate(head)}
        values = np.concatenate([values, np.zeros((1, 3))])
        for batch in batches:
            for start, texts in texts_in(batch, text):
                tokens, sum_, tail_words, tail_n, tail_ends = [], [], [], [], [0]
                for t in texts:
                    count = Counter(_split(t))
                    ids = np.fromiter((number.get(w, -1) for w in count), np.int64, len(count))
                    times = np.fromiter(count.values(), np.int64, len(count))
                    tokens.append(int(times.sum()) + 1)
                    sum_.append(times @ values[ids] if len(ids) else np.zeros(3))
                    own = list(count)
                    for k in np.flatnonzero(ids < 0):
                        tail_words.append(own[k])
                        tail_n.append(int(times[k]))
                    tail_ends.append(len(tail_words))
                sums = np.array(sum_).reshape(-1, 3)
                tail = pa.ListArray.from_arrays(
                    pa.array(tail_ends, pa.int32()), pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(tail_n, pa.int64())], fields=list(arrow_tail))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(start, len(texts)).column(key),
                        pa.array(tokens, pa.int64()),
                        pa.array(sums[:, 0].astype(np.int64) + (ends > 0)),
                        pa.array(sums[:, 1] + end_base),
                        pa.array(sums[:, 2] + end_score),
                        tail,
                    ],
                    names=schema.names,
                )

    rows = written(docs.select(key, text).mapInArrow(known, schema).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rest = (
        rows.select("row", F.explode("tail").alias("t"))
        .select("row", "t.word", "t.n")
        .join(scored.select("word", "known", "base", "score"), "word")
        .groupBy("row")
        .agg(*(F.sum(F.col("n") * F.col(c)).alias(f"more_{c}") for c in ("known", "base", "score")))
    )
    more = lambda c: F.coalesce(f"more_{c}", F.lit(0))
    return rows.drop("tail").join(rest, "row", "left").select(
        key,
        (id_remainder(key, 7) == held_remainder).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + more("known")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more("base")).alias("base_score"),
        (F.col("score") + more("score")).alias("score"),
    )
