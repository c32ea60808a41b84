"""Byte-level BPE encoding and decoding on Spark.

Words of a batch are merged together: their symbols lie in one flat array, each round looks all adjacent pairs up by
binary search over the sorted pair keys, takes every word's lowest rank and merges those pairs at once. A word leaves
the array when none of its pairs has a rank, so later rounds touch only the words that still change.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestream.llm.shared import texts_in, trimmed

#: Fixed value: the split rule of this family of vocabularies, with white space by its Unicode property.
SPACE = r"\t-\r \x85\xa0  -     　"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
_SPLIT = regex.compile(SPLIT)
#: After letters, one of these is a word of its own.
_STOPS = frozenset(".,;:!?")
_NO_RANK = np.int64(1) << 40
#: Pieces of text whose ids a worker keeps, in two generations: some 80 MB, which stay with the worker process.
CACHE_WORDS = 300_000


def _alphabet() -> dict[str, int]:
    """The printable stand-in of each byte, by the rule of byte-level vocabularies: printable Latin-1 stays, the rest follows from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """A byte-level vocabulary read from a ``tokenizers`` JSON file.

    Special strings inside a text become their own ids, as that library does by default. Truncation, padding and added
    begin or end tokens are not used.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = _alphabet(), spec["model"]["vocab"]
        if max(vocab.values(), default=0) >= 1 << 20:
            raise ValueError("the pair keys hold ids below 2**20")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.token_bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.token_length = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self._byte_id = np.zeros(256, dtype=np.int64)
        for c, b in letters.items():
            self._byte_id[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._rank, self._made = keys[order], order.astype(np.int64), made[order]
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def special_in(self, text: str, start: int, end: int) -> list[regex.Match]:
        """Special strings that lie wholly between ``start`` and ``end``."""
        return list(self._special.finditer(text, start, end)) if self._special else []

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; ``_NO_RANK`` where the pair has none."""
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        known = self._keys[at] == keys
        return np.where(known, self._rank[at], _NO_RANK), self._made[at]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each word)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), dtype=np.int64)
        symbols = self._byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        rank, made = np.full(len(symbols), _NO_RANK), np.zeros(len(symbols), dtype=np.int64)
        fresh = np.arange(len(symbols))
        while len(symbols):
            fresh = fresh[fresh < len(symbols) - 1]
            inside = word[fresh] == word[fresh + 1]
            rank[fresh[~inside]] = _NO_RANK
            fresh = fresh[inside]
            rank[fresh], made[fresh] = self._look_up(symbols[fresh], symbols[fresh + 1])
            rank[-1] = _NO_RANK
            first = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(first, append=len(word))
            best = np.minimum.reduceat(rank, first)
            live = best < _NO_RANK
            if not live.all():
                done = np.repeat(~live, size)
                done_symbols.append(symbols[done])
                done_words.append(word[done])
                stay = ~done
                symbols, word, rank, made = symbols[stay], word[stay], rank[stay], made[stay]
                best, size = best[live], size[live]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            # In a run of equal symbols the pairs overlap: from the left, every second one merges.
            begins = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            in_run = np.arange(len(hit)) - np.repeat(begins, np.diff(begins, append=len(hit)))
            hit = hit[in_run % 2 == 0]
            symbols[hit] = made[hit]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            shift = np.cumsum(keep) - 1
            symbols, word, rank, made = symbols[keep], word[keep], rank[keep], made[keep]
            moved = shift[hit]
            changed = np.zeros(len(symbols), dtype=bool)
            changed[moved] = True
            changed[moved[moved > 0] - 1] = True
            fresh = np.flatnonzero(changed)
        if done_words:
            word = np.concatenate(done_words)
            order = np.argsort(word, kind="stable")
            symbols = np.concatenate(done_symbols)[order]
            counts += np.bincount(word, minlength=len(words))
        return symbols, counts

    def _encode_whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without a cache."""
        special = [k for k, t in enumerate(texts) if self._special.search(t)] if self._special else []
        if special:
            return self._encode_with_special(texts, special)
        words: list[bytes] = []
        ends = []
        for t in texts:
            body = t[1:]
            if body.isalpha() and t[0] == " ":
                words.append(t.encode())
            elif body[-1:] in _STOPS and body[:-1].isalpha() and t[0] == " ":
                words.append(t[:-1].encode())
                words.append(body[-1:].encode())
            else:
                words += [w.encode() for w in _SPLIT.findall(t)]
            ends.append(len(words))
        ids, counts = self.merge(words)
        flat = ids.astype("<u4").tobytes()
        cuts = self._cuts(counts, ends)
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    @staticmethod
    def _cuts(counts: np.ndarray, ends: list[int]) -> list[int]:
        """Byte positions between texts, from the ids of each word and the words up to each text's end."""
        total = np.concatenate([[0], np.cumsum(counts)])
        return (4 * total[np.array([0, *ends])]).tolist()

    def _encode_with_special(self, texts: list[str], at: list[int]) -> list[bytes]:
        """The texts with the numbers ``at`` hold special strings: what lies between those is encoded by itself."""
        between = [self._special.split(texts[k]) for k in at]
        held = [[self.special[m].to_bytes(4, "little") for m in self._special.findall(texts[k])] for k in at]
        chosen = set(at)
        plain = [t for k, t in enumerate(texts) if k not in chosen]
        coded = iter(self._encode_whole([*plain, *(x for b in between for x in b)]))
        out = [b"" if k in chosen else next(coded) for k in range(len(texts))]
        for k, b, h in zip(at, between, held, strict=True):
            out[k] = b"".join(next(coded) + x for x in [*h[: len(b) - 1], b""])
        return out

    def _remember(self, new: set[str]) -> None:
        """Put the new pieces into the younger of the cache's two generations; :meth:`encode` drops the older one when that is full."""
        for p in [p for p in new if p in self._older]:
            self._pieces[p] = self._older[p]
        pieces = list(new.difference(self._older))
        self._pieces.update(zip(pieces, self._encode_whole([f" {p}" for p in pieces]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        A space between two characters that are not white space always begins a word, whatever stands around it. So a
        text is cut at its spaces and each piece is encoded once; texts in which white space meets white space take the
        plain way.
        """
        cut = [t.split(" ") for t in texts]
        if len(self._pieces) > CACHE_WORDS // 2:
            self._older, self._pieces = self._pieces, {}
        new = set().union(*(p[1:] for p in cut)).difference(self._pieces)
        odd = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        self._remember(new - odd)
        out: list[bytes] = []
        plain: list[int] = []
        for k, c in enumerate(cut):
            if len(c) > 1 and (not c[0] or c[0][-1].isspace() or (odd and not odd.isdisjoint(c))):
                plain.append(k)
                out.append(b"")
            else:
                out.append(b"".join(map(self._pieces.__getitem__, c[1:])))
        whole = set(plain)
        heads = self._encode_whole([texts[k] if k in whole else c[0] for k, c in enumerate(cut)])
        return [h + x for h, x in zip(heads, out, strict=True)]

    def decode_bytes(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text; bytes that are not UTF-8 become U+FFFD."""
        raw = b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


@functools.cache
def vocabulary(path: str) -> ByteBpe:
    """The vocabulary at ``path``, read once in each worker process."""
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "input_ids", proof: str | None = None) -> DataFrame:
    """``docs`` with a column ``out`` (array of int) of the token ids of the whole ``text``, and with ``proof`` a column of
    that name that says whether the ids, decoded where they were made, give the text back.

    A null text counts as an empty one and gives an empty array. All other columns stay, whatever their names; a column
    that already has the name ``out`` is replaced. Rows stay as they are: repeated rows give repeated results, and an
    empty table gives an empty one. Needs no shuffle; memory is bounded by one Arrow batch and one text's ids.
    """
    kept = [c for c in docs.columns if c not in (out, proof)]
    added = [T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(proof, T.BooleanType())] if proof else [])]
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for start, texts in texts_in(batch, text):
                ids = bpe.encode(texts)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<i4"))
                part = batch.slice(start, len(texts))
                held = [pa.array([bpe.decode_bytes(x) == t.encode() for x, t in zip(ids, texts, strict=True)])] if proof else []
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), values, *held], names=[*kept, *(f.name for f in added)])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "input_ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``out`` (string) of the text its ``ids`` stand for; a null array gives a null text."""
    kept = [c for c in encoded.columns if c != out]
    schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(out, T.StringType())])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            lists = batch.column(ids)
            texts = [None if not x.is_valid else bpe.decode_bytes(np.asarray(x.values, dtype="<u4").tobytes()).decode() for x in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, out])

    return encoded.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of each row: encoded, decoded and digested where the row lies.

    Rules for nulls, repeated rows and empty tables are those of :func:`encode`.
    """
    schema = T.StructType(
        [docs.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    )

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for start, texts in texts_in(batch, text):
                n, a, b = [], [], []
                for ids in bpe.encode(texts):
                    n.append(len(ids) // 4)
                    a.append(hashlib.sha256(ids).hexdigest())
                    b.append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
