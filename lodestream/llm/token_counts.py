"""Exact token counts of whole texts, with long texts encoded in overlapping chunks.

Neighbouring chunks overlap, and both encodings have token boundaries in the overlap. Some places are boundaries whatever
stands further left or right, as no word of the split rule runs over them: before white space, after white space that is
no plain space, between letters and digits, and between either and other signs, save an apostrophe before a letter, which
may begin a word with it, and places inside a special string or at its begin, as white space before it is cut by whether the whole of it is seen. Merges never cross words, so at such a place that both
encodings cut, the counts are spliced. Where an overlap holds none, it is widened, at last over the whole right chunk; if
that fails too, the left chunk takes the right one in and grows by its own length, so a run without any boundary is
encoded in time linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodestream.llm.bpe import SPACE, ByteBpe, vocabulary
from lodestream.llm.shared import texts_in, trimmed

#: Characters of a chunk, and of the overlap that is tried first; chunks that are encoded together.
CHUNK, OVERLAP, TOGETHER = 1 << 13, 1 << 8, 256
_SIGN = rf"[^{SPACE}\p{{L}}\p{{N}}"
#: Fixed value: places at which the split rule cuts in every context.
_STABLE = regex.compile(
    rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[{SPACE}])(?<! )(?=[^{SPACE}])|(?<=\p{{L}})(?=[^{SPACE}\p{{L}}])|(?<=\p{{N}})(?=[^{SPACE}\p{{N}}])|(?<={_SIGN}'])(?=\p{{L}})|(?<={_SIGN}])(?=\p{{N}})"
)


def _offsets(bpe: ByteBpe, ids: bytes) -> np.ndarray:
    """Byte offsets at which tokens begin, and the end."""
    return np.concatenate([[0], np.cumsum(bpe.token_length[np.frombuffer(ids, "<u4").astype(np.int64)])])


def stable(bpe: ByteBpe, text: str, start: int, end: int) -> list[int]:
    """Places from ``start`` up to ``end``, not counting the latter, at which every encoding cuts that sees the characters around them."""
    reach = max(map(len, bpe.special), default=0)
    inside = [range(m.start(), m.end()) for m in bpe.special_in(text, max(0, start - reach), min(len(text), end + reach))]
    return [k for m in _STABLE.finditer(text, max(0, start - 1), end + 1) if start <= (k := m.start()) < end and not any(k in r for r in inside)]


def _common(bpe: ByteBpe, text: str, left: np.ndarray, begin: int, dropped: int, right: np.ndarray, start: int, end: int) -> tuple[int, int] | None:
    """(byte offset within the left chunk, within the right one) of the middle one of the stable places from ``start`` to ``end`` that both encodings cut."""
    places = stable(bpe, text, start, end)
    if not places:
        return None
    codes = np.frombuffer(text[start:end].encode("utf-32-le", "surrogatepass"), "<u4")
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.concatenate([[0], np.cumsum(width)])[np.array(places) - start]
    lead = len(text[begin:start].encode())
    both = at[np.isin(at, right) & np.isin(at + lead, left) & (at + lead > dropped)]
    return (int(both[len(both) // 2]) + lead, int(both[len(both) // 2])) if len(both) else None


def counts_in_chunks(bpe: ByteBpe, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Number of tokens of each text, equal to that of encoding it whole. Holds TOGETHER chunks beside the texts, or one run without a boundary."""
    spans = [(t, b) for t, text in enumerate(texts) for b in range(0, max(1, len(text) - overlap), chunk)]

    def encoded() -> Iterator[np.ndarray]:
        for k in range(0, len(spans), TOGETHER):
            part = [texts[t][b : b + chunk + overlap] for t, b in spans[k : k + TOGETHER]]
            yield from (_offsets(bpe, ids) for ids in bpe.encode(part))

    out = [0] * len(texts)
    at = None
    for (t, start), right in zip(spans, encoded(), strict=True):
        text = texts[t]
        if t != at:
            at, begin, end, left, dropped = t, 0, min(chunk + overlap, len(text)), right, 0
        elif start >= end - overlap:  # else the left chunk has grown over this one
            stop, wide, held = min(start + chunk + overlap, len(text)), overlap, end
            cut = _common(bpe, text, left, begin, dropped, right, start, end - 1)
            while cut is None and held < stop:
                wide *= 4
                held = min(start + wide, stop)
                if stable(bpe, text, end - 1, held - 1):
                    left, end = _offsets(bpe, bpe.encode([text[begin:held]])[0]), held
                    cut = _common(bpe, text, left, begin, dropped, right, start, end - 1)
            if cut is None:
                # A whole number of chunks on, so that the next one meets it with the usual overlap.
                end = min(len(text), -(-max(stop, 2 * stop - begin) // chunk) * chunk + overlap)
                left = _offsets(bpe, bpe.encode([text[begin:end]])[0])
            else:
                out[t] += int(np.searchsorted(left, cut[0]) - np.searchsorted(left, dropped))
                begin, end, left, dropped = start, stop, right, cut[1]
        if end == len(text) and (start + chunk >= len(text) - overlap):
            out[t] += len(left) - 1 - int(np.searchsorted(left, dropped))
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text", key: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each row's whole text under the byte-level vocabulary at ``path``.

    A null text counts as an empty one: no bytes, no tokens. Every text is encoded in overlapping chunks of ``chunk``
    characters, a short one in a single chunk. Repeated rows give repeated results, an empty table an empty one; other columns are not read.
    Needs no shuffle.
    """
    schema = T.StructType(
        [docs.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    )

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            for start, texts in texts_in(batch, text):
                n = np.array(counts_in_chunks(bpe, texts, chunk), dtype=np.int64)
                size = [len(t.encode()) for t in texts]
                part = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
