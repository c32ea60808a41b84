"""Secrets in whole texts: fixed rules, and a character convolutional network over every candidate in its context.

The rules' findings always stay. Candidates beyond them are all runs of token characters of some length that hold a letter
and a digit, or a capital within a word; the network reads a candidate in overlapping windows with the characters around
it, and one whose highest answer passes the threshold joins as ``learned``. It is trained in numpy on the rules' findings against ordinary long words
and compounds of them, never against the candidates that it is to judge; in half of the findings' copies the context is swapped for that of an ordinary word, so that the shape of the
secret counts and not only its label. Training is cross-fitted: each fold of findings, with their copies, and of words is
scored by a network that saw none of it, so every row calibrates the scores to probabilities. The threshold is the highest
one that keeps a given recall on the findings; where the share of harmless rows above it is not surely below a stated one,
because they are too many or too few are known, the network adds nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestream.llm.shared import arrow_column, texts_in, texts_of, trimmed, written

#: The rules of the base scan. Only ASCII letters match in either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "learned")
#: Every sixth character of a run of 24 hexadecimal digits is one, at four places in a row at least.
_STRIDE = 6
_SAMPLED = re.compile(r"[0-9a-f]{4,}")
_WORD = re.compile(r"[A-Za-z]{10,}")
#: Characters of a candidate, and of its context, that the network reads; the least length of a candidate beyond the rules.
BEFORE, INSIDE, AFTER, LEAST = 24, 40, 8, 8
WINDOW = BEFORE + INSIDE + AFTER
_RUN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST},}}")
_LETTER = re.compile(r"[A-Za-z]")
_ODD = re.compile(r"[0-9]|[a-z][A-Z]")
#: Characters between the windows of a candidate longer than INSIDE.
STRIDE = 8


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' findings, in order; positions in code points."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    for s in _SAMPLED.finditer(text[::_STRIDE]):
        low, high = max(0, _STRIDE * s.start() - _STRIDE + 1), _STRIDE * s.end()
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, low, min(high, len(text)))]
    return sorted(out)


def other_candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of runs of token characters, LEAST long, with a letter and a digit or inner capital; findings cut runs, and what is left of one is a run of its own."""
    out, k = [], 0
    for m in _RUN.finditer(text):
        if not _ODD.search(m[0]):
            continue
        start, end = m.span()
        while k < len(base) and base[k][2] <= start:
            k += 1
        at = k
        while start < end:
            # Findings are in order of their begins, and may overlap.
            cut, onward = (base[at][0], base[at][2]) if at < len(base) and base[at][0] < end else (end, end)
            if cut - start >= LEAST and _LETTER.search(text, start, cut) and _ODD.search(text, start, cut):
                out.append((start, cut))
            start = max(start, onward)
            at += 1
    return out


def windows(start: int, end: int) -> Iterator[tuple[int, int]]:
    """(start, end) of overlapping spans of INSIDE characters at most that cover a candidate; the last one ends with it."""
    last = max(start, end - INSIDE)
    yield from ((s, s + INSIDE) for s in range(start, last, STRIDE))
    yield last, min(end, last + INSIDE)


def window(text: str, start: int, end: int) -> np.ndarray:
    """Character classes around a candidate: printable ASCII by itself, all else as one class, 0 beyond the text."""
    out = np.zeros(WINDOW, dtype=np.uint8)
    left = _classes(text[max(0, start - BEFORE) : start])
    out[BEFORE - len(left) : BEFORE] = left
    inside = _classes(text[start : min(end, start + INSIDE)])
    out[BEFORE : BEFORE + len(inside)] = inside
    right = _classes(text[end : end + AFTER])
    out[BEFORE + INSIDE : BEFORE + INSIDE + len(right)] = right
    return out


def _classes(part: str) -> np.ndarray:
    codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where((codes >= 32) & (codes < 127), codes - 30, 1).astype(np.uint8)


@dataclass(frozen=True)
class Fit:
    """Settings of the training: all windows take part, in parts of about ``rows`` of each sort, by hash.

    ``recall`` is the least share of findings at or above the threshold, ``alarms`` the largest share of harmless rows there,
    by the upper end of its interval of 95 %.
    """

    rows: int = 6000
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    recall: float = 0.98
    alarms: float = 0.02
    folds: int = 5
    seed: int = 1


@dataclass
class Network:
    """Embedding, one convolution of width 5, the strongest answers in the candidate and in its context, a logistic unit."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray
    threshold: float = 2.0
    #: Slope and offset of the logits that make scores probabilities.
    slope: float = 1.0
    offset: float = 0.0
    #: Findings and harmless rows, each set aside in its fold, the share of each at or above the threshold, and the highest
    #: share of harmless rows there that is still likely.
    aside: tuple[int, int] = (0, 0)
    recall: float = 0.0
    alarms: float = 0.0
    likely_alarms: float = 1.0
    #: Whether that share is low enough for the network to add spans.
    adds: bool = True

    @staticmethod
    def blank(seed: int, dims: int = 8, filters: int = 24) -> Network:
        rng = np.random.default_rng(seed)
        return Network(rng.normal(0, 0.3, (98, dims)), rng.normal(0, 0.2, (5 * (dims + 1), filters)), np.zeros(filters), rng.normal(0, 0.1, 2 * filters), np.zeros(1))

    def forward(self, x: np.ndarray):
        mark = np.zeros((*x.shape, 1))
        mark[:, BEFORE : BEFORE + INSIDE] = 1
        e = np.concatenate([self.embed[x], mark * (x > 0)[:, :, None]], axis=2)
        spread = np.lib.stride_tricks.sliding_window_view(e, 5, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WINDOW - 4, -1)
        y = spread @ self.filters + self.bias
        inside, around = y[:, BEFORE - 2 : BEFORE + INSIDE - 2], np.delete(y, np.s_[BEFORE - 2 : BEFORE + INSIDE - 2], axis=1)
        top = np.concatenate([inside.max(axis=1), around.max(axis=1)], axis=1)
        hidden = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.shift, -40, 40)))
        return p, hidden, spread, inside.argmax(axis=1) + BEFORE - 2, around.argmax(axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.forward(x[k : k + 2048])[1] @ self.out + self.shift for k in range(0, len(x), 2048))])

    def probability(self, x: np.ndarray) -> np.ndarray:
        """The calibrated score of each window."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.offset, -40, 40)))


def _calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of ``y`` to the logits, both classes with equal say, by Newton steps; targets are drawn in a little, as Platt does, so that separable rows have a fit."""
    n1, n0 = y.sum(), len(y) - y.sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-6 * (theta - [1.0, 0.0]))
        theta -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def _likely_share(count: int, of: int, z: float = 1.645) -> float:
    """The upper end of Wilson's interval for a share, 95 % on that side."""
    if not of:
        return 1.0
    share, square = count / of, z * z
    return float((share + square / (2 * of) + z * np.sqrt(share * (1 - share) / of + square / (4 * of * of))) / (1 + square / of))


def _hashed_folds(rows: np.ndarray, folds: int) -> np.ndarray:
    """A fold for each window by its value, the same in every part."""
    return np.array([zlib.crc32(row.tobytes()) % folds for row in rows[:, BEFORE : BEFORE + INSIDE]], dtype=np.int64)


def examples(found: np.ndarray, other: np.ndarray, plain: np.ndarray, fit: Fit = Fit(), part: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, 1 for a secret, fold) of the training; findings of one value share a fold with their copies, words with their compounds. For one ``part`` of all windows folds go by hash."""
    rng = np.random.default_rng(fit.seed if part is None else [fit.seed, part])
    swapped, of = found.copy(), np.arange(len(found))
    if len(plain):
        # The context of an ordinary word, and the finding's value alone: what follows the last quote or sign.
        lent = plain[rng.integers(0, len(plain), len(found))]
        swapped[:, :BEFORE], swapped[:, BEFORE + INSIDE :] = lent[:, :BEFORE], lent[:, BEFORE + INSIDE :]
        for row in swapped:
            inside = row[BEFORE : BEFORE + INSIDE]
            signs = np.flatnonzero(np.isin(inside, _classes("=:\"' ")))
            if len(signs):
                rest = inside[signs[-1] + 1 :].copy()
                inside[:] = 0
                inside[: len(rest)] = rest
        whole = (swapped[:, BEFORE : BEFORE + INSIDE] > 0).sum(axis=1) >= ASSIGN_LEAST
        swapped, of = swapped[whole], of[whole]
    made = _compounds(plain, rng)
    if part is None:
        value = np.unique(found[:, BEFORE : BEFORE + INSIDE], axis=0, return_inverse=True)[1].ravel()
        dealt = rng.permutation(int(value.max()) + 1)[value] % fit.folds
        words = rng.permutation(len(plain)) % fit.folds
    else:
        dealt, words = _hashed_folds(found, fit.folds), _hashed_folds(plain, fit.folds)
    y = np.concatenate([np.ones(len(found) + len(swapped)), np.zeros(len(other) + len(plain) + len(made))])
    return np.concatenate([found, swapped, other, plain, made]), y, np.concatenate([dealt, dealt[of], rng.permutation(len(other)) % fit.folds, words, words])


class Descent:
    """Gradient steps of one network by Adam, an epoch at a time; its numbers travel as one array between parts."""

    def __init__(self, fit: Fit, state: np.ndarray | None = None, step: int = 0):
        self.net, self.fit, self.step = Network.blank(fit.seed), fit, step
        self.params = [self.net.filters, self.net.bias, self.net.out, self.net.shift, self.net.embed]
        self.first, self.second = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]
        if state is not None:
            at = 0
            for own in [*self.params, *self.first, *self.second]:
                own[...] = state[at : at + own.size].reshape(own.shape)
                at += own.size

    def state(self) -> np.ndarray:
        return np.concatenate([own.ravel() for own in [*self.params, *self.first, *self.second]])

    def epoch(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over windows, both classes with equal say."""
        net, fit = self.net, self.fit
        weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        for own in np.array_split(rng.permutation(len(y)), max(1, len(y) // fit.batch)):
            p, hidden, spread, in_at, out_at = net.forward(x[own])
            error = (p - y[own]) * weight[own] / len(own)
            back = error[:, None] * net.out * (hidden > 0)
            n = net.filters.shape[1]
            # Places outside the candidate, counted without its own.
            out_at = np.where(out_at < BEFORE - 2, out_at, out_at + INSIDE)
            g_filters, g_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
            for at, b in ((in_at, back[:, :n]), (out_at, back[:, n:])):
                picked = np.take_along_axis(spread, at[:, :, None], axis=1)
                g_filters += np.einsum("tfd,tf->df", picked, b)
                into = (b[:, :, None] * net.filters.T[None]).reshape(len(own), n, 5, -1)[..., :-1]
                for j in range(5):
                    np.add.at(g_embed, x[own][np.arange(len(own))[:, None], at + j], into[:, :, j])
            grads = [g_filters, (back[:, :n] + back[:, n:]).sum(axis=0), hidden.T @ error + 1e-4 * net.out, np.array([error.sum()]), g_embed]
            self.step += 1
            for q, g, m, v in zip(self.params, grads, self.first, self.second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= fit.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def descended(x: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Network:
    """A network fitted to windows by gradient steps; it has no threshold yet."""
    descent, rng = Descent(fit), np.random.default_rng(fit.seed)
    for _ in range(fit.epochs):
        descent.epoch(x, y, rng)
    return descent.net


def _fold(x: np.ndarray, y: np.ndarray, fold: np.ndarray, k: int, fit: Fit) -> tuple[Network, np.ndarray]:
    """The network that saw no row of fold ``k``, and its logits there; ``fit.folds`` as ``k`` trains on all rows."""
    net = descended(x[fold != k], y[fold != k], fit)
    return net, net.logits(x[fold == k])


def train(found: np.ndarray, other: np.ndarray, plain: np.ndarray, fit: Fit = Fit(), spark: SparkSession | None = None) -> Network:
    """A network from windows of findings, candidates known to be harmless and ordinary words; without findings, or without any of the others, it adds nothing.

    Repeated windows count as often as they come. Half or more of the findings' rows are their copies in another context.
    With a session the folds are trained as tasks, else one after the other; the network is the same.
    """
    if not len(found) or not len(other) + len(plain):
        return Network.blank(fit.seed)
    x, y, fold = examples(found, other, plain, fit)
    if spark is None:
        done = [_fold(x, y, fold, k, fit) for k in range(fit.folds + 1)]
    else:
        sent = spark.sparkContext.broadcast((x, y, fold))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = [pickle.dumps(_fold(*sent.value, k, fit), protocol=5) for k in batch.column("id").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.binary())], names=["id", "made"])

        rows = spark.range(0, fit.folds + 1, 1, fit.folds + 1).mapInArrow(run, "id long, made binary").collect()
        done = [pickle.loads(r["made"]) for r in sorted(rows, key=lambda r: r["id"])]
    net, logits = done[-1][0], np.zeros(len(y))
    for k, (_, own) in enumerate(done[:-1]):
        logits[fold == k] = own
    net.slope, net.offset = _calibrated(logits, y)
    score = np.zeros(len(y))
    for k, (part, _) in enumerate(done[:-1]):
        part.slope, part.offset = net.slope, net.offset
        score[fold == k] = part.probability(x[fold == k])
    known, harmless = np.sort(score[y > 0]), score[y == 0]
    net.threshold = float(known[int((1 - fit.recall) * len(known))])
    above = int((harmless >= net.threshold).sum())
    net.aside, net.recall, net.alarms = (len(known), len(harmless)), float((known >= net.threshold).mean()), above / len(harmless)
    net.likely_alarms = _likely_share(above, len(harmless))
    net.adds = net.likely_alarms <= fit.alarms
    return net


def _compounds(plain: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Harmless candidates made of ordinary words, signs and short numbers, as paths, names and versions are: the windows of ``plain`` with such a run inside."""
    out = plain.copy()
    words = [row[BEFORE : BEFORE + INSIDE][row[BEFORE : BEFORE + INSIDE] > 0] for row in plain]
    for row in out:
        parts = []
        for k in rng.integers(0, len(words), rng.integers(1, 4)):
            number = _classes("".join(map(str, rng.integers(0, 10, rng.integers(1, 5)))))
            parts += [words[k][: rng.integers(3, 11)], _classes("/-_.="[rng.integers(0, 5)])] + [number] * int(rng.random() < 0.5)
        inside = np.concatenate([_classes("//" * int(rng.random() < 0.3)), *parts, number])[:INSIDE]
        row[BEFORE : BEFORE + INSIDE] = 0
        row[BEFORE : BEFORE + len(inside)] = inside
    return out


def training_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(sort, window): all windows of findings, sort 0, and of an ordinary word of each text that has findings, sort 1.

    Candidates that the rules missed are left out: they may be secrets of a kind that no rule knows. Null and empty texts
    give none, equal windows count once, and files and their order do not matter.
    """

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in texts_in(batch, text):
                sort, rows = [], []
                for t in texts:
                    spans = [(0, s, e) for s, _, e in base_spans(t)]
                    if spans and (word := _WORD.search(t)):
                        spans.append((1, *word.span()))
                    sort += [k for k, *_ in spans]
                    rows += [window(t, s, e).tobytes() for _, s, e in spans]
                yield pa.RecordBatch.from_arrays([pa.array(sort, pa.int32()), pa.array(rows, pa.binary())], names=["sort", "window"])

    return written(docs.select(text).mapInArrow(run, "sort int, window binary").distinct(), "secret-windows")


def _invented(found: np.ndarray, seed: int) -> np.ndarray:
    """Words of random letters in the findings' places, for texts without ordinary words."""
    rng, out = np.random.default_rng(seed), found.copy()
    for row in out:
        word = rng.integers(ord("a"), ord("z") + 1, rng.integers(10, 21)) - 30
        row[BEFORE : BEFORE + INSIDE] = 0
        row[BEFORE : BEFORE + len(word)] = word
    return out


_NONE = np.zeros((0, WINDOW), np.uint8)


def _block(windows: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, 1 for a secret, fold) of a part."""
    return _block([row["x"]]), np.frombuffer(row["y"], np.uint8).astype(float), np.frombuffer(row["fold"], np.uint8)


def _each_part(run: Callable[[dict], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @trimmed
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield run(batch.slice(k, 1).to_pylist()[0])

    return over


def train_in_parts(windows: DataFrame, parts: int, fit: Fit = Fit(), invent: bool = False) -> Network:
    """:func:`train` over all ``windows``, however many: every epoch each part goes on from the networks' mean over all parts.

    A part holds about ``fit.rows`` windows of each sort, and is one task's; means, of a few thousand numbers a network, are
    taken in the order of parts, so that a rerun gives the same. Every window calibrates and counts for the threshold.
    """
    spark, nets = windows.sparkSession, range(fit.folds + 1)

    def made(own: pd.DataFrame) -> pd.DataFrame:
        part = int(own["part"].iloc[0])
        found, plain = (_block(sorted(own["window"][own["sort"] == k])) for k in range(2))
        x, y, fold = examples(found, _NONE, _invented(found, fit.seed) if invent else plain, fit, part)
        return pd.DataFrame({"part": [part], "x": [x.tobytes()], "y": [y.astype(np.uint8).tobytes()], "fold": [fold.astype(np.uint8).tobytes()]})

    dealt = windows.withColumn("part", F.pmod(F.xxhash64(F.lit(fit.seed), "window"), F.lit(parts)))
    packed = written(dealt.groupBy("part").applyInPandas(made, "part long, x binary, y binary, fold binary").repartition(parts, "part"), "secret-parts")
    blank = Descent(fit)
    states, steps = {k: blank.state() for k in nets}, 0

    def mean(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("part")
        state = np.average([np.frombuffer(s) for s in own["state"]], axis=0, weights=own["n"])
        return pd.DataFrame({"net": own["net"].iloc[:1], "state": [state.tobytes()], "step": [own["step"].max()]})

    for epoch in range(fit.epochs):
        sent = spark.sparkContext.broadcast((states, steps))

        def advance(row: dict) -> pa.RecordBatch:
            (x, y, fold), out = _unpacked(row), []
            for k in nets:
                own = fold != k
                descent = Descent(fit, sent.value[0][k], sent.value[1])  # noqa: B023
                descent.epoch(x[own], y[own], np.random.default_rng([fit.seed, row["part"], epoch]))  # noqa: B023
                out.append((k, descent.state().tobytes(), int(own.sum()), descent.step))
            columns = list(zip(*out, strict=True))
            types = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), pa.array([row["part"]] * len(out), pa.int64())], names=["net", "state", "n", "step", "part"])

        moved = packed.mapInArrow(_each_part(advance), "net long, state binary, n long, step long, part long").filter("n > 0")
        done = moved.groupBy("net").applyInPandas(mean, "net long, state binary, step long").collect()
        states, steps = {r["net"]: np.frombuffer(r["state"]) for r in done}, max(r["step"] for r in done)
        sent.unpersist()
    last = spark.sparkContext.broadcast(states)

    def judged(row: dict) -> pa.RecordBatch:
        x, y, fold = _unpacked(row)
        logit = np.zeros(len(y))
        for k in range(fit.folds):
            logit[fold == k] = Descent(fit, last.value[k]).net.logits(x[fold == k])
        return pa.RecordBatch.from_arrays([pa.array(logit), pa.array(y > 0)], names=["logit", "secret"])

    logits = written(packed.mapInArrow(_each_part(judged), "logit double, secret boolean"), "secret-logits")
    net = Descent(fit, states[fit.folds]).net
    n1, n = logits.agg(F.count_if("secret"), F.count("*")).first()
    n0 = n - n1
    net.slope, net.offset = _calibrated_over(logits, n1, n0)
    # The finding of that rank, by a distributed sort.
    rank = int((1 - fit.recall) * n1)
    least = logits.filter("secret").select("logit").sort("logit").rdd.zipWithIndex().filter(lambda r: r[1] == rank).first()[0]["logit"]
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * least + net.offset, -40, 40))))
    kept, above = logits.agg(F.count_if(F.col("secret") & (F.col("logit") >= least)), F.count_if(~F.col("secret") & (F.col("logit") >= least))).first()
    net.aside, net.recall, net.alarms, net.likely_alarms = (n1, n0), kept / n1, above / n0, _likely_share(above, n0)
    net.adds = net.likely_alarms <= fit.alarms
    return net


def _calibrated_over(logits: DataFrame, n1: int, n0: int) -> tuple[float, float]:
    """:func:`_calibrated` over a table: each Newton step is one aggregate."""
    x, secret, (a, b) = F.col("logit"), F.col("secret"), (1.0, 0.0)
    target, weight = F.when(secret, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2)), F.when(secret, 0.5 / n1).otherwise(0.5 / n0)
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.least(x * a + b, F.lit(40.0)), F.lit(-40.0))))
        h, g = weight * p * (1 - p), weight * (p - target)
        xx, x1, one, gx, g1 = logits.agg(F.sum(h * x * x), F.sum(h * x), F.sum(h), F.sum(g * x), F.sum(g)).first()
        step = np.linalg.solve(np.array([[xx, x1], [x1, one]]) + 1e-6 * np.eye(2), np.array([gx, g1]) + 1e-6 * np.array([a - 1.0, b]))
        step /= max(1.0, np.abs(step).max())
        a, b = float(a - step[0]), float(b - step[1])
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 1e-3), b


def fitted(docs: DataFrame, fit: Fit = Fit(), text: str = "text") -> Network:
    """A network for ``docs``, trained on all windows of their findings; over an empty table, or one without findings, it adds nothing."""
    windows = training_windows(docs, text)
    n = {r["sort"]: r["count"] for r in windows.groupBy("sort").count().collect()}
    if max(n.values(), default=0) > fit.rows:
        return train_in_parts(windows, -(-max(n.values()) // fit.rows), fit, invent=1 not in n)
    rows = {k: [bytes(r["window"]) for r in windows.filter(F.col("sort") == k).orderBy(F.xxhash64(F.lit(fit.seed), "window"), "window").select("window").collect()] for k in range(2)}
    found, plain = _block(rows[0]), _block(rows[1])
    return train(found, _NONE, plain if len(plain) else _invented(found, fit.seed), fit, docs.sparkSession)


def all_spans(texts: list[str], net: Network) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text; every candidate goes whole through the network, what the rules found stays."""
    base = [base_spans(t) for t in texts]
    if not net.adds:
        return [(b, b) for b in base]
    more = [other_candidates(t, b) for t, b in zip(texts, base, strict=True)]
    runs = [(t, s, e) for t, found in zip(texts, more, strict=True) for s, e in found]
    spans = ((k, t, *w) for k, (t, s, e) in enumerate(runs) for w in windows(s, e))
    highest = np.zeros(len(runs))
    while part := list(itertools.islice(spans, 2048)):
        np.maximum.at(highest, [x[0] for x in part], net.probability(np.array([window(*x[1:]) for x in part])))
    p = iter(highest.tolist())
    return [(b, sorted([*b, *((s, 3, e) for s, e in m if next(p) >= net.threshold)])) for b, m in zip(base, more, strict=True)]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_learned) of each row's whole text.

    A null text counts as an empty one and holds nothing. Spans are kind:start:end in code points, the end exclusive, by
    start, then kind. Repeated rows give repeated results, an empty table an empty one; null keys pass through. Other
    columns are not read. Needs no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net, protocol=5))
    counts = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    schema = T.StructType([docs.schema[key], *counts[:3], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), counts[3]])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            for start, texts in texts_in(batch, text):
                found = all_spans(texts, own)
                n = [pa.array([sum(k == kind for _, k, _ in every) for _, every in found], pa.int64()) for kind in range(4)]
                digest = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
                spans = [_joined(every) for _, every in found]
                yield pa.RecordBatch.from_arrays([batch.slice(start, len(texts)).column(key), *n[:3], pa.array(digest), pa.array(spans), n[3]], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def redact(docs: DataFrame, net: Network, text: str = "text", mark: str = "[secret]", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every found span in ``text`` replaced by ``mark``; overlapping spans become one mark.

    All rows and columns stay, whatever their names; a null text stays null, and its ``length`` stays as it is. The column
    ``length``, where there is one, follows the new text. Repeated rows give repeated results, an empty table an empty one.
    Only the text goes to Python.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net, protocol=5))

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pickle.loads(sent.value)
        for column in columns:
            out = []
            for texts in texts_of(column):
                for t, (_, spans) in zip(texts, all_spans(texts, own), strict=True):
                    pieces, reached = [], 0
                    for s, _, e in spans:
                        if s >= reached:
                            pieces += [t[reached:s], mark]
                        reached = max(reached, e)
                    out.append("".join([*pieces, t[reached:]]) if spans else t)
            yield pc.if_else(column.is_valid(), pa.array(out, pa.string()), pa.scalar(None, pa.string()))

    done = docs.withColumn(text, arrow_column(run, "string")(docs[text]))
    if length in docs.columns:
        done = done.withColumn(length, F.when(F.col(text).isNotNull(), F.char_length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return done
