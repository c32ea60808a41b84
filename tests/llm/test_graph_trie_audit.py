"""The proximity graph, the prefix trie and the divergence audit against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from lodestream.llm import divergence, prefix_trie, proximity_graph
from pyspark.sql import functions as F


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns[c].append(((turn is not None, turn or 0, role, digest), (role, text)))
    turns = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * (len(p[-1][1]) if p else 0)
    return Counter(
        (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, own in members.items()
    )


def conversations_of(seed, n, words):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        family = c - c % 100
        for turn in range(rng.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 1, 1])))))
        if rng.random() < 0.3:
            rows += [(c, 50 + k, "user", f"copy of {family}") for k in range(3)]
    return rows


TRIE_EDGES = [
    (7, None, "user", "first by a null turn"), (7, 1, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 0, "user", "é😀"),
    (None, 1, "user", "no conversation"), (100, 1, "user", "a"), (100, 2, "user", "b"), (100, 3, "user", "c"), (100, 4, "user", "d"), (100, 5, "user", "e"),
    (150, None, None, None), (199, 1, "user", "x"), *((300, k, "u", str(k)) for k in range(150)), *((301, k, "u", str(k)) for k in range(120)),
]


@pytest.mark.parametrize("piece", [1, 5, 40, 1 << 17])
def test_trie_equals_brute_force(spark, piece):
    rows = conversations_of(1, 260, ["hi", "yes", "no"]) + [(1000 + c, t, r, x) for c, t, r, x in TRIE_EDGES if c is not None] + TRIE_EDGES
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string").repartition(5)
    found = Counter(tuple(r) for r in prefix_trie.trie(df, piece_turns=piece).collect())
    assert found == brute_trie(rows)


def test_trie_of_one_hot_conversation_text(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(4)] + [(c, 0, "user", str(c % 7)) for c in range(400, 600)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(7)
    assert Counter(tuple(r) for r in prefix_trie.trie(df, piece_turns=30).collect()) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_extents_are_those_of_a_scan():
    rng = np.random.default_rng(2)
    for n in (2, 3, 17, 64, 65):
        near = rng.integers(0, 4, n - 1)
        row, depth = np.repeat(np.arange(n), 4), np.tile(np.arange(1, 5), n)
        left, right_of = prefix_trie.extents(prefix_trie.minima(near), row, depth, n)
        right = right_of(np.arange(len(row)))
        for r, d, a, b in zip(row, depth, left, right, strict=True):
            lo = hi = r
            while lo and near[lo - 1] >= d:
                lo -= 1
            while hi < n - 1 and near[hi] >= d:
                hi += 1
            assert (a, b) == (lo, hi)


def brute_audit(rows, least, top=10):
    rows = [(a or "", b or "", c or "") for a, b, c in rows]
    found, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        found[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = Counter()
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: found[g, s] for g, s in list(found) if g == lang}
        share = lambda c, v: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in v) + 2 * len(v)) for t in v}
        p = {s: share(c, kept) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()), kept)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, own in (("pair", pairs), ("term", terms)):
                ranked = sorted(own, key=lambda x: (-x[0], x[1].encode()))
                for k, (v, item) in enumerate(ranked if part == "pair" else ranked[:top]):
                    out[(lang, s, part, item, v, k + 1)] += 1
    return out


def audited_rows():
    rng = random.Random(5)
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(90)] + ["Éclair", "naïve", "日本", "UPPER", "x"]
    rows = []
    for k in range(400):
        source = f"s{rng.randrange(11)}" if k % 3 else "hot"
        own = words[: 12 + 7 * (hash(source) % 3)] if k % 5 else words
        rows.append((" ".join(rng.choice(own) + rng.choice(["", ",", "1"]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), source))
    rows += [(None, "en", "empty"), ("", None, None), ("12 34 !", "xx", "a"), ("only twice", "xx", "b"), rows[0], rows[0], ("wordaa " * 5000, "en", None)]
    return rows


@pytest.mark.parametrize("a", [divergence.Audit(min_docs=4), divergence.Audit(min_docs=4, groups=2, terms=5, frontier=64), divergence.Audit(min_docs=4, groups=4, terms=16)])
def test_audit_equals_brute_force(spark, a):
    rows = audited_rows()
    df = spark.createDataFrame([(*r, 3, "n") for r in rows], "text string, lang string, source string, count long, number string").repartition(4)
    assert Counter(tuple(r) for r in divergence.audit(df, a).collect()) == brute_audit(rows, 4)


def test_audit_of_nothing_and_of_rare_terms(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit(spark.createDataFrame([], schema)).collect() == []
    rows = [("a b", "en", "s"), ("c", "en", "t"), ("d", "de", "s")]
    assert Counter(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, schema)).collect()) == brute_audit(rows, 10)


def test_shares_are_exact_beyond_long(spark):
    counts = [(0, 1, 1), (5 * 10**15, 9 * 10**15, 7), (10**17, 10**17, 50_000_000), (3, 7, 2)]
    df = spark.createDataFrame(counts, "c long, n long, v long").select("c", "n", "v", divergence.share(F.col("c"), F.col("n"), F.col("v"), divergence.Audit()).alias("p"))
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 2) // (r["n"] + 2 * r["v"]) for r in df.collect())


def test_pieces_keep_terms_whole():
    text = b"ab cd " * 1000 + b"x" * 500 + b" end"
    assert [t for p in divergence.pieces_of(text, 100) for t in divergence.TERM.findall(p)] == divergence.TERM.findall(text)


def test_every_node_of_a_graph_is_reached():
    rng = np.random.default_rng(3)
    unit = proximity_graph.directions(np.concatenate([rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(300, 16)), rng.normal(size=(500, 16))]))
    for degree in (2, 24):
        edges, entry = proximity_graph.graph(unit, proximity_graph.Graph(degree=degree, beam=8))
        assert proximity_graph.reached(edges, entry).all()
        assert not (edges == np.arange(len(edges))[:, None]).any()


@pytest.fixture(scope="module")
def vectors(spark, smallest):
    return spark.read.parquet(f"{smallest}/embeddings.parquet")


def test_neighbours_recall_on_given_vectors(vectors):
    rows = vectors.toPandas()
    for g in (proximity_graph.Graph(), proximity_graph.Graph(shard=4, block=3)):
        found = proximity_graph.neighbours(vectors, every=10, g=g).toPandas()
        assert len(found) == 50 * 5 and proximity_graph.recall(found, rows) >= 0.95
        for _, own in found.groupby("query_id"):
            own = own.sort_values("rank")
            assert list(own["rank"]) == [1, 2, 3, 4, 5]
            assert sorted(zip(-own["score"], own["vec_id"], strict=True)) == list(zip(-own["score"], own["vec_id"], strict=True))
    by_id = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in rows.itertuples()}
    for r in found.itertuples():
        a, b = by_id[r.query_id], by_id[r.vec_id]
        assert abs(r.score - (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))) < 1e-12


def test_neighbours_of_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 4))
    rows = [(k, base[k % 40].tolist(), 1, "c") for k in range(60)]
    rows += [(k, base[0].tolist(), 1, "c") for k in range(60, 360)]
    rows += [(k, (3 * base[1]).tolist(), 1, "c") for k in range(360, 420)]
    rows += [(1000, None, 1, "c"), (1001, [], 1, "c"), (1002, [0.0] * 4, 1, "c"), (1003, [1.0, None, 0.0, 0.0], 1, "c"), (1004, [1.0, float("nan"), 0.0, 0.0], 1, "c"), (1005, [1.0, float("inf"), 0.0, 0.0], 1, "c"), (None, [1.0] * 4, 1, "c")]
    rows += [(2000, [1.0, 2.0], 1, "c"), (2010, [2.0, 1.0], 1, "c"), rows[0], (3000, [1.0, 2.0, 3.0], 1, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int, node string").repartition(4)
    found = proximity_graph.neighbours(df, every=10).toPandas()
    assert set(found["vec_id"]).isdisjoint(range(1000, 1006)) and 3000 not in set(found["query_id"])
    assert list(found[found["query_id"] == 2000]["vec_id"]) == [2010]
    whole = {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 1000}
    unit = {k: np.array(v) / np.linalg.norm(v) for k, v in whole.items()}
    for q, own in found[found["query_id"] < 1000].groupby("query_id"):
        best = sorted((-round(float(unit[q] @ unit[k]), 9) for k in unit if k != q))[:5]
        assert [-round(s, 9) for s in own.sort_values("rank")["score"]] == best
    # Equal vectors tie exactly, so the smallest ids among the copies come first.
    assert list(found[found["query_id"] == 60].sort_values("rank")["vec_id"]) == [0, 40, 61, 62, 63]


def test_neighbours_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert proximity_graph.neighbours(spark.createDataFrame([], schema)).collect() == []
    alone = spark.createDataFrame(pd.DataFrame({"vec_id": [0], "embedding": [[1.0, 2.0]]}), schema)
    assert proximity_graph.neighbours(alone).collect() == []
