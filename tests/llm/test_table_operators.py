"""Near-duplicates, shards, mixes and recordings against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from lodestream.llm import audio, components, embeddings, mixing, sharding, simhash
from pyspark.sql import functions as F


def roots(n, links):
    at = list(range(n))

    def find(a):
        while at[a] != a:
            at[a] = at[at[a]]
            a = at[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def print_by_rule(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 4]), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * 2 + rng.integers(0, 2, 3000, dtype=np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    (a, i), (b, j) = simhash.golay_keys(x), simhash.golay_keys(y)
    shared = set(zip(a.tolist(), i.tolist(), strict=True)) & set(zip(b.tolist(), j.tolist(), strict=True))
    assert {k for _, k in shared} == set(range(3000))


def check_simhash(rows, found):
    prints = [print_by_rule(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    least = defaultdict(list)
    for k, r in enumerate(roots(len(rows), links)):
        least[r].append(k)
    want = Counter()
    for own in least.values():
        ids = [rows[k][0] for k in own if rows[k][0] is not None]
        for k in own:
            want[(rows[k][0], f"{prints[k]:016x}", min(ids, default=None))] += 1
    assert Counter(tuple(r) for r in found) == want


@pytest.mark.parametrize("bucket", [2, simhash.BUCKET])
def test_simhash_components(spark, documents, edge, bucket):
    docs = documents.select("doc_id", "text").unionByName(edge.select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_simhash(rows, simhash.near_duplicates(docs, bucket=bucket).collect())


def test_simhash_chain_and_crowd(spark):
    """Links reach along a chain of words changed one by one, and a crowd of copies stays one node."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 10_000, 400)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(words)))
        words[int(rng.integers(0, 400))] = f"v{k}"
    rows += [(100 + k, rows[0][1]) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_simhash(rows, simhash.near_duplicates(docs, bucket=3).collect())


def test_linked_prints_share_a_pair_of_pieces():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    y = x.copy()
    for k in range(len(y)):
        for b in rng.choice(64, 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(b)
    key = rng.integers(0, 100, 2000)
    shared = np.zeros(2000, dtype=bool)
    for a, b in zip(simhash.piece_keys(key, x), simhash.piece_keys(key, y), strict=True):
        shared |= a == b
    assert shared.all() and sum(n for _, n in simhash.PIECES) == 64


def test_keep_one(edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    found = simhash.near_duplicates(edge).select("component_id").distinct().count()
    assert kept.count() == found
    assert simhash.near_duplicates(edge.limit(0)).count() == 0 and simhash.keep_one(edge.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(60))
    rows = [(1, text(0), "a"), (1, text(1), "b"), (1, text(2), "c"), (None, text(2), "d"), (None, text(3), "e"), (None, text(3), "f"), (None, text(3), "e"), (7, text(4), "g"), (5, text(4), "h"), (5, text(4), "h"), (9, None, "i"), (8, "", "j"), (None, " ", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, group string").repartition(3)
    want = {(1, text(0), "a"), (1, text(1), "b"), (1, text(2), "c"), (5, text(4), "h"), (8, "", "j")}
    for bucket in (2, simhash.BUCKET):
        got = [tuple(r) for r in simhash.keep_one(docs, bucket=bucket).collect()]
        rest = set(got) - want
        assert len(got) == len(set(got)) == 6 and want < set(got) and rest < {(None, text(3), "e"), (None, text(3), "f")}
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in simhash.keep_one(docs.repartition(1)).collect())


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 600)] + [(7, 7), (1, 0), (700, None)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(201)} | {k: 500 for k in range(500, 600)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket", [3, 2048])
def test_embedding_links(spark, bucket):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        center = rng.standard_normal(32)
        rows += [[float(np.float32(x)) for x in center + rng.standard_normal(32) * 0.1] for _ in range(12)]
    data = [(i, v, i % 2) for i, v in enumerate(rows)]
    data += [(1000, rows[0], 0), (1001, rows[0], 0), (1002, rows[0], None), (1003, None, 0), (1004, [0.0] * 32, 0), (1005, [float("nan")] * 32, 0), (1006, [None, *rows[0][1:]], 0), (1007, [], 0), (1008, rows[0][:8], 0), (None, rows[1], 1)]
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "vec_id long, embedding array<float>, label int, node long, copies long")
    got = embeddings.near_duplicates(df, t=embeddings.Tables(bucket=bucket)).collect()
    good = [r for r in data if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    links = []
    for a in range(len(good)):
        for b in range(a):
            u, w = np.array(good[a][1]), np.array(good[b][1])
            if good[a][2] == good[b][2] and len(u) == len(w) and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= 0.93:
                links.append((a, b))
    degree, own = Counter(k for link in links for k in link), defaultdict(list)
    for k, r in enumerate(roots(len(good), links)):
        own[r].append(k)
    want = {(r[0], 0, r[0]) for r in data if r not in good}
    for members in own.values():
        least = min(good[k][0] for k in members if good[k][0] is not None)
        want |= {(good[k][0], degree[k], least) for k in members}
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got} == want and len(got) == len(data)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def least_capacity(sizes, shards):
    best = {0: 0}
    for k in range(shards):
        best = {j: min((max(best[i], sum(sizes[i:j])) for i in best if i <= j), default=10**9) for j in range(len(sizes) + 1)}
    return best[len(sizes)]


@pytest.mark.parametrize("seed", range(6))
def test_minimax_partition(seed):
    rng = np.random.default_rng(seed)
    sizes, shards = rng.integers(1, 40, rng.integers(1, 14)), int(rng.integers(1, 6))
    want = least_capacity(sizes.tolist(), shards)
    assert sharding.smallest_capacity(sizes, shards) == want
    cuts = sharding.minimax_cuts(sizes, shards)
    assert cuts[0] == 0 and cuts[-1] == len(sizes) and sorted(cuts) == cuts and len(cuts) == shards + 1
    assert max(sizes[a:b].sum() for a, b in zip(cuts, cuts[1:], strict=False)) <= want


def test_shards(spark, documents, edge):
    docs = documents.unionByName(edge.select("doc_id", "text"), allowMissingColumns=True)
    texts = Counter((r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 8) for r in docs.collect())
    got = sharding.shard(docs, shards=5).collect()
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in got) == texts
    slots, group = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        group[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in group.values())
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    largest = max(size for _, _, size in texts)
    assert len(held) == 5 and all(abs(n - sum(held.values()) / 5) < largest for n in held.values())
    assert sharding.shard(docs.limit(0)).count() == 0


def test_targets_fill_up():
    assert mixing.targets([10, 10, 100], [5, 2, 1]) == pytest.approx([30, 30, 60])
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [5, 2]) == [0, 5]


def test_splitting_tree_deals_exact_quotas():
    quotas, shards = np.array([17, 0, 5, 100]), 7
    at = [mixing.shards_at(quotas, shards, k, 0, int(q), 1) for k, q in enumerate(quotas)]
    out = np.stack([np.bincount(x, minlength=shards) for x in at])
    assert (out.sum(axis=1) == quotas).all() and np.ptp(out.sum(axis=0)) <= 1 and all((np.diff(x) >= 0).all() for x in at)
    # Any run of places is the same wherever the walk begins.
    assert all((mixing.shards_at(quotas, shards, 3, a, b, 1) == at[3][a:b]).all() for a, b in ((0, 1), (13, 60), (99, 100), (40, 40)))
    # Over many seeds a source's draws in a shard have the mean and the spread of the hypergeometric law.
    n = np.array([np.bincount(mixing.shards_at(np.array([30, 70]), 4, 0, 0, 30, s), minlength=4)[2] for s in range(3000)])
    assert abs(n.mean() - 7.5) < 0.1 and abs(n.var() - 25 * 0.3 * 0.7 * 75 / 99) < 0.3


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation_of_draws(n):
    out = mixing.permuted(np.arange(n), n, (1, 0, 2))
    assert sorted(out.tolist()) == list(range(n))
    if n == 4097:
        assert (out != mixing.permuted(np.arange(n), n, (1, 0, 3))).any() and len(set(np.diff(out).tolist())) > 1000


def test_mix(spark, documents, edge):
    sizes = mixing.Sizes(block_words=500, shard_words=5000)
    docs = documents.select("doc_id", "text", "source").withColumn("size", F.lit(1))
    rows = mixing.mix(docs, sizes=sizes).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    names = sorted(by)
    lengths = [sum(len((r["text"] or "").encode().split()) for r in by[s]) for s in names]
    want = mixing.targets(lengths, [mixing.WEIGHTS[k % 3] for k in range(len(names))])
    for s, size, target in zip(names, lengths, want, strict=True):
        taken = sum(r["size"] * r["copies"] for r in by[s])
        assert all(r["source_size"] == size and r["target"] == pytest.approx(target) for r in by[s])
        assert abs(taken - target) <= max(r["size"] for r in by[s]) / 2 + 1
    assert all(len(r["shards"]) == r["copies"] <= 3 for r in rows)
    held = Counter()
    for r in rows:
        for k in r["shards"]:
            held[k] += r["size"]
    shards = -(-sum(lengths) // 5000)
    # Shards get equal numbers of draws, so their words differ by what blocks do.
    assert set(held) == set(range(shards)) and max(held.values()) < 3 * sum(lengths) / shards
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3), sizes=sizes).collect()))
    mixed = mixing.mixed_rows(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r["copies"] for r in mixing.mix(edge).collect())
    assert mixing.mix(edge).count() == edge.count() and mixing.mixed_rows(edge.limit(0)).count() == 0 and mixing.mix(edge.limit(0)).count() == 0


def test_small_tables_are_mixed_by_the_tree_too(spark, documents):
    """At the smallest size each source has many blocks, their draws are spread over many shards by the tree, and the last one only is filled by rows."""
    docs = documents.select("doc_id", "text", "source")
    sized = mixing._sized(docs, "doc_id", "text", "source", 11)
    plans = mixing._plan(sized.select("_source", "_size", "_order"), lambda k: mixing.WEIGHTS[k % 3], 3.0, mixing.Sizes())
    rows_of = dict(map(tuple, docs.groupBy("source").count().collect()))
    assert all(p.blocks >= min(32, rows_of[p.source]) for p in plans) and sum(p.draws for p in plans) > 100
    quotas = np.array([p.draws for p in plans])
    want = np.stack([np.bincount(mixing.shards_at(quotas, 16, p.index, 0, p.draws, 11), minlength=16) for p in plans])
    drawn = mixing.dealt(spark, plans, 16, 11).collect()
    got = np.zeros_like(want)
    for r in drawn:
        np.add.at(got, (r["index"], r["shards"]), 1)
    assert (got == want).all() and np.ptp(got.sum(axis=0)) <= 1 and (got.sum(axis=1) == quotas).all()
    # Every shard's blocks are drawn at random: its rows do not follow the order of the blocks.
    first = [r["block"] for r in drawn if r["index"] == 0 and r["shards"][0] == 0]
    assert first and max(first) - min(first) >= len(first)
    assert {k for r in mixing.mix(docs).collect() for k in r["shards"]} == set(range(16))


def test_too_many_draws_are_refused(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_DRAWS", 10)
    with pytest.raises(ValueError, match="block draws"):
        mixing.mix(documents.select("doc_id", "text", "source"))


def test_shards_hold_disjoint_draws_of_their_quotas(spark):
    plans = [mixing.SourcePlan("a", 0, 900, 2400.0, 30, 2, 20, ()), mixing.SourcePlan("b", 1, 10, 5.0, 7, 0, 3, (5,)), mixing.SourcePlan(None, 2, 0, 0.0, 1, 0, 0, ())]
    rows = mixing.dealt(spark, plans, 6, 3).collect()
    want = {(0, b): 2 + (b < 20) for b in range(30)} | {(1, b): 1 for b in range(4)}
    assert {(r["index"], r["block"]): len(r["shards"]) for r in rows} == want
    for k, p in enumerate(plans):
        places = mixing.shards_at(np.array([p.draws for p in plans]), 6, k, 0, p.draws, 3)
        assert Counter(x for r in rows if r["index"] == k for x in r["shards"]) == Counter(places.tolist())


def test_wordless_rows_come_no_more_often_than_the_cap(spark):
    docs = spark.createDataFrame([(i, "w " * 50 if i < 3 else " ", "a" if i < 3 or i > 500 else "b") for i in range(1000)], "doc_id long, text string, source string")
    docs = docs.unionByName(docs.filter("doc_id < 2").selectExpr("doc_id + 5000 AS doc_id", "repeat('w ', 500) AS text", "'c' AS source"))
    rows = mixing.mix(docs, sizes=mixing.Sizes(block_words=8, block_rows=4)).collect()
    assert max(r["copies"] for r in rows) <= 3 and sum(r["copies"] for r in rows if r["source"] == "b") == 0


def tune(notes, rate=4000, n=512):
    t = np.arange(n) / rate
    return np.concatenate([(np.sin(2 * np.pi * 220 * 2 ** (k / 12) * t) * 8000) for k in notes]).astype("<i2")


def test_recordings_align(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 24, 60), rng.integers(0, 24, 60)
    noisy = tune(a[5:]) + rng.normal(0, 300, 55 * 512).astype("<i2")
    rows = [(0, tune(a)), (1, noisy), (2, tune(b)), (100, tune(b[3:])), (4, np.zeros(9000, "<i2")), (5, None), (6, tune(a[:1])), (None, tune(a))]
    df = spark.createDataFrame([(i, None if x is None else bytearray(x.tobytes()), 1) for i, x in rows], "id long, pcm binary, prints int")
    got = {r["id"]: r for r in audio.align(audio.fingerprints(df)).collect()}
    assert (got[1]["match_id"], got[1]["match_offset"]) == (0, -10) and got[1]["bit_errors"] < 0.15
    assert (got[2]["match_id"], got[2]["match_offset"]) == (100, 6) and got[2]["bit_errors"] == 0
    assert got[0]["match_id"] is None and got[None]["match_id"] == 0 and got[5]["n_prints"] == 0 and got[4]["match_id"] is None
    assert audio.align(audio.fingerprints(df.limit(0))).count() == 0


def test_every_matching_query_is_listed(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 24, 60), rng.integers(0, 24, 60)
    near = tune(a) + rng.normal(0, 300, 60 * 512).astype("<i2")
    rows = [(1, tune(a[2:])), (100, tune(a)), (200, near), (300, tune(a)), (400, tune(b)), (400, tune(a[4:]))]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in rows], "id long, pcm binary")
    out = audio.align(audio.fingerprints(df)).collect()
    listed = {(r["id"], r["n_prints"]): [m["match_id"] for m in r["matches"]] for r in out}
    n = {i: [r["n_prints"] for r in out if r["id"] == i] for i in (1, 100, 200, 300)}
    # 100 and 300 are equal recordings: one entry, under the smaller id that is not the row's own.
    assert sorted(listed[1, *n[1]]) == [100, 200, 400] and sorted(listed[200, *n[200]]) == [100, 400]
    assert sorted(listed[100, *n[100]]) == [200, 300, 400] and sorted(listed[300, *n[300]]) == [100, 200, 400]
    assert len({r["prints_sha256"] for r in out if r["id"] in (100, 300)}) == 1
    for r in out:
        best = r["matches"][0] if r["matches"] else (None, None, None)
        assert (r["bit_errors"], r["match_id"], r["match_offset"]) == tuple(best)
        assert r["matches"] == sorted(r["matches"])


def test_alignments_equal_brute_force():
    rng = np.random.default_rng(6)
    p = audio.Print()
    queries = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (40, 90, 200, 12)]
    rows = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (1, 60, 300)] + [np.zeros(30, np.uint32)]
    for q in queries:  # copies at an offset whose every print differs in six bits, so that none can be looked up
        flips = np.array([sum(1 << int(b) for b in rng.choice(32, 6, replace=False)) for _ in range(len(q) + 5)], np.uint32)
        rows += [(np.concatenate([rng.integers(0, 1 << 32, 5, dtype=np.uint32), q]) ^ flips), (q ^ flips[5:])[len(q) // 3 :]]
    queries.append(np.tile(queries[0][:20], 4))
    rows.append(queries[0][:20])
    want = {}
    for i, r in enumerate(rows):
        for j, q in enumerate(queries):
            for s in range(1 - len(q), len(r)):
                a, b = r[max(0, s) :], q[max(0, -s) :]
                both = min(len(a), len(b))
                share = int(np.bitwise_count(a[:both] ^ b[:both]).sum()) / (32 * both)
                if both >= p.least_overlap * min(len(r), len(q)) and share <= p.most_errors:
                    want[i, j] = min(want.get((i, j), (2, 0, 0)), (share, abs(s), s))
    got = audio.alignments([x.view(np.int32) for x in rows], [x.view(np.int32) for x in queries], p)
    assert {(r, q): (e, abs(s), s) for r, q, e, s in zip(*(x.tolist() for x in got), strict=True)} == want and len(want) >= 9
    assert all((4 + 2 * k + c, k) in want for k in range(4) for c in range(2))


def test_histogram_bars_count_equal_runs(monkeypatch):
    rng = np.random.default_rng(7)
    queries = [rng.integers(0, 1 << 32, n, dtype=np.uint32) for n in (1, 7, 20)]
    runs = audio._Runs.of(np.arange(3), queries)
    for tile in (audio.TILE, 3):
        monkeypatch.setattr(audio, "TILE", tile)
        for row in (queries[2][4:], np.concatenate([queries[1], queries[0], queries[1] ^ np.uint32(1 << 13)]), rng.integers(0, 1 << 32, 1, dtype=np.uint32)):
            want = []
            for q in queries:
                for s in range(1 - len(q), len(row)):
                    pairs = [(int(row[i]), int(q[i - s])) for i in range(max(0, s), min(len(row), len(q) + s))]
                    turn = lambda v, k: (v >> 8 * k | v << 32 - 8 * k) & 4095
                    want.append(sum(turn(a, k) == turn(b, k) for a, b in pairs for k in range(4)))
            runs.widen(len(row), audio.Print())
            assert runs.bars(row).tolist() == want


@pytest.mark.parametrize("tile", [audio.TILE, 500])
def test_histograms_find_what_the_exhaustive_search_finds(monkeypatch, tile):
    """Noisy, shifted and cut recordings: at least 0.9 of all pairs that fit, each at its best offset, and none that does not fit."""
    rng = np.random.default_rng(11)
    p, rows, queries = audio.Print(), [], []
    made = lambda x: audio.packed(audio.chroma(x, p), p).view(np.int32)
    for k in range(12):
        notes = rng.integers(0, 24, int(rng.integers(30, 70)))
        queries.append(made(tune(notes)))
        for level in (0, 300, 1000, 2000):
            cut = int(rng.integers(0, 8))
            sound = tune(notes[cut:]).astype(float)
            rows.append(made((sound + rng.normal(0, level + 1, len(sound))).clip(-32768, 32767).astype("<i2")))
    rows += [made(tune(rng.integers(0, 24, 50))) for _ in range(20)] + [np.zeros(30, np.int32)]
    monkeypatch.setattr(audio, "TILE", tile)
    got, want = ({(r, q): (round(e, 9), s) for r, q, e, s in zip(*(x.tolist() for x in found), strict=True)} for found in (audio.Histograms(queries, p).aligned(rows), audio.alignments(rows, queries, p)))
    assert len(want) >= 40 and set(got) <= set(want) and len(got) >= 0.9 * len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.95 * len(got)
    # A row of one integer has four runs only: its equal is found, what is like it by chance need not be.
    one = audio.Histograms(queries, p).aligned([queries[0][:1]])
    assert (0, 0.0, 0) in set(zip(*(x.tolist() for x in one[1:]), strict=True))
    assert audio.Histograms([], p).aligned(rows)[0].size == 0 and audio.Histograms(queries, p).aligned([])[0].size == 0


def test_integral_image_equals_sums():
    image = np.random.default_rng(2).random((40, audio.CLASSES))
    p = audio.Print()
    prints = audio.packed(image, p)
    kind, c, height, width = audio._filters()[3]
    whole = image[5 : 5 + width, c : c + height].sum()
    part = image[5 + width // 2 : 5 + width, c : c + height].sum()
    x = np.log((part + 0.01) / (whole - part + 0.01))
    level = int(x > -p.step) + int(x > 0) + int(x > p.step)
    assert kind == 0 and prints[5] >> 6 & 3 == level ^ level >> 1
