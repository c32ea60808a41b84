"""The pipeline's stages over a small corpus with planted cases."""

import random

import corpus_pipeline
import pytest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "ing", "ly"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(500):
        words, toxic = [word() for _ in range(80)], i % 5 == 0
        for _ in range(5 * toxic):
            words.insert(rng.randint(0, 80), "snorfax")
        rows.append([i, " ".join(words), "en", f"s{i % 3}", 0])
        labels.append((i, 1, int(toxic)))
    rows[7][1] += ' token = "0123456789abcdef0123456789abcdef01234567"'
    rows += [[1000 + k, rows[3][1], "en", "s0", 0] for k in range(20)]
    root = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), rows


def test_stages(spark, corpus):
    root, rows = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, root)
        out.write.parquet(f"{root}/stage-{name}")
        before, docs = docs, spark.read.parquet(f"{root}/stage-{name}")
        seen[name] = docs
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "encoding"]
    kept = {r["doc_id"] for r in seen["toxicity"].collect()}
    toxic = {i for i in range(500) if i % 5 == 0}
    assert len(kept & toxic) <= 3 and len(set(range(500)) - toxic - kept) <= 3
    once = {r["doc_id"] for r in seen["near_dedup"].collect()}
    assert once == {i for i in kept if i < 1000}
    masked = {r["doc_id"]: r for r in seen["secrets"].collect()}
    assert "0123456789abcdef" not in masked[7]["text"] and "[secret]" in masked[7]["text"] and set(masked) == once
    assert masked[7]["n_chars"] == len(masked[7]["text"])
    mixed = seen["mixing"].groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in mixed} <= once and max(r["count"] for r in mixed) <= 3
    assert seen["encoding"].filter("not exact").count() == 0 and seen["encoding"].count() == seen["mixing"].count() == before.count()


def test_run_gives_the_same_rows(spark, corpus):
    root, _ = corpus
    key = lambda df: sorted((r["doc_id"], r["n_tokens"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, root)) == key(spark.read.parquet(f"{root}/stage-encoding"))
