"""The registered queries of this subpackage: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import audio, bpe, divergence, embeddings, lattice_lm, mixing, prefix_trie, proximity_graph, secret_scan, sharding, simhash, token_counts, toxicity
from lodestream.llm.shared import table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabularies keep ``name``; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of every document; nulls are empty, repeated rows stay."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, by the drawn copies; a null source is one of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    # A row is taken once for each shard that it is dealt to.
    return mixed.select("doc_id", "size", "source_size", "target", (mixed["size"] * F.size("shards")).alias("taken"), "shards")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the rules' spans and those that the network adds; nulls are empty."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fitted(docs))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; wordless and null texts have fingerprint zero."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector; vectors that are no directions link with nothing."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by near equal bytes; equal texts stay together."""
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from the labels of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"))))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole document; nulls are empty."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path(), limit=512)


def op9_audio_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that fit each recording. No table holds sound, so Spark derives a recording from every vector of `embeddings`."""
    recordings = audio.sonified(table(spark, sf_dir, "embeddings"))
    return audio.align(audio.fingerprints(recordings, key="vec_id"), key="vec_id")


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice score of every document, learned from the words of those that are not held out."""
    return lattice_lm.score_texts(table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every row whose vec_id is divisible by 50, over all rows of `embeddings`."""
    return proximity_graph.neighbours(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of sources and terms of sources, of every language in `documents`."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_encode_decode": op1_bpe_encode_decode,
    "op2_source_mixing": op2_source_mixing,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_audio_fingerprints": op9_audio_fingerprints,
    "op10_lattice_lm": op10_lattice_lm,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}

#: DuckDB SQL for the queries whose rows SQL can state; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_source_divergence": divergence.AUDIT_SQL,
}
