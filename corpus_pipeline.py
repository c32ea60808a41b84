"""The corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

1. toxicity: rows that the classifier calls toxic go; it learns from ``labels``.
2. near_dedup: of each group of near-duplicates by SimHash the row with the smallest doc_id stays.
3. secrets: secrets in the texts are replaced by a mark; all rows stay.
4. mixing: rows are taken as often as the target weights of their sources ask, in shuffled shards.
5. encoding: each row's text becomes token ids, which are decoded again to prove them.

All but the last return the columns of ``documents``. No stage is stated as SQL: three learn or draw at random.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import bpe, mixing, secret_scan, simhash, toxicity
from lodestream.llm.queries import vocabulary_path
from lodestream.llm.shared import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier does not call toxic; it learns from the labels of the rows that are still here, held-out ids left out."""
    model = toxicity.train(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.clean(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates: the one with the smallest doc_id, rows without one last. Wordless texts are one component."""
    return simhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mark in place of every secret; n_chars follows the new text, null texts stay null."""
    return secret_scan.redact(docs, secret_scan.fitted(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, 0 to 3 times, in shuffled shards; null sources are a source of their own."""
    return mixing.mixed_rows(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, input_ids, n_tokens and whether decoding gives the text back."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path(), proof="exact")
    return encoded.select("doc_id", "lang", "source", "input_ids", F.size("input_ids").alias("n_tokens"), "exact")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]

#: SQL expresses neither the trained models nor the random draws; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
