"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, byte-level BPE.

Each stage works on all rows that its predecessor kept. All but the last return the columns of ``documents``, extra
ones included, whatever their names. NULL texts are empty texts to every stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sideline.llm import block_naming, mixing, queries, simhash, toxicity
from sideline.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects go. It learns from the labelled rows of ``docs`` that are not held out; labels
    without a doc_id or of no document are left out, of repeated ones the worst counts. Equal texts, NULL and empty ones
    among them, go or stay together, whatever their doc_id; without labels nothing goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~queries.held_out())
    return toxicity.accepted(docs, toxicity.train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts the row with the largest doc_id stays (NULL is the least; of repeated rows one). NULL
    and empty texts are one group."""
    return block_naming.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays (NULL last). Texts without words are one group."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources meet their target weights. NULL is a source of its own; texts without
    words are never taken."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix, repeated and NULL doc_ids included."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: The classifier, XXH64 fingerprints and BPE have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
