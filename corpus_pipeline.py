"""A training corpus from raw documents, in five stages.

1. language ID: documents without a letter, or of no language learned, go;
2. quality rules: documents that the base rules or the threshold table reject go;
3. MinHash near-duplicates (five words, similarity 0.8): one document of each
   group stays;
4. mixing: each source's documents, as often as its target share takes them;
5. SentencePiece encoding with merge-dropout: the ids of each document.

Each stage works on all that the one before kept and returns the columns of its
input; the last one returns doc_id, n_ids and ids.  An empty table passes through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeline.llm import language_id, minhash_dedup, mixing, quality_rules, sentencepiece_codec
from judgeline.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.reject(docs, language_id.train(docs))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(docs)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("minhash_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL cannot express the classifier of the first stage; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
