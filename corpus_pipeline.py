"""Corpus pipeline over ``documents``: the stages run in order, each written as Parquet and read again.

Every stage works on all rows that its predecessor kept and returns the columns of documents; the last adds
the encoding and each document's position. Language ID drops documents without a language, quality rules drop short and repetitive ones,
the n-gram join keeps one document of each group of near duplicates, mixing puts the rest in the order of
target weights, and BPE encodes them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, mixing, ngramjoin, quality
from tidemark.llm.common import table, work_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (6): learned from the labels outside the held-out fold; documents in which no language can
    be seen - null, empty or without a letter - go."""
    return langid.keep(docs)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (5): documents that fail the rules, or whose source does, go."""
    return quality.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): of each component the document with the smallest id stays."""
    return ngramjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights (9): all documents, in the order of the schedule."""
    return mixing.mixed(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding (1): adds ``ids`` (little-endian unsigned 32-bit integers), ``n_tokens``,
    ``round_trip``, whether the decoded text is the text (null: empty), and ``position``, which sorts the corpus
    as it was mixed."""
    done = bpe.encode_decode(mixing.position(docs), VOCABULARY, decoded="__td_decoded")
    return done.withColumn("round_trip", F.col("__td_decoded") == F.coalesce("text", F.lit(""))).drop("__td_decoded")


STAGES = [("language_id", identify_languages), ("quality_rules", apply_quality_rules), ("ngram_jaccard", drop_near_duplicates),
          ("mix_sources", mix_sources), ("bpe", encode_documents)]
#: No SQL form: the languages are learned, the components are transitive and the order is scheduled; tests
#: hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
