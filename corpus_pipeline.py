"""The corpus pipeline: each stage works on the whole output of the one before.

Rows are told apart by doc_id; rows that still share one after exact
deduplication are treated as one document.  Every stage keeps the columns of
its input but the last, which returns the encoded documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, ecoc_langid, mixing, simhash, stream_dedup
from tidemark.llm.catalog import VOCABULARY
from tidemark.llm.common import materialize, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents and drops those whose language cannot be told."""
    model = ecoc_langid.train(docs.where(~ecoc_langid.held_out()))
    return ecoc_langid.keep_identified(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the largest id of each group of equal texts."""
    return stream_dedup.keep_first(docs, stream_dedup.exact_dedup(docs, in_files=True))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash group."""
    found = simhash.near_duplicates(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept_id"]), "left_semi").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents by the probabilities raked to source, language and topic targets."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Written, so that topics and tokens are worked out once for the fit and the draw.
    rows = materialize(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "lang",
                                   mixing.topic_of(text).alias("topic"), mixing.word_count(text).alias("tokens")), "mix-rows")
    return mixing.apply_mix(rows, mixing.fit(rows)).where("kept").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    vocabulary = bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    return bpe.encode_documents(docs, vocabulary, public_tokenizers.PATTERN, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The stages hash, train and tokenize in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
