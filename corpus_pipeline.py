"""Corpus pipeline: language ID, exact dedup, near-duplicate removal, substring dedup, packing.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and, but for the
last, returns the columns of ``documents``; ``run`` writes each result as Parquet into the shared checkpoint folder and
reads it back as the next stage's input. Ids are taken to be unique; rows with a null id are kept
by the dedup stages. The result has no SQL form (trained profiles, connected components); tests hold
it against brute-force versions of the stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import exact_dedup, language_id, ngram_join, packing, recompression
from sheaf.llm.common import written
from sheaf.sources.tables import load


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that no language can be told of: those without a letter."""
    return language_id.drop_unidentified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles, the smallest id."""
    return ngram_join.drop_near_duplicates(docs, shingle=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that start in a document with a smaller id."""
    return recompression.drop_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language ID", identify_language), ("exact dedup", exact_duplicates),
          ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = written(docs, f"stage{i}")
    return docs
