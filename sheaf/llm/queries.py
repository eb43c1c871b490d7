"""One registered query per operator, with its DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import (embedding_join, exact_dedup, html_blocks, katz, language_id, line_dedup, ngram_join, packing,
                       postorder_manifest, pretokenize, recompression, token_alignment, warc_fixity)
from sheaf.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op1_exact_dedup", exact_dedup.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


@query("op2_warc_fixity", warc_fixity.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_fixity.warc_records(load(spark, sf_dir, "pages"))
    layout = warc_fixity.manifest(records)
    return warc_fixity.audit(layout, warc_fixity.damaged_copy(records, layout))


@query("op3_ngram_jaccard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(load(spark, sf_dir, "documents"))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.main_text(load(spark, sf_dir, "pages"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.substring_dedup(load(spark, sf_dir, "documents"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pretokenize.byte_bpe_digests(load(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(load(spark, sf_dir, "documents"))


@query("op8_katz_backoff")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(load(spark, sf_dir, "documents"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_embedding_near_dups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_near_dups(load(spark, sf_dir, "embeddings"))


@query("op11_line_dedup", line_dedup.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(load(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_merkle_manifest", postorder_manifest.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return postorder_manifest.proofs(docs, postorder_manifest.tampered(docs))
