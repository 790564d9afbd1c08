"""Queries of the corpus operators: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climark.llm import chat_format, quality_model, vector_codes
from climark.llm.common import held_out, stored, table
from climark.llm.decontaminate import find_hits
from climark.llm.language_id import identify, learn
from climark.llm.line_dedup import deduplicate_lines
from climark.llm.ngram_jaccard import jaccard_components
from climark.llm.pack_sequences import pack_documents
from climark.llm.prefix_trie import hashed_turns, numbered, prefix_trie, with_shared_heads
from climark.llm.quality_rules import clean_lines
from climark.llm.secret_scan import scan_secrets
from climark.llm.token_counts import section_counts
from climark.llm.token_files import read_token_files, write_token_files
from climark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed", "kept")


@query
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash", "stays")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    transcripts = stored(chat_format.transcripts_of(table(spark, sf_dir, "conversations")), "transcripts")
    model = chat_format.learn(transcripts.filter(~held_out(F.col("conv_id"))))
    return chat_format.format_chats(transcripts, model).select("conv_id", "part", "n_turns", "roles", "chat")


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(
        F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = numbered(hashed_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(*with_shared_heads(turns))
