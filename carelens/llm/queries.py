"""The registered queries of this package: one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import (
    chat, lexical, mixing, neighbours, ngram_join, packing, perplexity, quality_rules, secret_scan, simhash, token_counts, toxicity, whitening)
from carelens.llm import sql as S
from carelens.llm.common import read_table
from carelens.sources.sinks import scratch_path

PACKING_TOKENIZER = "word_bpe_49k.json"
COUNTING_TOKENIZER = "byte_bpe_50k"


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(spark, rows, F.col("vec_id") % 20 == 0, k=20)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(spark, read_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(PACKING_TOKENIZER)
    pieces = packing.pack_documents(spark, read_table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "cost")


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = token_counts.BytePairs(public_tokenizers.path(f"{COUNTING_TOKENIZER}.tiktoken"), public_tokenizers.PATTERN)
    rollup = token_counts.rollup_documents(
        spark, read_table(spark, sf_dir, "documents"), scratch_path(spark, "token-rollup"), COUNTING_TOKENIZER, tokenizer)
    return rollup.totals(apart=token_counts.DEDUPE)


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    records = chat.conversations_as_records(rows.unionByName(probe))
    return chat.digests(chat.format_chats(records))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "neighbours", "terms")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.quality_rules(spark, read_table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.fair_queue(spark, read_table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(spark, read_table(spark, sf_dir, "documents"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{secret_scan.KINDS[k].name}")
    return found.select(
        "doc_id", of(0), of(1), of(2),
        F.sha2(secret_scan.span_text("base").cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text("spans").alias("spans"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(spark, read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(spark, read_table(spark, sf_dir, "documents"))
    return lexical.search(spark, index, read_table(spark, sf_dir, "benchmark"), k=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_ngram_join": op2_ngram_join,
    "op3_packing": op3_packing,
    "op4_perplexity": op4_perplexity,
    "op5_token_counts": op5_token_counts,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_simhash": op11_simhash,
    "op12_lexical_search": op12_lexical_search,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": S.ngram_join(),
    "op6_chat_formatting": S.chat_formatting(),
    "op8_quality_rules": S.quality_rules(),
    "op9_mixing": S.mixing(),
    "op10_secret_scan": S.secret_scan(),
    "op12_lexical_search": S.lexical_search(),
}
