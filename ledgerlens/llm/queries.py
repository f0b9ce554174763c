"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    chat,
    classifier,
    decontaminate,
    filter_audit,
    language_id,
    line_dedup,
    lm_scoring,
    near_dedup,
    quality_rules,
    sharding,
    token_counts,
    vector_codes,
)
from ledgerlens.llm.common import documents, remainder, ship


def op1_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(documents(spark, sf_dir), lines_col="n_lines", kept_col="n_kept").select(
        "doc_id", "n_lines", "n_kept", "text")


def op2_chat_formatting(spark, sf_dir):
    return chat.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op3_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_lm_scoring(spark, sf_dir):
    return lm_scoring.score(documents(spark, sf_dir))


def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_bpe_automaton(spark, sf_dir):
    return bpe.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), tokens=False)


def op8_simhash_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _shipped(fn):
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)
    return run


def op9_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SHARDS = [f"shard-{i:02d}" for i in range(32)]
SLOTS = 4099


def op10_sharding(spark, sf_dir):
    return sharding.place(documents(spark, sf_dir).select("doc_id"), ["doc_id"], SHARDS, SLOTS)


def op11_language_id(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir))


def op12_vector_codes(spark, sf_dir):
    coded, book = vector_codes.encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.codebook_digest(book)).alias("codebooks_sha256"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {fn.__name__: _shipped(fn) for fn in (
    op1_line_dedup, op2_chat_formatting, op3_quality_classifier, op4_quality_rules, op5_lm_scoring, op6_token_counts,
    op7_bpe_automaton, op8_simhash_near_dedup, op9_benchmark_decontamination, op10_sharding, op11_language_id,
    op12_vector_codes, op13_filter_audit)}
ORACLE_SQL: dict[str, str] = {"op4_quality_rules": quality_rules.oracle_sql(),
                              "op10_sharding": sharding.oracle_sql(SHARDS, SLOTS),
                              "op12_vector_codes": vector_codes.oracle_sql(),
                              "op13_filter_audit": filter_audit.oracle_sql()}
