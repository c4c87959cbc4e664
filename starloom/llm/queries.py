"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    byte_bpe,
    chat_quotes,
    decision_list,
    decontam,
    lang_codes,
    line_windows,
    ngram_join,
    shard_tree,
    token_align,
    token_counts,
    toxic_segments,
    turn_repair,
    word_bpe,
)
from starloom.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]

TREE = shard_tree.HashTree.even(regions=5, racks=2, shards=4)


def op1_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of the table as mail, each quoting the two turns before it, and back."""
    mail = chat_quotes.as_mail(read(spark, sf_dir, "conversations"))
    found = chat_quotes.conversations(mail)
    return found.select(
        F.col("thread").alias("conv_id"),
        F.col("id.turn").alias("turn"),
        F.col("root.conv_id").alias("root_conv_id"),
        F.col("root.turn").alias("root_turn"),
        F.col("parent.conv_id").alias("parent_conv_id"),
        F.col("parent.turn").alias("parent_turn"),
        "depth",
        "role",
        "text",
    )


def op2_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.assign(read(spark, sf_dir, "documents"), TREE)


def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_windows.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_removed")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(read(spark, sf_dir, "documents"), merges, public_tokenizers.PATTERN)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges, special = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    docs = read(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, merges, special, public_tokenizers.PATTERN)


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return decision_list.judge(docs, decision_list.fit(docs, read(spark, sf_dir, "labels")))


def op8_lang_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_codes.report(read(spark, sf_dir, "documents"))


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_segments.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations of the table with faults put in, and repaired."""
    turns = read(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.damage(turns), turns)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges, rules = word_bpe.load_json(public_tokenizers.path("word_bpe_49k.json"))
    return word_bpe.digests(read(spark, sf_dir, "documents"), merges, rules)


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges, _ = token_counts.load_json(public_tokenizers.path("byte_bpe_50k.json"))
    model = token_align.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    return token_align.report(read(spark, sf_dir, "documents"), merges, public_tokenizers.PATTERN, model)


def queries() -> dict[str, Query]:
    return {
        "op1_chat_quotes": op1_chat_quotes,
        "op2_shard_tree": op2_shard_tree,
        "op3_line_windows": op3_line_windows,
        "op4_ngram_join": op4_ngram_join,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_token_counts": op6_token_counts,
        "op7_decision_list": op7_decision_list,
        "op8_lang_codes": op8_lang_codes,
        "op9_toxic_segments": op9_toxic_segments,
        "op10_decontam": op10_decontam,
        "op11_turn_repair": op11_turn_repair,
        "op12_word_bpe": op12_word_bpe,
        "op13_token_align": op13_token_align,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_windows": line_windows.ORACLE,
    }
