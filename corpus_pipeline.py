"""From raw documents to token ids: quality, repeated lines, near copies, test items, encoding.

Every stage takes the session, the documents that the stage before it kept, and the
folder of the other tables, and gives documents with the same columns; the last one
adds their token ids. Stages are written as Parquet and read again, so a lost
executor costs at most the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, decision_list, decontam, line_windows, ngram_join
from starloom.llm.tables import SPACES, read
from starloom.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return decision_list.keep_good(docs, decision_list.fit(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document; ``n_chars`` follows the text.

    Documents of which nothing is left go.
    """
    cleaned = line_windows.dedup_lines(docs)
    left = F.char_length(F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES))) > 0
    size = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    size = size.cast(docs.schema["n_chars"].dataType)
    return cleaned.filter((F.col("n_removed") == 0) | left).withColumn("n_chars", size).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold too much of the test items."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the token ids of their texts."""
    merges = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode_texts(docs, merges, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Learned rules and the tokenizer have no SQL form; the tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
