"""A training-data pipeline over ``documents``: language ID, near duplicates, repeated passages, secrets, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of
``documents``; the last one returns where each piece of each document lies in the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import langid, ngram_join, packing, secret_scan, substring_dedup
from lakeops.llm.staging import staged

TOKENIZER = "word_bpe_49k.json"

# The stages learn, shingle and encode: no SQL gives these rows (tests/llm checks them against brute force).
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with enough certainty; null texts and texts without letters go."""
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies the document with the lowest id; of rows that repeat id and text one stays."""
    return ngram_join.without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out windows of words that occur elsewhere; a document that loses all of its words goes.

    A text that loses nothing stays as it is, line breaks included.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = substring_dedup.remove_repeats(docs, carry=others).filter((F.col("n_words") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    back = {c: F.col(f"carry_{i}") for i, c in enumerate(others)} | {"doc_id": F.col("doc_id"), "text": text}
    back["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(back["n_chars"])
    return cut.select(*(back[c].alias(c) for c in docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by the name of their kind."""
    out = secret_scan.redacted(docs, words=secret_scan.vocabulary_words(public_tokenizers.path(TOKENIZER)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bins."""
    return packing.best_fit(packing.measured(docs, public_tokenizers.path(TOKENIZER)), docs.count())


STAGES = [
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
