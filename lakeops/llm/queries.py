"""Registered queries of the operators: opN_<name>(spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import hard_negatives, mixing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import rules

    docs = table(spark, sf_dir, "documents")
    learned = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.apply_rules(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@register
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakeops.llm import secret_scan as S

    words = S.vocabulary_words(public_tokenizers.path("word_bpe_49k.json"))
    found = S.find_secrets(table(spark, sf_dir, "documents"), words=words)
    spans = F.col("spans")
    return found.select(
        "doc_id", *(S.count_of(spans, k).alias(f"n_{k}") for k in S.KINDS),
        F.sha2(S.span_list(spans, S.KINDS[:3]), 256).alias("base_sha256"), S.span_list(spans).alias("spans"))


@register
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import fingerprints

    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


@register
def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakeops.llm import token_file
    from lakeops.llm.staging import shared_path

    path = shared_path(spark, "tokens")
    token_file.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_file.document_report(spark, path)


@register
def op9_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakeops.llm import piece_bpe

    coded = piece_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~F.coalesce(langid.held_out(F.col("doc_id")), F.lit(True))))
    return langid.predict(docs, model).select("doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@register
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import ngram_join

    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import substring_dedup

    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import importance

    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.withColumn("kept", F.col("selected"))


@register
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakeops.llm import packing

    docs = table(spark, sf_dir, "documents")
    return packing.best_fit(packing.measured(docs, public_tokenizers.path("word_bpe_49k.json")), docs.count())


@register
def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLE["op12_source_mix"] = mixing.ORACLE


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(relabelled, F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = hard_negatives.ORACLE


@register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"))
