"""The registered queries of the operators, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm import (
    byte_bpe,
    collocations,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    near_dedup,
    quality_rules,
    quality_zstd,
    secret_scan,
    sentencepiece_bpe,
    token_counts,
    url_filter,
)
from cardflow.llm.common import remainder, table

SENTENCEPIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


TIKTOKEN_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Pages that put their key on the list: of spam hosts, or with less html than this.
THIN_HTML = 1000


def held_out(modulus: int, rest: int) -> Column:
    """Rows that nothing is learned from; one with a null id isn't among them."""
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False)).alias("held_out")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan_documents(table(spark, sf_dir, "documents")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_bpe.encode_documents(docs, SENTENCEPIECE_MODEL, digests=True)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document before and after three edits that follow from itself."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_edits(docs, token_counts.own_edits(), TIKTOKEN_RANKS, public_tokenizers.PATTERN)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs, remainder("doc_id", 4) != 2))
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    spam = url_filter.host_of(F.col("url")).rlike(r"(^|\.)spam")
    return url_filter.judge(table(spark, sf_dir, "pages"), spam | (F.length("html") < THIN_HTML))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.label(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_rules.judge(docs, labels)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.resolve(table(spark, sf_dir, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


def quality_model(spark: SparkSession, sf_dir: str) -> quality_zstd.Model:
    """The compression classifier, learned from labelled rows that aren't held out."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_zstd.train(*quality_zstd.labelled_sample(docs, labels, remainder("doc_id", 5) != 0))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_zstd.score_documents(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", held_out(5, 0), "score", "predicted")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode_documents(docs, TIKTOKEN_RANKS, public_tokenizers.PATTERN, digests=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_secret_scan": op1_secret_scan,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_token_counts": op3_token_counts,
        "op4_language_id": op4_language_id,
        "op5_url_filter": op5_url_filter,
        "op6_mixing": op6_mixing,
        "op7_near_dedup": op7_near_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_collocations": op11_collocations,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_byte_bpe": op13_byte_bpe,
    }
