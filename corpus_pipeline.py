"""A corpus from documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns documents; the last one returns ids as digests. A stage's result is written as
Parquet and read again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardflow.llm import exact_dedup, mixing, near_dedup, quality_zstd, sentencepiece_bpe
from cardflow.llm.common import scratch
from cardflow.llm.queries import SENTENCEPIECE_MODEL, quality_model

REJECT_BELOW = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject."""
    return docs.filter(quality_zstd.score("text", quality_model(spark, sf_dir)) >= REJECT_BELOW)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one that it cuts has the words taken."""
    columns = docs.columns
    names = ["at_file", "at_row"]
    while set(names) & set(columns):
        names = [f"{n}_" for n in names]
    placed = exact_dedup.located(docs, columns, names)
    return mixing.mixed_documents(placed, tuple(names)).select(*columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return sentencepiece_bpe.encode_documents(docs, SENTENCEPIECE_MODEL, digests=True)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# Trained scores, signatures and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
