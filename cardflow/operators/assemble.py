"""Unions, inserts and aggregates over whole datasets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import ratio
from cardflow.operators.cleaning import dedupe
from cardflow.schema import ID, LABEL, TS


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name, gaps null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def assemble_dataset(
    baseline: DataFrame | None, weekly: DataFrame | None = None, current: DataFrame | None = None
) -> DataFrame:
    """Training rows of all sources, each already in model columns, with ``source``."""
    named = {"baseline": baseline, "weekly": weekly, "current": current}
    parts = [df.withColumn("source", F.lit(name)) for name, df in named.items() if df is not None]
    if not parts:
        raise ValueError("no source to assemble")
    return union_all(parts)


def insert_ignore(
    target: DataFrame,
    incoming: DataFrame,
    key: str = ID,
    order: Sequence[str] = (TS, "amount"),
) -> DataFrame:
    """Rows of ``incoming`` to append: one per key, keys of the target left out."""
    known = target.select(key).distinct()
    return dedupe(incoming, [key], order).join(known, key, "left_anti").select(*incoming.columns)


def merge_version(existing: DataFrame, batch: DataFrame, key: str = ID) -> DataFrame:
    """Next version of a dataset: existing rows plus the batch rows with new keys."""
    return union_all([existing, insert_ignore(existing, batch, key)])


def label_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(label) == 1).alias("fraud_count"),
    )


def fraud_rate(df: DataFrame, by: Sequence[str] = (), label: str = LABEL) -> DataFrame:
    """Rows, positives and their percentage, in total or per group."""
    totals = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(label) == 1).alias("frauds"),
    ]
    counted = df.groupBy(*by).agg(*totals)
    return counted.withColumn("fraud_pct", ratio(100.0 * F.col("frauds"), F.col("total")))


def imbalance_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive, 1.0 where there is no positive."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    )
    weight = ratio(F.col("negatives"), F.col("positives"), default=1.0)
    return counts.withColumn("weight", weight)


def dataset_metadata(df: DataFrame, processing_date: str, label: str = LABEL) -> DataFrame:
    """Record count, share of positives and date of a dataset version."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"),
        ratio(F.count_if(F.col(label) == 1), F.count(F.lit(1))).alias("fraud_rate"),
    ).withColumn("processing_date", F.lit(processing_date))
