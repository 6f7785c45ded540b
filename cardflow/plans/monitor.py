"""Daily drift run over the prediction log."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cardflow.operators.drift import drift_summary, should_retrain
from cardflow.operators.features import canonicalize_inference
from cardflow.sources.readers import is_missing, read_recent, read_reference
from cardflow.sources.writers import write_summary


def run_drift(
    spark: SparkSession,
    reference_path: str,
    log_root: str,
    log_schema: StructType,
    as_of: datetime,
    days: int = 7,
    out_root: str | None = None,
) -> DataFrame:
    """Compare the recent prediction log with the reference snapshot.

    Without a reference, or without a log folder yet, the result is "not drifted". A log
    file that can't be read is left out; ``read_tolerant`` gives an account of such files.
    The summary is stored by date and then read back, so using it does not compare
    again.
    """
    reference = read_reference(spark, reference_path)
    try:
        recent = read_recent(spark, log_root, as_of, days, log_schema, tolerant=True)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        recent = spark.createDataFrame([], log_schema)
    current = canonicalize_inference(recent)
    summary = drift_summary(reference, current, lookback_days=days, evaluated_at=as_of)
    if out_root is None:
        return summary
    path = write_summary(summary, out_root, f"{as_of:%Y-%m-%d}")
    return spark.read.schema(summary.schema).json(path)


def retrain_needed(summary: DataFrame, dataset: DataFrame, previous: DataFrame) -> bool:
    """Whether to train again; the one-row decision comes to the driver."""
    return should_retrain(summary, dataset, previous).first()["retrain"]
