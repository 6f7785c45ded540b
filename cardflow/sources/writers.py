"""Batch, dead-letter, weekly, snapshot and log writes. Each can be repeated safely
unless it says that it appends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.functions.columns import moment


def write_batch(
    df: DataFrame, root: str, stage: str, batch_id: str, files: int | None = None
) -> str:
    """Replace one batch of a stage. The number of files follows the data unless given."""
    path = f"{root}/{stage}/batch_id={batch_id}"
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)
    return path


def write_checked(tagged: DataFrame, root: str, stage: str, batch_id: str) -> str:
    """Replace one batch of a stage with checked rows, in one pass.

    ``outcome=passed`` holds the rows that go on, ``outcome=failed`` the others.
    """
    path = f"{root}/{stage}/batch_id={batch_id}"
    outcome = F.when(F.size("failed_rules") > 0, "failed").otherwise("passed")
    named = tagged.withColumn("outcome", outcome)
    named.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return path


def write_dead_letter(failed: DataFrame, root: str, step: str, batch_id: str) -> str:
    """Replace the failed rows of a step and batch; ``failed_rules`` holds the reasons."""
    path = f"{root}/step={step}/batch_id={batch_id}"
    failed.write.mode("overwrite").parquet(path)
    return path


def compact_week(df: DataFrame, root: str, week_key: str) -> str:
    """Write all batches of a week as one partition of the weekly dataset.

    The rebalance hint lets Spark choose the files by size, not by batch.
    """
    path = f"{root}/week_key={week_key}"
    df.drop("week_key").hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def finalize_week(df: DataFrame, root: str, week_key: str, keep: bool) -> str | None:
    """Publish a week after a scheduled run; a drift run leaves no weekly data behind.

    Training reads ``df`` itself, so there is no temporary copy to rename or delete.
    """
    return compact_week(df, root, week_key) if keep else None


def publish_snapshot(df: DataFrame, root: str, version: str) -> str:
    """Write a version, then a row that says that it is complete.

    Readers take the newest published version, so none ever sees a half-written one.
    """
    spark, path = df.sparkSession, f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(
        f"{root}/published"
    )
    return path


def write_predictions(df: DataFrame, root: str, run_ts: str) -> str:
    """Replace the input rows and predictions of one scoring run."""
    path = f"{root}/run_ts={run_ts}"
    df.withColumnRenamed("prediction", "Predicted_Class").write.mode("overwrite").parquet(path)
    return path


def append_new(target_path: str, new_rows: DataFrame) -> None:
    """Append the rows that ``insert_ignore`` returned."""
    new_rows.write.mode("append").parquet(target_path)


def write_summary(df: DataFrame, root: str, date: str) -> str:
    path = f"{root}/date={date}"
    df.write.mode("overwrite").json(path)
    return path


def commit_watermark(spark: SparkSession, path: str, batch_end: datetime) -> None:
    """Record a batch end. Call it after the sinks of the batch have been written."""
    spark.range(1).select(moment(batch_end).alias("batch_end")).write.mode("append").parquet(path)
