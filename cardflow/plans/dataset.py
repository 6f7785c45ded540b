"""Which sources feed a training run, and the reference snapshot built from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.operators.assemble import assemble_dataset
from cardflow.operators.features import select_available
from cardflow.operators.selection import stratified_snapshot
from cardflow.schema import ID, LABEL, MODEL_COLS
from cardflow.sources.readers import select_batches, week_window
from cardflow.sources.writers import publish_snapshot


def plan_sources(
    batches: DataFrame, weekly: DataFrame, as_of: datetime, reason: str = "scheduled"
) -> DataFrame:
    """Sources of a run as ``source, name``: the baseline, finished weeks, batches.

    ``batches`` has ``batch_id`` and ``weekly`` has ``week_key``. With neither, the
    run trains on the baseline alone.
    """
    start, end = week_window(as_of, reason)
    chosen = select_batches(batches.select("batch_id").distinct(), start, end)
    # The week that is collected from batches is not read as a finished week too.
    this_week = f"week_{start:%Y%m%d}"
    weeks = weekly.select("week_key").distinct().filter(
        ~F.col("week_key").endswith("_temp") & (F.col("week_key") != this_week)
    )
    baseline = batches.sparkSession.range(1).select(
        F.lit("baseline").alias("source"), F.lit("baseline").alias("name")
    )
    return baseline.unionByName(
        weeks.select(F.lit("weekly").alias("source"), F.col("week_key").alias("name"))
    ).unionByName(chosen.select(F.lit("batch").alias("source"), F.col("batch_id").alias("name")))


def planned(rows: DataFrame | None, plan: DataFrame, source: str, column: str) -> DataFrame | None:
    """Rows of the partitions of a source that the plan names; the others are not read."""
    if rows is None:
        return None
    names = plan.filter(F.col("source") == source).select(F.col("name").alias(column))
    return rows.join(names, column, "left_semi")


def build_reference(
    root: str,
    version: str,
    promoted: bool,
    baseline: DataFrame | None,
    weekly: DataFrame | None = None,
    current: DataFrame | None = None,
    row_id: str = ID,
) -> str | None:
    """Publish the drift reference of a promoted model; None when it was not promoted."""
    if not promoted:
        return None
    return publish_reference(assemble_dataset(baseline, weekly, current), root, version, row_id)


def publish_reference(dataset: DataFrame, root: str, version: str, row_id: str = ID) -> str:
    """Publish a sample of an assembled dataset as the drift reference."""
    snapshot = stratified_snapshot(dataset, row_id=row_id)
    kept = select_available(snapshot, [*MODEL_COLS, LABEL])[0]
    return publish_snapshot(kept, root, version)
