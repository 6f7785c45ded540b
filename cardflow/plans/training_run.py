"""A training run from the stored sources to a published model and drift reference."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.operators.assemble import assemble_dataset, dataset_metadata
from cardflow.operators.cleaning import apply_scaler, fit_scaler
from cardflow.operators.features import canonicalize_baseline
from cardflow.operators.metrics import classification_report, f1_binary, promotion_decision
from cardflow.operators.selection import temporal_split
from cardflow.plans.dataset import plan_sources, planned, publish_reference
from cardflow.plans.training import ScoringModel, TreeParams, save_model, score, search
from cardflow.schema import ID, LABEL, MODEL_COLS, TS
from cardflow.sources.readers import (
    if_present,
    read_baseline,
    read_batch,
    read_stage,
    read_weekly,
    week_window,
)
from cardflow.sources.writers import finalize_week, write_dead_letter

DATASET_COLS = [ID, TS, *MODEL_COLS, LABEL]


@dataclass(frozen=True)
class TrainingResult:
    version: str
    promoted: bool
    decision: DataFrame
    report: DataFrame
    model_path: str
    reference_path: str | None
    week_path: str | None


def assemble_sources(
    spark: SparkSession,
    root: str,
    baseline_paths: Sequence[str],
    as_of: datetime,
    reason: str = "scheduled",
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of all planned sources in one layout, and this run's batches as they are stored.

    Baseline rows get an id and a time before the union, so all sources share one order
    in time. Batches and finished weeks are feature rows under ``root``; either may be absent.
    """
    batches = if_present(read_stage, spark, root, "features")
    weeks = if_present(read_weekly, spark, f"{root}/weekly")
    no_batch, no_week = (spark.createDataFrame([], f"{c} string") for c in ("batch_id", "week_key"))
    plan = plan_sources(
        no_batch if batches is None else batches, no_week if weeks is None else weeks, as_of, reason
    )
    current = planned(batches, plan, "batch", "batch_id")
    weekly = planned(weeks, plan, "weekly", "week_key")
    baseline = canonicalize_baseline(read_baseline(spark, baseline_paths))
    parts = (
        rows if rows is None else rows.select(*DATASET_COLS) for rows in (baseline, weekly, current)
    )
    return assemble_dataset(*parts), current


def production_f1(spark: SparkSession, root: str, version: str) -> DataFrame | None:
    """F1 of the newest model promoted before ``version``, as one row; None without decisions."""
    decisions = if_present(read_batch, spark, f"{root}/decisions")
    if decisions is None:
        return None
    earlier = decisions.filter((F.col("version") < version) & F.col("promote"))
    return earlier.agg(F.max_by("candidate_f1", "version").alias("f1"))


def run_training(
    spark: SparkSession,
    root: str,
    baseline_paths: Sequence[str],
    as_of: datetime,
    reason: str = "scheduled",
    settings: Sequence[TreeParams] | None = None,
) -> TrainingResult:
    """Plan, assemble, split, search, judge, publish and close the week, under ``root``.

    The assembled rows are written once and read from there. Rows whose label is neither
    0 nor 1 cannot be learnt from and go to the dead letter. The scaler is fitted on the
    earlier rows and stored with the model. A promoted model gets a drift reference. Only
    a scheduled run turns its batches into a finished week, under the Monday of the data.
    Every write is to the run's own version, so a repeated run replaces it.
    """
    version = f"{as_of:%Y%m%d_%H%M%S}"
    rows, current = assemble_sources(spark, root, baseline_paths, as_of, reason)
    path = f"{root}/datasets/version={version}"
    rows.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    usable = F.coalesce(F.col(LABEL).isin(0, 1), F.lit(False))
    unusable = stored.filter(~usable).withColumn("failed_rules", F.array(F.lit(f"in_set:{LABEL}")))
    write_dead_letter(unusable, f"{root}/dead-letter", "training_labels", version)
    dataset = stored.filter(usable)
    dataset_metadata(dataset, f"{as_of:%Y-%m-%d}").write.mode("overwrite").parquet(
        f"{root}/metadata/version={version}"
    )

    train, test = temporal_split(dataset)
    model_path = f"{root}/models/version={version}"
    fit_scaler(train).write.mode("overwrite").parquet(f"{model_path}/fitted")
    scaler = spark.read.parquet(f"{model_path}/fitted")
    train, test = apply_scaler(train, scaler), apply_scaler(test, scaler)
    trees, _, _ = search(train, test, settings=settings)
    save_model(ScoringModel(trees, scaler), model_path)
    scored = score(test, trees)
    decided = promotion_decision(f1_binary(scored), production_f1(spark, root, version))
    decision_path = f"{root}/decisions/version={version}"
    decided.write.mode("overwrite").parquet(decision_path)
    decision = spark.read.parquet(decision_path)
    report_path = f"{root}/reports/version={version}"
    classification_report(scored).write.mode("overwrite").parquet(report_path)

    promoted = decision.first()["promote"]
    reference = publish_reference(dataset, f"{root}/reference", version) if promoted else None
    week = None
    if current is not None:
        monday = week_window(as_of, reason)[0]
        week = finalize_week(
            current, f"{root}/weekly", f"week_{monday:%Y%m%d}", keep=reason == "scheduled"
        )
    return TrainingResult(
        version, promoted, decision, spark.read.parquet(report_path), model_path, reference, week
    )
